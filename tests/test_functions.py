from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import only_row
from marketfold.functions import (
    amount_mean,
    amount_merge,
    amount_sum,
    amount_total,
    free_names,
    percent,
    ratio,
    round_each,
)

NAN, INF = float("nan"), float("inf")


def total_and_mean(df, column="x"):
    sums = df.agg(amount_sum(column).alias("s"))
    row = only_row(sums.select(amount_total("s").alias("t"), amount_mean("s").alias("m")))
    return row["t"], row["m"]


def numbers(spark, values, partitions=3):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)


cents = st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cents, min_size=1, max_size=20))
def test_sum_of_cents_is_exact(spark, groups):
    rows = [(g, c / 100) for g, values in enumerate(groups) for c in values]
    df = spark.createDataFrame(rows, "g int, x double").repartition(4)
    sums = df.groupBy("g").agg(amount_sum("x").alias("s"))
    found = {r["g"]: r["t"] for r in sums.select("g", amount_total("s").alias("t")).collect()}
    assert found == {g: float(Decimal(sum(values)) / 100) for g, values in enumerate(groups)}


def test_sum_does_not_depend_on_row_order(spark):
    values = [random.Random(7).uniform(-1e6, 1e6) for _ in range(5000)]
    results = {
        total_and_mean(numbers(spark, order, parts))
        for order, parts in ((values, 1), (values[::-1], 5), (sorted(values), 7))
    }
    assert len(results) == 1
    assert results.pop()[0] == pytest.approx(math.fsum(values), abs=1e-2)


def test_sum_skips_nulls_and_is_null_without_values(spark):
    assert total_and_mean(numbers(spark, [1.5, None, 2.5])) == (4.0, 2.0)
    assert total_and_mean(numbers(spark, [None, None])) == (None, None)
    assert total_and_mean(numbers(spark, [1.0]).filter("false")) == (None, None)


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([1.0, INF], INF),
        ([1.0, -INF], -INF),
        ([5.0, 1e18], 1e18 + 5.0),
        ([1e300, 1.0], 1e300),
        ([1e19, -1e19, 0.25], 0.25),
        ([1e-30, 1e-30], 2e-30),
    ],
)
def test_values_beyond_the_exact_range_still_count(spark, values, expected):
    assert total_and_mean(numbers(spark, values))[0] == expected


@pytest.mark.parametrize(
    ("value", "rows", "expected"),
    [
        ("9e11D", 20_000_000, 1.8e19),
        ("-9e11D", 20_000_000, -1.8e19),
        ("4e-7D", 1_000_000, 0.4),
        ("0.0000015D", 1_000_000, 1.5),
        ("-0.0000015D", 1_000_000, -1.5),
        ("3e12D", 20_000_000, 6e19),
        ("1e-12D", 1_000_000, 1e-6),
        ("0.1D", 1_000_000, 100_000.0),
    ],
)
def test_many_rows_lose_no_digit_and_do_not_overflow(spark, value, rows, expected):
    df = spark.range(0, rows, 1, 4).select(F.expr(value).alias("x"))
    total, mean = total_and_mean(df)
    assert total == pytest.approx(expected, rel=1e-14)
    assert mean == pytest.approx(expected / rows, rel=1e-14)


@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e6, 1e12, 1e17])
def test_one_total_however_rows_are_spread(spark, scale):
    values = [random.Random(5).uniform(-1, 3) * scale for _ in range(4000)]
    totals = {total_and_mean(numbers(spark, values, parts))[0] for parts in (1, 3, 7)}
    assert len(totals) == 1
    assert totals.pop() == pytest.approx(math.fsum(values), rel=1e-13)


def test_merging_with_large_weights_does_not_overflow(spark):
    df = spark.createDataFrame([(1, 123456.789)] * 50, "g int, x double")
    parts = df.groupBy("g").agg(amount_sum("x").alias("part"))
    merged = parts.agg(amount_merge("part", times="1000000000000L").alias("s"))
    total = only_row(merged.select(amount_total("s").alias("t")))["t"]
    assert total == pytest.approx(50 * 123456.789e12, rel=1e-15)


def test_nan_and_opposite_infinities_give_nan(spark):
    assert math.isnan(total_and_mean(numbers(spark, [1.0, NAN]))[0])
    assert math.isnan(total_and_mean(numbers(spark, [INF, -INF]))[0])


@pytest.mark.parametrize("partitions", [1, 3, 7])
@pytest.mark.parametrize(
    ("value", "away", "expected"),
    [
        (1e9 + 2.0**-23, 1e9, 0.11920928955078125),
        (1e6 + 2.0**-33, 1e6, 0.00011641532182693481),
        (1e10 + 2.0**-19, 1e10, 1.9073486328125),
        (4e15 + 0.5, 4e15, 500_000.0),
        (2.0**33 + 0.25, 2.0**33, 250_000.0),
        (0.1 + 2.0**-53, 0.1, None),
    ],
)
def test_digits_beside_a_six_decimal_number_are_kept(spark, value, away, expected, partitions):
    sign = "IF(id % 2 = 0, 1, -1)"
    df = spark.range(0, 2_000_000, 1, partitions).select(
        F.expr(f"IF({sign} = 1, {value!r}D, -{away!r}D)").alias("x")
    )
    total, _ = total_and_mean(df)
    if expected is None:
        # One is taken as a number of six decimals, its neighbour with all of its digits.
        expected = (value - 0.1) * 1_000_000
        assert total == pytest.approx(expected, rel=0.6) and total > 0
    else:
        assert total == expected


@pytest.mark.parametrize("decimal", [True, False])
@pytest.mark.parametrize(
    "values",
    [
        [1 / 3] * 1000 + [1e9 / 7] * 777 + [-2 / 3, 5e-5 / 7],
        [random.Random(11).uniform(-1e9, 1e9) for _ in range(5000)],
        [random.Random(12).uniform(-1, 1) * 10.0 ** random.Random(i).randint(-4, 15) for i in range(5000)],
        [2.0**53 + 2, 1 / 3, -(2.0**53), 1e17, 1 / 7],
    ],
)
def test_sums_of_quotients_are_rounded_once(spark, values, decimal):
    df = numbers(spark, values, 5)
    sums = df.agg(amount_sum("x", decimal=decimal).alias("s")).select(amount_total("s").alias("t"))
    assert only_row(sums)["t"] == math.fsum(values)


def test_a_million_unit_prices_equal_the_correctly_rounded_sum(spark):
    df = spark.range(0, 1_000_000, 1, 6).select(
        F.expr("IF(id % 2 = 0, 1D / 3D, 1e9D / 7D)").alias("x")
    )
    sums = df.agg(amount_sum("x", decimal=False).alias("s")).select(amount_total("s").alias("t"))
    assert only_row(sums)["t"] == math.fsum([1 / 3, 1e9 / 7] * 500_000)


def test_a_total_beyond_the_lanes_is_an_error_and_not_a_wrong_sum(spark):
    df = spark.range(0, 20_000_000, 1, 2).select(F.lit(4e18).alias("x"))
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        total_and_mean(df)


def test_sum_accepts_integers_and_decimals(spark):
    assert total_and_mean(spark.sql("SELECT 3 AS x UNION ALL SELECT 4"))[0] == 7.0
    assert total_and_mean(spark.sql("SELECT 0.10BD AS x UNION ALL SELECT 0.20BD"))[0] == 0.3


def test_merged_parts_equal_the_direct_sum(spark):
    values = [random.Random(3).randint(-99999, 99999) / 100 for _ in range(999)] + [None, 1e15]
    df = numbers(spark, values).withColumn("g", F.spark_partition_id())
    parts = df.groupBy("g").agg(amount_sum("x").alias("part"))
    merged = parts.agg(amount_merge("part").alias("s")).select(amount_total("s").alias("t"))
    assert only_row(merged)["t"] == total_and_mean(df)[0]


def test_merge_with_weights_counts_each_part_that_often(spark):
    df = spark.createDataFrame([("a", 1.25, 3), ("b", 0.5, 2)], "g string, x double, w long")
    parts = df.groupBy("g", "w").agg(amount_sum("x").alias("part"))
    merged = parts.agg(amount_merge("part", times="w").alias("s"))
    row = only_row(merged.select(amount_total("s").alias("t"), "s.n"))
    assert row == {"t": 4.75, "n": 5}


def test_sum_over_a_window(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.3)], "d int, x double")
    running = amount_sum("x", over="ORDER BY d RANGE BETWEEN 1 PRECEDING AND CURRENT ROW")
    rows = df.withColumn("s", running).select("d", amount_total("s").alias("t")).collect()
    assert {r["d"]: r["t"] for r in rows} == {1: 0.1, 2: 0.3, 3: 0.5}


@pytest.mark.parametrize("places", [1, 2, 4])
def test_fast_rounding_equals_round_to_the_last_bit(spark, places):
    pick = random.Random(places)
    values = [pick.uniform(-1e4, 1e4) for _ in range(3000)]
    values += [k / 2000 for k in range(-4000, 4000)]  # many exact ties
    values += [k / 8 for k in range(-100, 100)] + [1.005, 2.675, -1.005, 1e10 + 0.125, 5e15 + 1]
    values += [0.0, -0.0, -1e-9, 1e-9, NAN, INF, -INF, 1e300, -1e300, None]
    df = numbers(spark, values).select(
        "x", round_each("x", places).alias("fast"), F.round("x", places).alias("plain")
    )
    assert df.filter("NOT (fast <=> plain)").collect() == []


def test_ratio_and_percent_are_null_for_a_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 8), (None, 8)], "a int, b int")
    rows = df.select(
        ratio(F.col("a"), F.col("b"), 2).alias("r"), percent(F.col("a"), F.col("b"), 1).alias("p")
    ).collect()
    assert [tuple(r) for r in rows] == [(None, None), (0.13, 12.5), (None, None)]


def test_free_names_are_not_in_the_table(spark):
    df = spark.createDataFrame([(1, 2)], "_x int, _X_ int")
    assert free_names(df, "_x", "_y", "_y") == ["_x__", "_y", "_y_"]
