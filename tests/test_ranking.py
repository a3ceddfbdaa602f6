from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from marketfold.operators import ranking
from marketfold.operators.ranking import add_dense_rank

NAN, INF = float("nan"), float("inf")


def brute_force(rows):
    """Dense rank per group, highest first: NaN, then numbers, then NULL."""

    def order(value):
        if value is None:
            return (2, 0.0)
        return (0, 0.0) if math.isnan(value) else (1, -value)

    ranked = []
    for key, group, value in rows:
        peers = sorted({order(v) for _, g, v in rows if g == group})
        ranked.append((key, peers.index(order(value)) + 1))
    return sorted(ranked)


def ranks(spark, rows, within):
    df = spark.createDataFrame(rows, "key long, grp string, value double").repartition(3)
    ranked = add_dense_rank(df, "place", by="value", within=within)
    assert ranked.columns == ["key", "grp", "value", "place"]
    assert dict(ranked.dtypes)["place"] == "int"
    return sorted((r["key"], r["place"]) for r in ranked.collect())


def mixed_rows():
    pick = random.Random(5)
    special = [None, NAN, INF, -INF, 0.0, -0.0, 1e-9, -1e-9, 1e15, 1e15 + 0.25, -1e300, 1e300]
    values = special + [pick.uniform(-1e3, 1e3) for _ in range(150)]
    values += [pick.randint(0, 40) / 100 for _ in range(150)]
    values += [12.34] * 150  # one value holds a third of all rows
    return [(k, pick.choice(["a", "b", None]), v) for k, v in enumerate(values)]


def test_global_rank(spark):
    rows = [(k, "all", v) for k, _, v in mixed_rows()]
    assert ranks(spark, rows, []) == brute_force(rows)


def test_rank_within_groups_including_null(spark):
    rows = mixed_rows()
    assert ranks(spark, rows, ["grp"]) == brute_force(rows)


def test_no_rows(spark):
    assert ranks(spark, [], []) == []


def test_integer_values(spark):
    df = spark.createDataFrame([(1, 7), (2, 9), (3, 7), (4, 1)], "key long, n long")
    ranked = add_dense_rank(df, "place", by="n")
    assert {r["key"]: r["place"] for r in ranked.collect()} == {1: 2, 2: 1, 3: 2, 4: 3}


def test_helper_names_of_the_caller_survive(spark):
    df = spark.createDataFrame([(1, 7, "x"), (2, 9, "y")], "_at long, n long, _n_right string")
    ranked = add_dense_rank(df, "place", by="n")
    assert sorted(map(tuple, ranked.collect())) == [(1, 7, "x", 2), (2, 9, "y", 1)]


@pytest.mark.parametrize("value", ["1e9D + 0.01D * id", "1e-10D * id", "1e12D + 100 * id"])
def test_close_values_are_spread_over_all_tasks(spark, value):
    rows = spark.range(1_000_000).select(F.expr(value).alias("value"))
    staged, stage = [], ranking.stage

    def kept(df):
        staged.append(stage(df))
        return staged[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ranking, "stage", kept)
        ranked = add_dense_rank(rows, "place", by="value")
    # The task that numbered a value is in the upper bits of its number.
    tasks = staged[0].groupBy(F.shiftright("_at", 33)).count()
    sizes = [r["count"] for r in tasks.collect()]
    distinct = rows.distinct().count()
    assert len(sizes) >= 4
    assert max(sizes) < 0.5 * distinct
    assert ranked.agg(F.max("place")).first()[0] == distinct


def test_a_value_shared_by_a_third_of_the_rows_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(300_000).selectExpr(
            "uuid() AS id", "IF(id % 3 = 0, 0.5D, CAST(id AS DOUBLE)) AS value"
        )
        ranked = add_dense_rank(rows, "place", by="value")
        total = ranked.agg(F.count("id"), F.max("place"), F.max(F.length("id")))
        assert [tuple(row) for row in total.collect()] == [(300_000, 200_001, 36)]
        assert "skewed" in plan_of(total)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
