"""Names, types and invariants of every result, over whole generated tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from helpers import TRANSACTION_SCHEMA, canonical, trip, trips
from marketfold import operators as ops
from marketfold.sources import star_schema

DATA = Path("/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")

VOLUME = "total_trips bigint, total_revenue double, avg_fare double"
AVERAGES = "avg_distance_miles double, avg_duration_minutes double, avg_tip_pct double"
SALES = """total_transactions bigint, total_quantity bigint, total_revenue double,
    avg_transaction_value double, avg_price_per_unit double"""
CONTRACTS = {
    "hourly_revenue": f"pickup_hour int, {VOLUME}, {AVERAGES}, revenue_per_trip double",
    "zone_revenue": f"pickup_zip string, {VOLUME}, {AVERAGES}, trips_per_revenue_dollar double",
    "daily_zone_stats": f"pickup_date date, pickup_zip string, {VOLUME}",
    "daily_zone_rolling": f"""pickup_date date, pickup_zip string, {VOLUME},
        rolling_7d_avg_revenue double""",
    "retention_report": "raw_trips bigint, clean_trips bigint, retained_pct double",
    "table_profile": "column_name string, row_count bigint, null_count bigint",
    "customer_geo": """country string, total_customers bigint, female_customers bigint,
        male_customers bigint, female_pct double""",
    "revenue_by_country": """country string, total_customers bigint, total_transactions bigint,
        total_revenue double, avg_transaction_value double, revenue_per_customer double""",
    "customer_360": """country string, total_customers bigint, female_customers bigint,
        female_pct double, total_revenue double, revenue_per_customer double, revenue_rank int""",
    "product_revenue": f"""product string, {SALES}, revenue_share_pct double, revenue_rank int""",
    "payment_breakdown": """paymentMethod string, total_transactions bigint, total_revenue double,
        avg_transaction_value double, revenue_share_pct double""",
    "transaction_summary": f"""product string, paymentMethod string, {SALES},
        payment_rank_within_product int""",
    "franchise_footprint": """country string, total_franchises bigint,
        pct_of_global_network double, country_rank int""",
    "size_by_country": """country string, size string, franchise_count bigint,
        size_rank_within_country int""",
    "franchise_analytics": """country string, size string, number_of_franchises bigint,
        country_total_franchises bigint, pct_within_country double, pct_of_global_network double,
        country_rank int""",
}


def run(spark, name):
    return registry.queries()[name](spark, str(DATA))


@pytest.mark.parametrize("name", CONTRACTS)
def test_columns_and_types(spark, name):
    wanted = [tuple(column.split()) for column in CONTRACTS[name].split(",")]
    assert run(spark, name).dtypes == wanted


@pytest.mark.parametrize(
    ("name", "rank", "measure"),
    [
        ("customer_360", "revenue_rank", "total_revenue"),
        ("product_revenue", "revenue_rank", "total_revenue"),
        ("franchise_footprint", "country_rank", "total_franchises"),
        ("franchise_analytics", "country_rank", "country_total_franchises"),
    ],
)
def test_ranks_have_no_gaps_and_rows_come_in_rank_order(spark, name, rank, measure):
    rows = run(spark, name).collect()
    found = [r[rank] for r in rows]
    assert found == sorted(found)
    assert set(found) == set(range(1, len(set(found)) + 1))
    measures = [r[measure] for r in rows]
    assert measures == sorted(measures, reverse=True)


@pytest.mark.parametrize(
    ("name", "share"),
    [
        ("product_revenue", "revenue_share_pct"),
        ("payment_breakdown", "revenue_share_pct"),
        ("franchise_footprint", "pct_of_global_network"),
    ],
)
def test_shares_add_up(spark, name, share):
    shares = [r[share] for r in run(spark, name).collect()]
    assert sum(shares) == pytest.approx(100, abs=0.005 * len(shares))


def test_reports_agree_on_trips_and_revenue(spark):
    trips_kept = run(spark, "clean_trips").count()
    hourly = run(spark, "hourly_revenue").toPandas()
    zones = run(spark, "zone_revenue").toPandas()
    daily = run(spark, "daily_zone_stats").toPandas()
    zoned = run(spark, "clean_trips").filter("pickup_zip IS NOT NULL")
    total = zoned.agg(F.sum("total_amount")).first()[0]
    assert hourly["total_trips"].sum() == trips_kept
    assert zones["total_trips"].sum() == daily["total_trips"].sum() == zoned.count()
    assert zones["total_revenue"].sum() == pytest.approx(total, abs=0.01)
    assert daily["total_revenue"].sum() == pytest.approx(total, abs=0.01)


def test_results_do_not_depend_on_how_rows_are_spread(spark):
    """As after a lost executor: the same rows in other partitions and another order."""

    def shuffled(df, seed):
        return df.repartition(3 + 4 * seed, F.rand(seed)).sortWithinPartitions(F.rand(seed + 1))

    folder = str(DATA)
    raw = star_schema.trips(spark, folder)
    people = star_schema.sales_customers(spark, folder)
    sales = star_schema.sales_transactions(spark, folder)
    # Awkward amounts: nothing here is a whole number of cents.
    raw = raw.withColumn("total_amount", F.col("total_amount") / 7)
    sales = sales.withColumn("totalPrice", F.col("totalPrice") / 7)
    reports = {
        "hourly": lambda s: ops.compute_hourly_revenue(ops.add_derived_columns(shuffled(raw, s))),
        "rolling": lambda s: ops.add_rolling_revenue(
            ops.compute_daily_zone_stats(ops.add_derived_columns(shuffled(raw, s)))
        ),
        "markets": lambda s: ops.customer_360(shuffled(people, s), shuffled(sales, s)),
        "summary": lambda s: ops.transaction_summary(shuffled(sales, s)),
        "payments": lambda s: ops.payment_breakdown(shuffled(sales, s)),
    }
    for name, report in reports.items():
        first, second = (canonical(report(seed).collect()) for seed in (1, 2))
        assert first == second, name


def test_decimal_amounts_and_integer_zips(spark):
    typed = trips(spark, trip(), trip(total_amount=22.5, tip_amount=None)).selectExpr(
        "* EXCEPT (fare_amount, tip_amount, total_amount, trip_distance, pickup_zip)",
        "CAST(fare_amount AS DECIMAL(10, 2)) AS fare_amount",
        "CAST(tip_amount AS DECIMAL(10, 2)) AS tip_amount",
        "CAST(total_amount AS DECIMAL(10, 2)) AS total_amount",
        "CAST(trip_distance AS FLOAT) AS trip_distance",
        "CAST(pickup_zip AS INT) AS pickup_zip",
    )
    enriched = ops.add_derived_columns(ops.clean_trips(typed))
    assert [tuple(r) for r in ops.compute_pickup_zone_revenue(enriched).collect()] == [
        (20815, 2, 55.0, 24.0, 7.2, 27.0, 25.0, 0.0364)
    ]
    prices = TRANSACTION_SCHEMA.replace("totalPrice double", "totalPrice decimal(12,2)")
    sales = spark.createDataFrame([], prices).union(
        spark.sql("SELECT 1L, 1L, 'p', 3L, 10.01BD, 'card' UNION ALL SELECT 2L, 1L, 'p', 0L, 1BD, 'x'")
    )
    assert [tuple(r) for r in ops.product_revenue(sales).collect()] == [
        ("p", 2, 3, 11.01, 5.51, 3.34, 100.0, 1)
    ]
