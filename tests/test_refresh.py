from __future__ import annotations

import datetime as dt
import random

import pytest

from helpers import (
    CUSTOMER_SCHEMA,
    FRANCHISE_SCHEMA,
    PICKUP,
    TRANSACTION_SCHEMA,
    canonical,
    trip,
    trips,
)
from marketfold import operators as ops
from marketfold.plans import refresh
from marketfold.sources import tables

CATALOG = "spark_catalog"


@pytest.fixture(scope="module")
def trip_table(spark):
    pick = random.Random(2)
    rows = [
        trip(
            tpep_pickup_datetime=(start := PICKUP + dt.timedelta(minutes=pick.randrange(20_000))),
            tpep_dropoff_datetime=start + dt.timedelta(seconds=pick.randrange(-300, 5000)),
            trip_distance=pick.choice([None, 0.0, pick.randrange(1, 12_000) / 100]),
            fare_amount=pick.randrange(-500, 60_000) / 100,
            tip_amount=pick.choice([None, 0.0, pick.randrange(2000) / 100]),
            total_amount=pick.choice([None, *[pick.randrange(70_000) / 100 for _ in range(9)]]),
            # one zip holds a third of the trips
            pickup_zip=pick.choice(["10001"] * 4 + [None] + [str(10002 + k) for k in range(7)]),
        )
        for _ in range(2000)
    ]
    trips(spark, *rows).write.mode("overwrite").saveAsTable("default.raw_trips")
    return "default.raw_trips"


def table(spark, schema, name):
    return spark.read.table(f"{CATALOG}.{schema}.{name}")


def test_trip_pipeline_writes_what_the_reports_give(spark, trip_table):
    done = refresh.run_pipeline(spark, CATALOG, "city", table=trip_table)
    raw = tables.read_trips(spark, trip_table)
    enriched = ops.add_derived_columns(ops.clean_trips(raw))
    expected = {
        "trips_enriched": enriched,
        "hourly_revenue": ops.compute_hourly_revenue(enriched),
        "zone_revenue": ops.compute_pickup_zone_revenue(enriched),
        "daily_zone_rolling": ops.add_rolling_revenue(ops.compute_daily_zone_stats(enriched)),
    }
    for name, report in expected.items():
        written = table(spark, "city", name)
        assert written.dtypes == report.dtypes
        assert canonical(written.collect()) == canonical(report.collect()), name
        assert done.rows_written[name] == written.count()
    assert done.raw_trips == 2000
    assert done.clean_trips == enriched.count()
    assert done.retained_pct == round(100 * done.clean_trips / 2000, 1)


def test_trip_pipeline_can_run_again(spark, trip_table):
    first = refresh.run_pipeline(spark, CATALOG, "again", table=trip_table)
    before = canonical(table(spark, "again", "daily_zone_rolling").collect())
    assert refresh.run_pipeline(spark, CATALOG, "again", table=trip_table) == first
    assert canonical(table(spark, "again", "daily_zone_rolling").collect()) == before


def test_summaries_agree_on_their_totals(spark, trip_table):
    done = refresh.run_pipeline(spark, CATALOG, "totals", table=trip_table)
    hourly = table(spark, "totals", "hourly_revenue").toPandas()
    zones = table(spark, "totals", "zone_revenue").toPandas()
    days = table(spark, "totals", "daily_zone_rolling").toPandas()
    assert hourly["total_trips"].sum() == done.clean_trips
    assert zones["total_trips"].sum() == days["total_trips"].sum()
    assert zones["total_revenue"].sum() == pytest.approx(days["total_revenue"].sum(), abs=0.01)


def test_trip_pipeline_of_no_trips(spark, trip_table):
    spark.read.table(trip_table).filter("false").createOrReplaceTempView("no_trips")
    done = refresh.run_pipeline(spark, CATALOG, "empty", table="no_trips")
    assert (done.raw_trips, done.clean_trips, done.retained_pct) == (0, 0, None)
    assert set(done.rows_written.values()) == {0}


def test_sales_refreshes_write_their_tables(spark):
    customers = spark.createDataFrame([(1, "A", "female"), (2, "B", "male")], CUSTOMER_SCHEMA)
    transactions = spark.createDataFrame(
        [(1, 1, "p", 2, 5.5, "card"), (2, 2, "q", 1, 7.0, "cash"), (3, 2, "q", 1, 2.0, "card")],
        TRANSACTION_SCHEMA,
    )
    franchises = spark.createDataFrame([(1, "A", "S"), (2, "B", "L")], FRANCHISE_SCHEMA)
    for name, df in (("c", customers), ("t", transactions), ("f", franchises)):
        df.write.mode("overwrite").saveAsTable(f"default.in_{name}")
    try:
        for _ in range(2):
            assert (
                refresh.refresh_customer_360(
                    spark, CATALOG, "shop", "default.in_c", "default.in_t"
                )
                == 2
            )
            assert refresh.refresh_transaction_summary(spark, CATALOG, "shop", "default.in_t") == 3
            assert refresh.refresh_franchise_analytics(spark, CATALOG, "shop", "default.in_f") == 2
        assert spark.catalog.currentDatabase() == "shop"
    finally:
        tables.use_schema(spark, "default")
    for name, report in (
        ("customer_360", ops.customer_360(customers, transactions)),
        ("transaction_summary", ops.transaction_summary(transactions)),
        ("franchise_analytics", ops.franchise_analytics(franchises)),
    ):
        written = table(spark, "shop", name)
        assert written.dtypes == report.dtypes
        assert canonical(written.collect()) == canonical(report.collect())


def test_inputs_are_read_by_name_or_path(spark, scratch, trip_table):
    path = str(scratch / "trips_by_path")
    spark.read.table(trip_table).write.mode("overwrite").parquet(path)
    assert tables.read_trips(spark, path).count() == 2000
    assert tables.read_trips(spark, trip_table).count() == 2000
    for reader in (tables.read_customers, tables.read_transactions, tables.read_franchises):
        assert reader(spark, path).columns == spark.read.table(trip_table).columns


def test_schema_and_table_names_are_quoted(spark, scratch):
    tables.prepare_schema(spark, CATALOG, "2024", location=str(scratch / "it's"))
    tables.prepare_schema(spark, CATALOG, "2024")
    name = tables.table_name(CATALOG, "2024", "7days")
    tables.overwrite_table(spark.range(3), name)
    assert tables.count_rows(spark, name) == 3
