"""Every registered query against its SQL form, run by another engine on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from helpers import canonical, plan_of

DATA = Path("/root/testdata/sf0.01")
SMALL = Path("/root/testdata/sf0.001")

# The text operators, which can be left out, have tests of their own.
REPORTS = [n for n in registry.queries() if not n.startswith("op") and n != "pipeline"]

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def other_engine():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", REPORTS)
def test_query_equals_its_sql(spark, other_engine, name):
    df = registry.queries()[name](spark, str(DATA))
    answer = other_engine.execute(registry.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    assert columns == df.columns
    assert canonical(df.collect()) == canonical(answer.fetchall())


def test_every_query_has_a_sql_form():
    assert set(REPORTS) <= registry.oracle_sql().keys() <= registry.queries().keys()


def test_entry_returns_rows(spark):
    assert registry.entry(spark).count() == 24


@pytest.mark.parametrize("name", REPORTS)
def test_plans_stay_distributed_and_inside_spark(spark, name):
    plan = plan_of(registry.queries()[name](spark, str(SMALL)))
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow"):
        assert unwanted not in plan


def test_empty_inputs_give_empty_reports(spark, scratch):
    folder = scratch / "empty"
    for file in SMALL.glob("*.parquet"):
        spark.read.parquet(str(file)).limit(0).write.mode("overwrite").parquet(
            str(folder / file.name)
        )
    one_row_each = {"retention_report": 1, "table_profile": 8, "sales_profile": 12}
    for name in REPORTS:
        report = registry.queries()[name](spark, str(folder))
        assert report.count() == one_row_each.get(name, 0), name


REFRESHES = {
    "trip_pipeline": "daily_zone_rolling",
    "customer_360_refresh": "customer_360",
    "transaction_summary_refresh": "transaction_summary",
    "franchise_analytics_refresh": "franchise_analytics",
}


@pytest.mark.parametrize("name", REFRESHES)
def test_a_refresh_replaces_what_the_one_before_wrote(spark, scratch, name):
    query = registry.queries()[name]
    query(spark, str(DATA)).count()
    schemas = {s.name for s in spark.catalog.listDatabases()}
    small = canonical(query(spark, str(SMALL)).collect())
    assert {s.name for s in spark.catalog.listDatabases()} == schemas
    table = spark.read.table(f"{registry.REFRESHED}.{REFRESHES[name]}")
    assert canonical(table.collect()) == small
    (file, *_) = table.inputFiles()
    assert str(scratch / "warehouse") in file
    assert spark.catalog.currentDatabase() == "default"
