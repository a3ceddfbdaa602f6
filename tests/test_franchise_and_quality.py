from __future__ import annotations

import pytest

from helpers import FRANCHISE_SCHEMA, plan_of
from marketfold.operators import (
    franchise_analytics,
    franchise_footprint,
    size_by_country,
    table_profile,
)

PLACES = [
    *[("US", "L")] * 3,
    ("US", "S"),
    *[("Japan", "M")] * 2,
    *[("Japan", None)] * 2,
    ("Peru", "S"),
    (None, "S"),
]


@pytest.fixture(scope="module")
def franchises(spark):
    rows = [(k, *place) for k, place in enumerate(PLACES)]
    return spark.createDataFrame(rows, FRANCHISE_SCHEMA)


def test_footprint_ranks_ties_together_and_counts_unknown_countries(franchises):
    assert [tuple(r) for r in franchise_footprint(franchises).collect()] == [
        ("Japan", 4, 40.0, 1),
        ("US", 4, 40.0, 1),
        (None, 1, 10.0, 2),
        ("Peru", 1, 10.0, 2),
    ]


def test_sizes_within_a_country(franchises):
    assert [tuple(r) for r in size_by_country(franchises).collect()] == [
        (None, "S", 1, 1),
        ("Japan", None, 2, 1),
        ("Japan", "M", 2, 1),
        ("Peru", "S", 1, 1),
        ("US", "L", 3, 1),
        ("US", "S", 1, 2),
    ]


def test_analytics_leaves_out_unknown_countries_but_not_from_the_total(franchises):
    report = franchise_analytics(franchises)
    assert report.columns == [
        "country",
        "size",
        "number_of_franchises",
        "country_total_franchises",
        "pct_within_country",
        "pct_of_global_network",
        "country_rank",
    ]
    rows = [tuple(r) for r in report.collect()]
    assert rows == [
        ("Japan", None, 2, 4, 50.0, 20.0, 1),
        ("Japan", "M", 2, 4, 50.0, 20.0, 1),
        ("US", "L", 3, 4, 75.0, 30.0, 1),
        ("US", "S", 1, 4, 25.0, 10.0, 1),
        ("Peru", "S", 1, 1, 100.0, 10.0, 2),
    ]
    assert sum(r[5] for r in rows) == 90.0


def test_the_network_is_counted_without_a_cross_join(franchises):
    plan = plan_of(franchise_analytics(franchises))
    # The total was observed while the counts were staged: nothing reads them for it again.
    assert "Subquery" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_network(franchises):
    nobody = franchises.filter("false")
    for report in (franchise_footprint, size_by_country, franchise_analytics):
        assert report(nobody).collect() == []


def test_profile_counts_nulls_per_column(franchises):
    assert {tuple(r) for r in table_profile(franchises).collect()} == {
        ("franchise_id", 10, 0),
        ("country", 10, 1),
        ("size", 10, 2),
    }


def test_profile_of_odd_column_names_and_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c``d` int")
    assert {tuple(r) for r in table_profile(df).collect()} == {("a.b", 1, 0), ("c`d", 1, 1)}
    assert {tuple(r) for r in table_profile(df.filter("false")).collect()} == {
        ("a.b", 0, 0),
        ("c`d", 0, 0),
    }


def test_profile_scans_the_table_once(franchises):
    assert plan_of(table_profile(franchises)).count("Exchange SinglePartition") <= 1
