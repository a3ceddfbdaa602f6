"""The refresh jobs: read the inputs, build the reports, overwrite the result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketfold.functions import split_amounts
from marketfold.operators import sales, trips
from marketfold.operators.franchise import franchise_analytics
from marketfold.operators.staging import stage
from marketfold.sources import tables


@dataclass(frozen=True)
class TripRefresh:
    """What a trip refresh read, kept and wrote."""

    raw_trips: int
    clean_trips: int
    rows_written: dict[str, int]

    @property
    def retained_pct(self) -> float | None:
        """Percentage of the raw trips kept, to one decimal; None if there were none."""
        return round(100 * self.clean_trips / self.raw_trips, 1) if self.raw_trips else None


def run_pipeline(
    spark: SparkSession, catalog: str, schema: str, table: str = tables.TRIPS_TABLE
) -> TripRefresh:
    """Refresh ``trips_enriched``, ``hourly_revenue``, ``zone_revenue`` and ``daily_zone_rolling``.

    The source is scanned once: counts of raw and clean trips are observed while the enriched table
    is written. That table is then scanned once for all three summaries.
    """
    tables.prepare_schema(spark, catalog, schema)
    names = {
        name: tables.table_name(catalog, schema, name)
        for name in ("trips_enriched", "hourly_revenue", "zone_revenue", "daily_zone_rolling")
    }

    seen = Observation("trips")
    raw = tables.read_trips(spark, table).observe(
        seen,
        F.count(F.lit(1)).alias("raw"),
        F.count_if(trips.is_plausible_trip()).alias("clean"),
    )
    enriched = trips.add_derived_columns(trips.clean_trips(raw))
    places = {name: tables.location_of(spark, catalog, schema, name) for name in names}
    tables.overwrite_table(enriched, names["trips_enriched"], places["trips_enriched"])

    for name, report in summarise_trips(spark.read.table(names["trips_enriched"])).items():
        tables.overwrite_table(report, names[name], places[name])

    counts = seen.get
    rows = {"trips_enriched": counts["clean"]}
    for name in ("hourly_revenue", "zone_revenue", "daily_zone_rolling"):
        rows[name] = tables.count_rows(spark, names[name])
    return TripRefresh(counts["raw"], counts["clean"], rows)


def summarise_trips(enriched: DataFrame) -> dict[str, DataFrame]:
    """The three summary tables from one scan of the enriched trips.

    Trips are tallied by hour and by (date, zip) in the same aggregation and the tallies staged; the
    zone summary adds up the days of a zip instead of going back to the trips.
    """
    tallies = stage(
        trips.tally(
            split_amounts(enriched, *trips.MEASURES).groupingSets(
                [["pickup_hour"], ["pickup_date", "pickup_zip"]],
                "pickup_hour",
                "pickup_date",
                "pickup_zip",
            ),
            by_hour=F.grouping("pickup_hour") == 0,
        )
    )
    hours = tallies.filter("by_hour")
    zone_days = tallies.filter("NOT by_hour AND pickup_zip IS NOT NULL")
    return {
        "hourly_revenue": trips.hourly_report(hours),
        "zone_revenue": trips.zone_report(trips.add_up(zone_days.groupBy("pickup_zip"))),
        "daily_zone_rolling": trips.add_rolling_revenue(trips.daily_report(zone_days)),
    }


def refresh_customer_360(
    spark: SparkSession,
    catalog: str,
    schema: str,
    customers: str = tables.CUSTOMERS_TABLE,
    transactions: str = tables.TRANSACTIONS_TABLE,
) -> int:
    """Refresh table ``customer_360``; returns its rows."""
    report = sales.customer_360(
        tables.read_customers(spark, customers), tables.read_transactions(spark, transactions)
    )
    return _replace(spark, report, catalog, schema, "customer_360")


def refresh_transaction_summary(
    spark: SparkSession, catalog: str, schema: str, transactions: str = tables.TRANSACTIONS_TABLE
) -> int:
    """Refresh table ``transaction_summary``; returns its rows."""
    report = sales.transaction_summary(tables.read_transactions(spark, transactions))
    return _replace(spark, report, catalog, schema, "transaction_summary")


def refresh_franchise_analytics(
    spark: SparkSession, catalog: str, schema: str, franchises: str = tables.FRANCHISES_TABLE
) -> int:
    """Refresh table ``franchise_analytics``; returns its rows."""
    report = franchise_analytics(tables.read_franchises(spark, franchises))
    return _replace(spark, report, catalog, schema, "franchise_analytics")


def _replace(spark: SparkSession, report: DataFrame, catalog: str, schema: str, name: str) -> int:
    tables.prepare_schema(spark, catalog, schema)
    tables.use_schema(spark, schema)
    target = tables.table_name(catalog, schema, name)
    tables.overwrite_table(report, target, tables.location_of(spark, catalog, schema, name))
    return tables.count_rows(spark, target)
