"""Trip records: cleaning, enrichment, and revenue by hour, zone and day.

Dates and hours follow the session time zone, so run with ``spark.sql.session.timeZone=UTC``.
Every grouping relies on Spark's map-side aggregation, so a zone that holds most of the trips still
sends only one partial row per task and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from marketfold.functions import (
    amount_mean,
    amount_merge,
    amount_sum,
    amount_total,
    free_names,
    percent,
    ratio,
    round_each,
    split_amounts,
)

# The bounds of a plausible trip, all exclusive, in miles and dollars.
SHORTEST_TRIP = 0.1
LONGEST_TRIP = 100
LOWEST_FARE = 0
HIGHEST_FARE = 500

# Weekday names, starting on the day that weekday() numbers 0.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Fixed value: days in the rolling average, counting the day itself.
ROLLING_DAYS = 7

# What the hourly and zone reports sum and average. Durations and tips enter as rounded per trip.
MEASURES = ("total_amount", "fare_amount", "trip_distance", "trip_duration_minutes", "tip_pct")


def is_plausible_trip() -> Column:
    """True for the trips worth keeping; false or NULL for all others.

    A comparison is never true for NULL, and NaN is above every bound, so the range tests also remove
    missing values. Only the total needs a test of its own.
    """
    return (
        (F.col("trip_distance") > SHORTEST_TRIP)
        & (F.col("trip_distance") < LONGEST_TRIP)
        & (F.col("fare_amount") > LOWEST_FARE)
        & (F.col("fare_amount") < HIGHEST_FARE)
        & (F.col("tpep_dropoff_datetime") > F.col("tpep_pickup_datetime"))
        & F.col("total_amount").isNotNull()
        & ~F.isnan("total_amount")
    )


def clean_trips(df: DataFrame) -> DataFrame:
    """Keep the trips that pass :func:`is_plausible_trip`, with all their columns."""
    return df.filter(is_plausible_trip())


def add_derived_columns(df: DataFrame) -> DataFrame:
    """Append duration, speed, tip percentage, pickup date and hour, and weekday name.

    The duration counts whole seconds on both ends. The speed uses the unrounded duration and is NULL
    if there is none. The tip percentage is 0 without a positive fare, NULL without a known tip.
    """
    # The helper columns are used several times each, so they are computed in a step of their own.
    minutes, tip, mph = free_names(df, "_minutes", "_tip", "_mph")
    timed = df.withColumns(
        {
            minutes: F.expr(
                "(unix_timestamp(tpep_dropoff_datetime) - unix_timestamp(tpep_pickup_datetime))"
                " / 60D"
            ),
            tip: F.expr("TRY_DIVIDE(tip_amount, fare_amount) * 100D"),
        }
    ).withColumn(mph, F.expr(f"TRY_DIVIDE(trip_distance, {minutes} / 60D)"))
    weekdays = F.array(*[F.lit(day) for day in WEEKDAYS])
    return timed.withColumns(
        {
            "trip_duration_minutes": round_each(minutes, 2),
            "speed_mph": F.when(F.col(minutes) > 0, round_each(mph, 2)),
            "tip_pct": F.when(F.col("fare_amount") > 0, round_each(tip, 2)).otherwise(0.0),
            "pickup_date": F.to_date("tpep_pickup_datetime"),
            "pickup_hour": F.hour("tpep_pickup_datetime"),
            "day_of_week": F.element_at(weekdays, F.expr("WEEKDAY(tpep_pickup_datetime) + 1")),
        }
    ).drop(minutes, tip, mph)


def compute_hourly_revenue(df: DataFrame) -> DataFrame:
    """Trips, revenue and averages per pickup hour, in hour order."""
    return hourly_report(tally(split_amounts(df, *MEASURES).groupBy("pickup_hour")))


def compute_pickup_zone_revenue(df: DataFrame) -> DataFrame:
    """Trips, revenue and averages per pickup zip, highest revenue first; no row for a NULL zip."""
    zoned = split_amounts(df.filter(F.col("pickup_zip").isNotNull()), *MEASURES)
    return zone_report(tally(zoned.groupBy("pickup_zip")))


def compute_daily_zone_stats(df: DataFrame) -> DataFrame:
    """Trips, revenue and average fare per pickup date and zip; no row for a NULL zip."""
    measures = ("total_amount", "fare_amount")
    zoned = split_amounts(df.filter(F.col("pickup_zip").isNotNull()), *measures)
    return daily_report(tally(zoned.groupBy("pickup_date", "pickup_zip"), measures))


def add_rolling_revenue(df: DataFrame) -> DataFrame:
    """Append each zip's average daily revenue over the last seven calendar days.

    Days without a row are left out of the average, not counted as zero. The frame is a range of
    dates, so a gap never lets an older day in. One zip has at most one row per day, which bounds
    what a task has to order.

    Daily revenues are rounded, so one decimal sum adds them without error. Only a frame with a revenue that is
    no such decimal (from 1e20 on, infinite, NaN) has a plain average.
    """
    last_days = f"""OVER (PARTITION BY pickup_zip ORDER BY UNIX_DATE(pickup_date)
        RANGE BETWEEN {ROLLING_DAYS - 1} PRECEDING AND CURRENT ROW)"""
    (fixed,) = free_names(df, "_fixed")
    mean = f"""IF(COUNT(`{fixed}`) {last_days} = COUNT(total_revenue) {last_days},
        TRY_DIVIDE(CAST(SUM(`{fixed}`) {last_days} AS DOUBLE), COUNT(total_revenue) {last_days}),
        AVG(total_revenue) {last_days})"""
    return (
        df.withColumn(fixed, F.expr("TRY_CAST(total_revenue AS DECIMAL(28, 8))"))
        .withColumn("rolling_7d_avg_revenue", F.round(F.expr(mean), 2))
        .drop(fixed)
    )


def retention_report(df: DataFrame) -> DataFrame:
    """One row from one scan: raw trips, plausible trips and the percentage kept, NULL for no trips."""
    counts = df.agg(
        F.count("*").alias("raw_trips"), F.count_if(is_plausible_trip()).alias("clean_trips")
    )
    kept = percent(F.col("clean_trips"), F.col("raw_trips"), 1)
    return counts.withColumn("retained_pct", kept)


# The reports read tallies: a trip count and a partial sum per measure. Tallies of finer groups add
# up to those of coarser ones without loss, so one pass over the trips can serve several reports.


def tally(
    groups: GroupedData, measures: Sequence[str] = MEASURES, **extra: Column
) -> DataFrame:
    """Count trips and sum ``measures``, split before, per group; ``extra`` names further aggregates."""
    return groups.agg(
        F.count("*").alias("trips"),
        *[amount_sum(name, split=True).alias(name) for name in measures],
        *[column.alias(name) for name, column in extra.items()],
    )


def add_up(groups: GroupedData, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Combine tallies into coarser groups."""
    return groups.agg(
        F.sum("trips").alias("trips"),
        *[amount_merge(name).alias(name) for name in measures],
    )


def hourly_report(tallies: DataFrame) -> DataFrame:
    """The hourly table from tallies per ``pickup_hour``."""
    per_trip = ratio(amount_total("total_amount"), F.col("trips"), 2)
    return tallies.select(
        "pickup_hour", *_revenue_columns(), per_trip.alias("revenue_per_trip")
    ).orderBy("pickup_hour")


def zone_report(tallies: DataFrame) -> DataFrame:
    """The zone table from tallies per ``pickup_zip``; a zone without revenue has no trip ratio."""
    per_dollar = ratio(F.col("trips"), amount_total("total_amount"), 4)
    return tallies.select(
        "pickup_zip", *_revenue_columns(), per_dollar.alias("trips_per_revenue_dollar")
    ).orderBy(F.desc("total_revenue"), "pickup_zip")


def daily_report(tallies: DataFrame) -> DataFrame:
    """The daily table from tallies per ``pickup_date`` and ``pickup_zip``."""
    return tallies.select("pickup_date", "pickup_zip", *_volume_columns())


def _volume_columns() -> list[Column]:
    return [
        F.col("trips").alias("total_trips"),
        F.round(amount_total("total_amount"), 2).alias("total_revenue"),
        _average("fare_amount", 2).alias("avg_fare"),
    ]


def _revenue_columns() -> list[Column]:
    return [
        *_volume_columns(),
        _average("trip_distance", 2).alias("avg_distance_miles"),
        _average("trip_duration_minutes", 1).alias("avg_duration_minutes"),
        _average("tip_pct", 2).alias("avg_tip_pct"),
    ]


def _average(measure: str, places: int) -> Column:
    return F.round(amount_mean(measure), places)
