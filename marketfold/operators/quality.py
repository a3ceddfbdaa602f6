"""Table checks that replace looking at a preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: its name, the table's rows and the column's nulls, in one scan.

    Nulls are counted as rows less values present, and columns become rows only after the single
    aggregated row exists.
    """
    # Counters go by position: a column name may hold any character.
    counters = [
        F.count(F.col(f"`{name.replace('`', '``')}`")).alias(f"present_{place}")
        for place, name in enumerate(df.columns)
    ]
    counts = df.agg(F.count("*").alias("row_count"), *counters)
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                (F.col("row_count") - F.col(f"present_{place}")).alias("null_count"),
            )
            for place, name in enumerate(df.columns)
        ]
    )
    return counts.select("row_count", F.inline(lines)).select(
        "column_name", "row_count", "null_count"
    )
