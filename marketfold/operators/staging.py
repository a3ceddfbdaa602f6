"""Staged intermediates: aggregate once, then read the small result several times."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Row

from marketfold.session import checkpoint_dir


def stage(df: DataFrame) -> DataFrame:
    """Compute ``df`` now, write it as Parquet to the shared folder and read it back.

    Meant for aggregated rows that a query needs more than once. The source is scanned a single time,
    a lost executor costs no recomputation because the copy is on shared storage, and Spark knows the size
    of the copy when it plans joins with it. Runs one job a shuffle and one to write.

    The copy stays in the checkpoint folder of the session until that is cleared with the run.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, **totals: Column) -> tuple[DataFrame, Row]:
    """:func:`stage`, and aggregates over all its rows that are taken while it is written."""
    seen = Observation()
    staged = stage(df.observe(seen, *[total.alias(name) for name, total in totals.items()]))
    return staged, Row(**seen.get)
