"""What the operators of this folder share: settings, staging in the shared folder and row keys."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketfold.session import checkpoint_dir

# Rows of whole texts that a Python worker holds at once.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the batches sent to Python and let the workers find this package.

    A cluster that installs the package on its workers needs no path; naming it does no harm.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    return spark


def read(spark: SparkSession, folder: str, table: str, schema: str) -> DataFrame:
    """The named columns of a Parquet table."""
    return spark.read.schema(schema).parquet(f"{folder}/{table}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(prepare(spark), folder, "documents", "doc_id LONG, text STRING")


def staged(df: DataFrame, *sort: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    This cuts the lineage: whatever is lost later is read again from storage that all executors
    share. Unlike a checkpoint the copy is columnar, compressed and read by column.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    (df.sortWithinPartitions(*sort) if sort else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(text_col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    """A column name as an identifier; it may hold a dot."""
    return "`" + name.replace("`", "``") + "`"
