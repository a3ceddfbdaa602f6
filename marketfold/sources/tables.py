"""Read the inputs and write the results as Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Where the inputs live unless the caller names another table.
TRIPS_TABLE = "samples.nyctaxi.trips"
CUSTOMERS_TABLE = "samples.bakehouse.sales_customers"
TRANSACTIONS_TABLE = "samples.bakehouse.sales_transactions"
FRANCHISES_TABLE = "samples.bakehouse.sales_franchises"


def read(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table by its name, or a Parquet path (anything with a slash)."""
    return spark.read.parquet(source) if "/" in source else spark.read.table(source)


def read_trips(spark: SparkSession, table: str = TRIPS_TABLE) -> DataFrame:
    """Raw trips."""
    return read(spark, table)


def read_customers(spark: SparkSession, table: str = CUSTOMERS_TABLE) -> DataFrame:
    """Customer master rows."""
    return read(spark, table)


def read_transactions(spark: SparkSession, table: str = TRANSACTIONS_TABLE) -> DataFrame:
    """Sales transactions."""
    return read(spark, table)


def read_franchises(spark: SparkSession, table: str = FRANCHISES_TABLE) -> DataFrame:
    """Franchise locations."""
    return read(spark, table)


def table_name(*parts: str) -> str:
    """A qualified name with every part quoted."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in parts)


def prepare_schema(
    spark: SparkSession, catalog: str, schema: str, location: str | None = None
) -> None:
    """Make ``catalog`` current and create ``schema`` in it if it is missing."""
    spark.catalog.setCurrentCatalog(catalog)
    where = "" if location is None else " LOCATION '{}'".format(location.replace("'", "\\'"))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table_name(catalog, schema)}{where}")


def use_schema(spark: SparkSession, schema: str) -> None:
    """Make ``schema`` of the current catalog the default for unqualified names."""
    spark.catalog.setCurrentDatabase(schema)


def overwrite_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """Replace table ``name`` with ``df``; running it again gives the same table.

    With a ``location``, files there are replaced too that this catalog does not know of, such as
    those of an earlier session.
    """
    writer = df.write.mode("overwrite")
    (writer if location is None else writer.option("path", location)).saveAsTable(name)


def location_of(spark: SparkSession, catalog: str, schema: str, name: str) -> str:
    """Where table ``name`` lies by default: in its schema's folder."""
    folder = spark.catalog.getDatabase(table_name(catalog, schema)).locationUri
    return f"{folder.rstrip('/')}/{name.lower()}"


def count_rows(spark: SparkSession, name: str) -> int:
    """Rows of a written table, from the table itself rather than its query."""
    return spark.read.table(name).count()
