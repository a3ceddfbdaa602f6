"""The trip, sales and franchise inputs derived from a star schema of Parquet files.

These views let every report run over generated order and event tables of any size. They use all rows
of their tables. A few values are turned into NULL, zero or mixed case on purpose, so that the rules
for such values are exercised on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns read from each table. Declaring them spares a look into the files before every query.
COLUMNS = {
    "customer": "c_custkey LONG, c_nationkey INT, c_mktsegment STRING",
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE",
    "lineitem": """l_orderkey LONG, l_partkey LONG, l_quantity DOUBLE, l_extendedprice DOUBLE,
        l_returnflag STRING""",
    "nation": "n_nationkey INT, n_name STRING",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderpriority STRING",
    "part": "p_partkey LONG, p_type STRING",
    "supplier": "s_suppkey LONG, s_nationkey INT, s_acctbal DOUBLE",
}


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips from ``events``: some end before they start, some lack a zip or a tip."""
    zone = "user_id % 50"
    return _table(spark, folder, "events").selectExpr(
        "ts AS tpep_pickup_datetime",
        "timestampadd(MINUTE, CAST(event_id % 121 - 5 AS INT), ts) AS tpep_dropoff_datetime",
        "CAST(event_id * 7 % 1100 AS DOUBLE) / 7 AS trip_distance",
        "CAST(CAST(value AS DECIMAL(18,2)) * 2 AS DOUBLE) AS fare_amount",
        """CASE event_type WHEN 'error' THEN NULL
             WHEN 'purchase' THEN CAST(CAST(value AS DECIMAL(18,2)) / 4 AS DOUBLE)
             ELSE 0D END AS tip_amount""",
        "0D AS tolls_amount",
        "value AS total_amount",
        f"IF({zone} = 49, NULL, CAST(10001 + {zone} AS STRING)) AS pickup_zip",
    )


def sales_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions from order lines; a returned line counts no units."""
    lines = _table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS transaction_id",
        "l_partkey AS p_partkey",
        "IF(l_returnflag = 'R', 0L, CAST(l_quantity AS BIGINT)) AS quantity",
        "l_extendedprice AS totalPrice",
    )
    orders = _table(spark, folder, "orders").selectExpr(
        "o_orderkey AS transaction_id",
        "o_custkey AS customer_id",
        "o_orderpriority AS paymentMethod",
    )
    parts = _table(spark, folder, "part").selectExpr("p_partkey", "p_type AS product")
    return (
        lines.join(orders, "transaction_id")
        .join(parts, "p_partkey")
        .select(
            "transaction_id", "customer_id", "product", "quantity", "totalPrice", "paymentMethod"
        )
    )


def sales_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers from ``customer`` and ``supplier``: suppliers are customers who never bought."""
    buyers = _table(spark, folder, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_nationkey AS n_nationkey",
        """CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'Female'
             WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'male' END AS gender""",
    )
    prospects = _table(spark, folder, "supplier").selectExpr(
        "-s_suppkey AS customer_id", "s_nationkey AS n_nationkey", "'FEMALE' AS gender"
    )
    return (
        buyers.unionByName(prospects)
        .join(_countries(spark, folder), "n_nationkey")
        .select("customer_id", "country", "gender")
    )


def sales_franchises(spark: SparkSession, folder: str) -> DataFrame:
    """Franchises from ``supplier``: the size follows the balance, unknown if that is negative."""
    outlets = _table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS franchise_id",
        "s_nationkey AS n_nationkey",
        """CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 2500 THEN 'S'
             WHEN s_acctbal < 6000 THEN 'M' ELSE 'L' END AS size""",
    )
    return outlets.join(_countries(spark, folder), "n_nationkey").select(
        "franchise_id", "country", "size"
    )


def _countries(spark: SparkSession, folder: str) -> DataFrame:
    # One nation stands for "country not known".
    nation = _table(spark, folder, "nation")
    return nation.select("n_nationkey", F.expr("NULLIF(n_name, 'NATION_7') AS country"))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")
