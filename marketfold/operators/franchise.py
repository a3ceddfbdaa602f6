"""The franchise network by country and outlet size.

Each report counts the source once, stages the counts and finishes from there: calling it runs the
count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketfold.functions import percent
from marketfold.operators.ranking import add_dense_rank
from marketfold.operators.staging import stage, stage_observed


def franchise_footprint(franchises: DataFrame) -> DataFrame:
    """Franchises per country with global share and rank; a NULL country is ranked as well."""
    counts, totals = stage_observed(
        franchises.groupBy("country").agg(F.count("*").alias("total_franchises")),
        network=F.sum("total_franchises"),
    )
    share = percent(F.col("total_franchises"), F.lit(totals["network"]), 2)
    ranked = add_dense_rank(
        counts.withColumn("pct_of_global_network", share), "country_rank", by="total_franchises"
    )
    return ranked.orderBy("country_rank", "country")


def size_by_country(franchises: DataFrame) -> DataFrame:
    """Franchises per country and size with the size's rank in its country; NULLs are groups."""
    counts = stage(
        franchises.groupBy("country", "size").agg(F.count("*").alias("franchise_count"))
    )
    name = "size_rank_within_country"
    ranked = add_dense_rank(counts, name, by="franchise_count", within=["country"])
    return ranked.orderBy("country", name, "size")


def franchise_analytics(franchises: DataFrame) -> DataFrame:
    """Franchises per country and size with both shares and the country's global rank.

    Rows without a country are left out, but they belong to the global total, so the global shares
    may add up to less than 100.
    """
    number = F.col("number_of_franchises")
    counts, seen = stage_observed(
        franchises.groupBy("country", "size").agg(F.count("*").alias("number_of_franchises")),
        network=F.sum(number),
    )
    network = F.lit(seen["network"])
    totals = (
        counts.filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.sum(number).alias("country_total_franchises"))
    )
    ranked = add_dense_rank(totals, "country_rank", by="country_total_franchises")
    country_total = F.col("country_total_franchises")
    return (
        counts.join(ranked, "country")
        .select(
            "country",
            "size",
            "number_of_franchises",
            "country_total_franchises",
            percent(number, country_total, 2).alias("pct_within_country"),
            percent(number, network, 2).alias("pct_of_global_network"),
            "country_rank",
        )
        .orderBy("country_rank", "country", F.desc("number_of_franchises"), "size")
    )
