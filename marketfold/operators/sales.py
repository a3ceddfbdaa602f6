"""Customers, markets, products and payment methods.

Reports with ranks or shares of a total first aggregate the source once, stage that small result and
finish from there: calling them runs the aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from marketfold.functions import (
    amount_literal,
    amount_mean,
    amount_merge,
    amount_sum,
    amount_total,
    free_names,
    percent,
    ratio,
    split_amounts,
)
from marketfold.operators.ranking import add_dense_rank
from marketfold.operators.staging import stage, stage_observed


def customer_geo(customers: DataFrame) -> DataFrame:
    """Customers per country with the gender split; largest country first, NULL country included.

    Customers of another or unknown gender count in the total only.
    """
    return (
        customers.groupBy("country")
        .agg(
            F.count("*").alias("total_customers"),
            F.count_if(_gender_is("female")).alias("female_customers"),
            F.count_if(_gender_is("male")).alias("male_customers"),
        )
        .withColumn("female_pct", percent(F.col("female_customers"), F.col("total_customers"), 1))
        .orderBy(F.desc("total_customers"), "country")
    )


def revenue_by_country(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Revenue of each country's customers, highest first, NULL country included.

    Customers without transactions count; a country where nobody bought has NULL revenue.
    Transactions of unknown customers are left out.
    """
    return (
        _markets(customers, transactions)
        .select(
            "country",
            F.col("distinct_customers").alias("total_customers"),
            F.col("transactions").alias("total_transactions"),
            F.round(amount_total("revenue"), 2).alias("total_revenue"),
            F.round(amount_mean("revenue"), 2).alias("avg_transaction_value"),
            _revenue_per_customer(),
        )
        .orderBy(F.desc("total_revenue"), "country")
    )


def customer_360(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per known country: customers, female share, revenue and revenue rank.

    The rank compares rounded revenue; countries without revenue share the last rank. The customer
    count is of rows, while revenue per customer divides by distinct customers.
    """
    known = customers.filter(F.col("country").isNotNull())
    markets = stage(
        _markets(known, transactions).select(
            "country",
            F.col("customer_rows").alias("total_customers"),
            "female_customers",
            percent(F.col("female_customers"), F.col("customer_rows"), 1).alias("female_pct"),
            F.round(amount_total("revenue"), 2).alias("total_revenue"),
            _revenue_per_customer(),
        )
    )
    ranked = add_dense_rank(markets, "revenue_rank", by="total_revenue")
    return ranked.orderBy("revenue_rank", "country")


def product_revenue(transactions: DataFrame) -> DataFrame:
    """Sales per product with share of revenue and rank, best first.

    Share and rank compare rounded revenue.
    """
    products, totals = stage_observed(
        _sales_report(transactions, "product"), revenue=amount_sum("total_revenue")
    )
    shared = _with_share(products, F.col("total_revenue"), totals["revenue"])
    ranked = add_dense_rank(shared, "revenue_rank", by="total_revenue")
    return ranked.orderBy("revenue_rank", "product")


def payment_breakdown(transactions: DataFrame) -> DataFrame:
    """Sales per payment method with share of the unrounded revenue, highest revenue first."""
    methods, totals = stage_observed(
        split_amounts(transactions, "totalPrice")
        .groupBy("paymentMethod")
        .agg(
            F.count("*").alias("total_transactions"),
            amount_sum("totalPrice", split=True).alias("revenue"),
        ),
        revenue=amount_merge("revenue"),
    )
    revenue = amount_total("revenue")
    return _with_share(
        methods.select(
            "paymentMethod",
            "total_transactions",
            F.round(revenue, 2).alias("total_revenue"),
            F.round(amount_mean("revenue"), 2).alias("avg_transaction_value"),
            revenue.alias("exact_revenue"),
        ),
        F.col("exact_revenue"),
        totals["revenue"],
    ).drop("exact_revenue").orderBy(F.desc("total_revenue"), "paymentMethod")


def transaction_summary(transactions: DataFrame) -> DataFrame:
    """Sales per product and payment method, with each method's rank inside its product.

    The rank compares unrounded revenue.
    """
    pairs = stage(_sales_report(transactions, "product", "paymentMethod", keep=["exact_revenue"]))
    name = "payment_rank_within_product"
    ranked = add_dense_rank(pairs, name, by="exact_revenue", within=["product"])
    return ranked.drop("exact_revenue").orderBy("product", name, "paymentMethod")


def _with_share(rows: DataFrame, revenue: Column, observed: Row) -> DataFrame:
    """Append the share of ``revenue`` in a total observed while the rows were staged."""
    (total,) = free_names(rows, "_total")
    with_total = rows.withColumn(total, amount_literal(observed))
    return with_total.withColumn(
        "revenue_share_pct", percent(revenue, amount_total(total), 2)
    ).drop(total)


def _gender_is(gender: str) -> Column:
    return F.lower("gender") == gender


def _markets(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per country: customer rows, distinct and female customers, transactions and exact revenue.

    Both sides shrink to one row per customer before they meet. A customer with a third of all
    transactions, or a third of all customer rows, then reaches the join as a single row, and the
    distinct count needs no further pass: the rows are distinct by then. Repeated customer rows
    still count their revenue each time, through the row count they carry.
    """
    bought = transactions.filter(F.col("customer_id").isNotNull())
    spending = (
        split_amounts(bought, "totalPrice")
        .groupBy("customer_id")
        .agg(
            F.count("transaction_id").alias("transactions"),
            amount_sum("totalPrice", split=True).alias("revenue"),
        )
    )
    residents = customers.groupBy("customer_id", "country").agg(
        F.count("*").alias("customer_rows"),
        F.count_if(_gender_is("female")).alias("female_customers"),
    )
    return (
        residents.join(spending, "customer_id", "left")
        .groupBy("country")
        .agg(
            F.sum("customer_rows").alias("customer_rows"),
            F.count("customer_id").alias("distinct_customers"),
            F.sum("female_customers").alias("female_customers"),
            F.expr("COALESCE(SUM(transactions * customer_rows), 0)").alias("transactions"),
            amount_merge("revenue", times="customer_rows").alias("revenue"),
        )
    )


def _revenue_per_customer() -> Column:
    spent = amount_total("revenue")
    return ratio(spent, F.col("distinct_customers"), 2).alias("revenue_per_customer")


def _sales_report(
    transactions: DataFrame, *keys: str, keep: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """Counts, quantity, revenue and averages per ``keys``; a unit price needs a quantity."""
    unit_price = F.expr("TRY_DIVIDE(CAST(totalPrice AS DOUBLE), CAST(quantity AS DOUBLE))")
    priced = transactions.withColumn("unit_price", unit_price)
    sums = split_amounts(priced, "totalPrice", quotients=["unit_price"]).groupBy(*keys).agg(
        F.count("*").alias("total_transactions"),
        F.sum("quantity").alias("total_quantity"),
        amount_sum("totalPrice", split=True).alias("revenue"),
        amount_sum("unit_price", decimal=False, split=True).alias("unit_prices"),
    )
    return sums.withColumn("exact_revenue", amount_total("revenue")).select(
        *keys,
        "total_transactions",
        "total_quantity",
        F.round(F.col("exact_revenue"), 2).alias("total_revenue"),
        F.round(amount_mean("revenue"), 2).alias("avg_transaction_value"),
        F.round(amount_mean("unit_prices"), 2).alias("avg_price_per_unit"),
        *keep,
    )
