from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from helpers import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA, by_key, canonical, steps_of
from marketfold.operators import (
    customer_360,
    customer_geo,
    payment_breakdown,
    product_revenue,
    revenue_by_country,
    transaction_summary,
)

CUSTOMERS = [
    (1, "France", "Female"),
    (2, "France", "MALE"),
    (3, "France", "other"),
    (3, "France", "female"),  # repeated customer row
    (4, "Japan", None),
    (5, "Japan", "FEMALE"),
    (6, None, "male"),
    (None, "Peru", "female"),  # never matches a transaction
    (7, "Chad", "female"),
]
TRANSACTIONS = [
    (1, 1, "bread", 2, 10.0, "card"),
    (2, 1, "bread", 0, 5.55, "cash"),  # no unit price
    (3, 2, "cake", 4, 30.0, "card"),
    (4, 3, "cake", 1, 7.25, "card"),
    (5, 4, "tart", 3, None, "cash"),
    (6, 6, "tart", 5, 20.0, None),
    (7, 99, None, 2, 4.0, "cash"),  # unknown customer, unknown product
    (8, None, "bread", 1, 15.55, "voucher"),  # anonymous sale
    (None, 5, "cake", 2, 8.0, "cash"),  # transaction without a number
]


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, CUSTOMER_SCHEMA)


@pytest.fixture(scope="module")
def transactions(spark):
    return spark.createDataFrame(TRANSACTIONS, TRANSACTION_SCHEMA)


def half_up(value, places):
    if value is None:
        return None
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def exact(values):
    values = [Decimal(repr(v)) for v in values if v is not None]
    return float(sum(values)) if values else None


def mean(values):
    values = [v for v in values if v is not None]
    return exact(values) / len(values) if values else None


def dense_rank(values):
    levels = sorted({v for v in values if v is not None}, reverse=True)
    places = {v: place + 1 for place, v in enumerate(levels)}
    return [places.get(v, len(levels) + 1) for v in values]


def left_join(customer_rows, transaction_rows):
    matches = defaultdict(list)
    for row in transaction_rows:
        matches[row[1]].append(row)
    for customer in customer_rows:
        found = matches[customer[0]] if customer[0] is not None else []
        for transaction in found or [None]:
            yield customer, transaction


def expected_revenue_by_country(customer_rows, transaction_rows):
    groups = defaultdict(list)
    for customer, transaction in left_join(customer_rows, transaction_rows):
        groups[customer[1]].append((customer, transaction))
    out = []
    for country, pairs in groups.items():
        people = {c[0] for c, _ in pairs if c[0] is not None}
        prices = [t[4] for _, t in pairs if t]
        total = exact(prices)
        each = total / len(people) if people and total is not None else None
        out.append(
            (
                country,
                len(people),
                sum(1 for _, t in pairs if t and t[0] is not None),
                half_up(total, 2),
                half_up(mean(prices), 2),
                half_up(each, 2),
            )
        )
    return out


def test_gender_split_per_country(customers):
    rows = [tuple(r) for r in customer_geo(customers).collect()]
    assert rows == [
        ("France", 4, 2, 1, 50.0),
        ("Japan", 2, 1, 0, 50.0),
        (None, 1, 0, 1, 0.0),
        ("Chad", 1, 1, 0, 100.0),
        ("Peru", 1, 1, 0, 100.0),
    ]


def test_revenue_by_country_against_a_row_by_row_join(customers, transactions):
    report = revenue_by_country(customers, transactions)
    assert canonical(report.collect()) == canonical(
        expected_revenue_by_country(CUSTOMERS, TRANSACTIONS)
    )
    rows = by_key(report, "country")
    # Repeated customer rows repeat their revenue but count once.
    assert rows["France"]["total_customers"] == 3
    assert rows["France"]["total_transactions"] == 5
    assert rows["France"]["total_revenue"] == 60.05
    # Nobody bought, or bought without a price.
    assert rows["Chad"]["total_transactions"] == 0 and rows["Chad"]["total_revenue"] is None
    assert rows["Peru"]["revenue_per_customer"] is None
    assert rows["Japan"]["total_revenue"] == 8.0


def test_revenue_by_country_on_skewed_random_rows(spark):
    pick = random.Random(11)
    customer_rows = [
        (pick.choice([None, *range(40)]), pick.choice(["A", "B", "C", None]), None)
        for _ in range(300)
    ]
    customer_rows += [(7, "A", "female")] * 150  # one customer holds a third of the rows
    transaction_rows = [
        (
            k,
            7 if pick.random() < 0.4 else pick.choice([None, *range(60)]),
            "p",
            1,
            pick.choice([None, pick.randint(1, 99999) / 100]),
            "card",
        )
        for k in range(600)
    ]
    report = revenue_by_country(
        spark.createDataFrame(customer_rows, CUSTOMER_SCHEMA),
        spark.createDataFrame(transaction_rows, TRANSACTION_SCHEMA),
    )
    assert canonical(report.collect()) == canonical(
        expected_revenue_by_country(customer_rows, transaction_rows)
    )


def test_both_sides_shrink_to_one_row_per_customer_before_the_join(
    spark, customers, transactions
):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        steps = steps_of(revenue_by_country(customers, transactions))
    finally:
        spark.conf.set(threshold, before)
    assert steps[: steps.index("SortMergeJoin")].count("HashAggregate") == 4
    # The distinct count needs no pass of its own.
    assert "Expand" not in steps and steps.count("HashAggregate") == 6


def test_customer_360(customers, transactions):
    report = customer_360(customers, transactions)
    assert report.columns == [
        "country",
        "total_customers",
        "female_customers",
        "female_pct",
        "total_revenue",
        "revenue_per_customer",
        "revenue_rank",
    ]
    assert [tuple(r) for r in report.collect()] == [
        ("France", 4, 2, 50.0, 60.05, 20.02, 1),
        ("Japan", 2, 1, 50.0, 8.0, 4.0, 2),
        ("Chad", 1, 1, 100.0, None, None, 3),  # no revenue: the last rank, shared
        ("Peru", 1, 1, 100.0, None, None, 3),
    ]


def test_customer_360_ranks_rounded_revenue_without_gaps(spark, transactions):
    customers = spark.createDataFrame(
        [(1, "A", None), (2, "B", None), (3, "C", None)], CUSTOMER_SCHEMA
    )
    sales = spark.createDataFrame(
        [
            (1, 1, "p", 1, 10.001, "card"),
            (2, 2, "p", 1, 10.004, "card"),
            (3, 3, "p", 1, 5.0, "card"),
        ],
        TRANSACTION_SCHEMA,
    )
    rows = by_key(customer_360(customers, sales), "country")
    assert [rows[c]["revenue_rank"] for c in "ABC"] == [1, 1, 2]


def sold(transaction_rows, key):
    groups = defaultdict(list)
    for row in transaction_rows:
        groups[key(row)].append(row)
    for name, rows in groups.items():
        prices = [r[4] for r in rows]
        units = [r[4] / r[3] for r in rows if r[4] is not None and r[3]]
        total = exact(prices)
        yield (
            name,
            total,
            (
                len(rows),
                sum(r[3] for r in rows),
                half_up(total, 2),
                half_up(mean(prices), 2),
                half_up(mean(units), 2),
            ),
        )


def test_product_revenue(transactions):
    report = product_revenue(transactions)
    groups = list(sold(TRANSACTIONS, lambda r: r[2]))
    revenue = [figures[2] for _, _, figures in groups]
    everything = exact(revenue)
    ranks = dense_rank(revenue)
    expected = [
        (
            name,
            *figures,
            half_up(figures[2] * 100.0 / everything, 2) if figures[2] is not None else None,
            rank,
        )
        for (name, _, figures), rank in zip(groups, ranks, strict=True)
    ]
    assert canonical(report.collect()) == canonical(expected)
    assert [r["revenue_rank"] for r in report.collect()] == sorted(ranks)
    assert sum(r["revenue_share_pct"] or 0 for r in report.collect()) == pytest.approx(100, abs=0.1)


def test_payment_breakdown(transactions):
    report = payment_breakdown(transactions)
    groups = list(sold(TRANSACTIONS, lambda r: r[5]))
    everything = exact([r[4] for r in TRANSACTIONS])
    expected = [
        (name, figures[0], figures[2], figures[3], half_up(total * 100.0 / everything, 2))
        for name, total, figures in groups
    ]
    rows = report.collect()
    assert canonical(rows) == canonical(expected)
    assert [r["total_revenue"] for r in rows] == sorted((e[2] for e in expected), reverse=True)


def test_shares_of_a_zero_total_are_null(spark):
    free = spark.createDataFrame([(1, 1, "p", 1, 0.0, "card")], TRANSACTION_SCHEMA)
    assert [r["revenue_share_pct"] for r in product_revenue(free).collect()] == [None]
    assert [r["revenue_share_pct"] for r in payment_breakdown(free).collect()] == [None]


def test_payment_shares_use_unrounded_revenue(spark):
    rows = [(1, 1, "p", 1, 0.004, "a"), (2, 1, "p", 1, 0.004, "b")]
    report = payment_breakdown(spark.createDataFrame(rows, TRANSACTION_SCHEMA))
    assert [r["revenue_share_pct"] for r in report.collect()] == [50.0, 50.0]


def test_transaction_summary(transactions):
    report = transaction_summary(transactions)
    groups = list(sold(TRANSACTIONS, lambda r: (r[2], r[5])))
    expected = []
    for name, total, figures in groups:
        peers = [t for n, t, _ in groups if n[0] == name[0]]
        rank = dense_rank([*peers, total])[-1]
        expected.append((*name, *figures, rank))
    assert canonical(report.collect()) == canonical(expected)


def test_transaction_summary_ranks_unrounded_revenue(spark):
    rows = [
        (1, 1, "p", 1, 10.001, "a"),
        (2, 1, "p", 1, 10.004, "b"),
        (3, 1, "p", 1, 10.004, "c"),
        (4, 1, "p", 1, 1.0, "d"),
    ]
    report = transaction_summary(spark.createDataFrame(rows, TRANSACTION_SCHEMA))
    ranks = {r["paymentMethod"]: r["payment_rank_within_product"] for r in report.collect()}
    assert ranks == {"b": 1, "c": 1, "a": 2, "d": 3}
    assert [r["total_revenue"] for r in report.collect()][:3] == [10.0, 10.0, 10.0]


def test_integer_prices(spark):
    schema = TRANSACTION_SCHEMA.replace("totalPrice double", "totalPrice long")
    rows = [(1, 1, "p", 2, 9, "a"), (2, 1, "p", 1, 3, "a")]
    report = product_revenue(spark.createDataFrame(rows, schema))
    assert [tuple(r) for r in report.collect()] == [("p", 2, 3, 12.0, 6.0, 3.75, 100.0, 1)]
