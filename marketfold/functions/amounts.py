"""Sums of doubles that keep every digit and do not depend on the order in which rows arrive.

A plain ``SUM`` over doubles gives another last digit whenever partitions are read, merged or retried
in another order, and at billions of rows the drift reaches the cents. A decimal sum is exact but
converts every value through its printed form, about ten times the cost of the double sum. Here each
value is split without error into integer lanes that Spark adds exactly inside generated code:

* ``high`` and ``low``: the whole part, in units of 2**22 and of 1;
* ``micro``: millionths, for values below 2**33 that are the nearest double to a number of six decimals, bit
  for bit. An amount in cents counts as exactly that number;
* ``fine``, ``finer`` and ``finest``: the part below 1 of all other values, in units of 2**-22, 2**-44 and 2**-66.

No entry of a lane but ``high`` has more than 22 bits, so that a group has room for 2**41 rows; ``high`` has room
for totals up to 2**84. Beyond either Spark raises an error, a sum is never wrong. One more lane, ``rest``, is a
plain double sum of what the others cannot take: digits below 2**-66, which only values below 2**-13 have, and whole
values from 2**62 on, infinity and NaN. Only these can depend on the order of rows.

The result is a small struct that can be aggregated again, so totals of totals stay exact too. All
functions take the name of a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

LANES = ("high", "low", "micro", "fine", "finer", "finest", "rest", "n")

_BITS = 22
_UNIT = 2**_BITS
_MASK = _UNIT - 1
# From here on a value does not fit into the lanes of its whole part.
_LARGEST = f"{2.0**62!r}D"

# How a value is taken apart, each step from the ones before. Every remainder is exact.
_STEPS = {
    "own": f"IF(ABS({{amount}}) < {_LARGEST}, {{amount}}, 0D)",
    "whole": "CAST({own} AS BIGINT)",
    "part": "({own} - {whole})",
    # Millionths, if together with the whole they give the same double back; NULL for other values.
    "micro": f"""IF(ABS({{own}}) < {2.0**33!r}D AND ({{whole}} * 1e6D + RINT({{part}} * 1e6D)) / 1e6D = {{own}},
        RINT({{part}} * 1e6D), NULL)""",
    "binary": "IF({micro} IS NULL, {part}, 0D)",
    "steps": f"CAST({{binary}} * {2.0 ** (2 * _BITS)!r}D AS BIGINT)",
    "below": f"(({{binary}} * {2.0 ** (2 * _BITS)!r}D - {{steps}}) * {float(_UNIT)!r}D)",
}

_SUMS = {
    "high": f"SUM(SHIFTRIGHT({{whole}}, {_BITS}))",
    "low": f"SUM({{whole}} & {_MASK}L)",
    "micro": "SUM(CAST({micro} AS BIGINT))",
    "fine": f"SUM(SHIFTRIGHT({{steps}}, {_BITS}))",
    "finer": f"SUM({{steps}} & {_MASK}L)",
    "finest": "SUM(CAST({below} AS BIGINT))",
    "rest": f"""SUM(IF(ABS({{amount}}) < {_LARGEST},
        ({{below}} - CAST({{below}} AS BIGINT)) * {2.0 ** (-3 * _BITS)!r}D, {{amount}}))""",
    "n": "COUNT({amount})",
}


def split_amounts(df: DataFrame, *columns: str, quotients: Sequence[str] = ()) -> DataFrame:
    """``df`` with the parts of each of the columns, for :func:`amount_sum` with ``split``.

    Each part is computed once a row, in a projection of its own. The names of the added columns begin with
    the part and `` of ``. No value of ``quotients`` counts as a number of six decimals.
    """
    every = (*columns, *quotients)
    known = {column: {"amount": f"CAST(`{column}` AS DOUBLE)"} for column in every}
    for step, sql in _steps(decimal=True).items():
        added = {}
        for column in every:
            # Without decimals the binary part is all of the part.
            if column in quotients and step in ("micro", "binary"):
                known[column][step] = "CAST(NULL AS BIGINT)" if step == "micro" else known[column]["part"]
                continue
            added[f"{step} of {column}"] = F.expr(sql.format(**known[column]))
            known[column][step] = f"`{step} of {column}`"
        df = df.withColumns(added) if added else df
    return df


def amount_sum(
    column: str, over: str | None = None, decimal: bool = True, split: bool = False
) -> Column:
    """Exact partial sum of ``column`` as a struct of :data:`LANES`; nulls are skipped.

    An aggregate, or a window expression if ``over`` gives a window in SQL. Without ``decimal`` no value counts
    as a number of six decimals, which is right and cheaper for quotients. With ``split`` the parts of the value are
    those of :func:`split_amounts`: several sums are planned much faster that way. Read it with
    :func:`amount_total` and :func:`amount_mean`.
    """
    known = {"amount": f"CAST(`{column}` AS DOUBLE)"}
    for step, sql in _steps(decimal).items():
        known[step] = f"`{step} of {column}`" if split else sql.format(**known)
    if not decimal:
        known |= {"micro": "CAST(NULL AS BIGINT)"}
    window = f" OVER ({over})" if over else ""
    return _struct({lane: sql.format(**known) + window for lane, sql in _SUMS.items()})


def _steps(decimal: bool) -> dict[str, str]:
    return _STEPS if decimal else {**_STEPS, "micro": "NULL", "binary": "{part}"}


def amount_merge(column: str, times: str = "1") -> Column:
    """Aggregate partial sums into one, counting each as often as the SQL value ``times`` says."""
    carried = _carried(f"`{column}`")
    return _struct({lane: f"SUM({carried[lane]} * {times})" for lane in LANES})


def amount_literal(partial: Row) -> Column:
    """A partial sum that the driver has, such as an observed one, as a column."""
    return F.struct(
        *[F.lit(partial[lane]).cast("double" if lane == "rest" else "long").alias(lane) for lane in LANES]
    )


def amount_total(column: str) -> Column:
    """The sum as a double; NULL if no value was present."""
    return F.expr(_total(column))


def amount_mean(column: str) -> Column:
    """The average of the values present; NULL if there are none."""
    return F.expr(f"TRY_DIVIDE({_total(column)}, `{column}`.n)")


def _carried(s: str) -> dict[str, str]:
    """The lanes of a sum with what fills a higher unit moved there, so that they stay small."""
    lane = {name: f"COALESCE({s}.{name}, 0)" for name in LANES}
    finer = f"({lane['finer']} + {lane['finest']} DIV {_UNIT})"
    fine = f"({lane['fine']} + {finer} DIV {_UNIT})"
    low = f"({lane['low']} + {lane['micro']} DIV 1000000 + {fine} DIV {_UNIT})"
    return {
        "high": f"({lane['high']} + {low} DIV {_UNIT})",
        "low": f"({low} % {_UNIT})",
        "micro": f"({lane['micro']} % 1000000)",
        "fine": f"({fine} % {_UNIT})",
        "finer": f"({finer} % {_UNIT})",
        "finest": f"({lane['finest']} % {_UNIT})",
        "rest": f"{s}.rest",
        "n": f"{s}.n",
    }


def _total(column: str) -> str:
    """The lanes put together so that nothing but the last addition rounds.

    Whole numbers and millionths make one decimal. The binary parts are added to its double with the error of
    that addition carried along.
    """
    s = _carried(f"`{column}`")
    small = f"{s['fine']} * {2.0**-_BITS!r}D + {s['finer']} * {2.0 ** (-2 * _BITS)!r}D"
    fields = {
        "fixed": f"CAST({s['high']} AS DECIMAL(20, 0)) * {_UNIT} + {s['low']} + {s['micro']} * 0.000001BD",
        "small": small,
        "least": f"{s['finest']} * {2.0 ** (-3 * _BITS)!r}D + COALESCE({s['rest']}, 0D)",
    }
    parts = f"NAMED_STRUCT({', '.join(f'{name!r}, {sql}' for name, sql in fields.items())})"
    near = "NAMED_STRUCT('p', p, 'd', CAST(p.fixed AS DOUBLE))"
    # What the double of a large whole number lacks; beyond 2**63 that no longer matters.
    lacking = (
        f"IF(ABS(x.d) >= {2.0**53!r}D AND ABS(x.d) < {2.0**62!r}D, "
        "CAST(x.p.fixed - CAST(x.d AS BIGINT) AS DOUBLE), 0D)"
    )
    error = (
        "IF(ABS(x.d) >= ABS(x.p.small), x.d - (x.d + x.p.small) + x.p.small, "
        "x.p.small - (x.d + x.p.small) + x.d)"
    )
    total = f"(x.d + x.p.small) + ({error} + {lacking} + x.p.least)"
    # A lambda names the parts, so that the expression holds each once.
    named = f"TRANSFORM(TRANSFORM(ARRAY({parts}), p -> {near}), x -> {total})[0]"
    return f"CASE WHEN `{column}`.n > 0 THEN {named} END"


def _struct(fields: dict[str, str]) -> Column:
    return F.expr(f"NAMED_STRUCT({', '.join(f'{name!r}, {sql}' for name, sql in fields.items())})")
