"""Guarded ratios, percentages and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, places: int) -> Column:
    """``part / whole`` rounded; NULL instead of an error where ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), places)


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` in percent of ``whole`` rounded; NULL where ``whole`` is zero."""
    return ratio(part * 100.0, whole, places)


def round_each(sql: str, places: int) -> Column:
    """``ROUND`` of a double, the same to the last bit, for use on every row of a large table.

    ``ROUND`` takes each double through a BigDecimal. Only a value at a tie needs that: elsewhere the
    nearest step is plain arithmetic, which stays in generated code.
    """
    step = f"1e{places}D"
    nearest = f"FLOOR({sql} * {step} + 0.5D)"
    past_tie = f"{sql} * {step} + 0.5D - {nearest}"
    return F.expr(
        f"""CASE WHEN {past_tie} > 1e-4D AND {past_tie} < 0.9999D AND ABS({sql}) < 1e11D / {step}
            THEN {nearest} / {step}
            ELSE ROUND({sql}, {places}) END"""
    )
