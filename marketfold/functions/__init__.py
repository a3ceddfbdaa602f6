"""Column expressions shared by the operators: exact sums, guarded ratios and rounding."""

from marketfold.functions.amounts import (
    amount_literal,
    amount_mean,
    amount_merge,
    amount_sum,
    amount_total,
    split_amounts,
)
from marketfold.functions.names import free_names
from marketfold.functions.ratios import percent, ratio, round_each

__all__ = [
    "amount_literal",
    "amount_mean",
    "amount_merge",
    "amount_sum",
    "amount_total",
    "free_names",
    "percent",
    "ratio",
    "round_each",
    "split_amounts",
]
