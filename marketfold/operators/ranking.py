"""Dense ranks over aggregated rows, for any number of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from marketfold.functions import free_names
from marketfold.operators.staging import stage

# monotonically_increasing_id counts a partition's rows in its lower bits.
_ROW_BITS = 33


def add_dense_rank(staged: DataFrame, name: str, by: str, within: Sequence[str] = ()) -> DataFrame:
    """Append the dense rank of ``by``, highest first and nulls last.

    Ranks run over all rows, or inside each group of ``within`` (a NULL key is a group). ``staged`` is
    read twice, so it should be a staged or otherwise cheap relation.

    No task sees a whole group. The distinct values are range-partitioned by group and value, with
    boundaries that Spark takes from the data, and numbered inside each partition; the rows of the
    partitions before are added, and the number of the group's first value taken off. The
    numbered values are staged, so that a retried task finds the same partitions. Equal values are
    one before anything is ordered, so a value that many rows share cannot fill a task. The driver sees one
    number for each partition.

    Runs jobs when called.
    """
    keys = [*within, by]
    at, part, index, first = free_names(staged, "_at", "_part", "_index", "_first")
    order = [F.col(key).asc_nulls_first() for key in within] + [F.col(by).desc_nulls_last()]
    values = staged.select(*keys).distinct()
    numbered = stage(
        values.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(at, F.monotonically_increasing_id())
    )
    numbered = numbered.withColumns(
        {part: F.shiftright(at, _ROW_BITS), at: F.col(at).bitwiseAND(2**_ROW_BITS - 1)}
    )
    before = _rows_before(numbered.groupBy(part).agg(F.count("*").alias(at)).collect())
    numbered = numbered.select(*keys, (before(F.col(part)) + F.col(at)).alias(index))
    rank = F.col(index) + 1
    if within:
        firsts = numbered.groupBy(*within).agg(F.min(index).alias(first))
        numbered = _join_null_safe(numbered, firsts, list(within))
        rank = rank - F.col(first)
    ranks = numbered.select(*keys, rank.cast("int").alias(name))
    return _join_null_safe(staged, ranks, keys)


def _rows_before(counts: list[Row]) -> Callable[[Column], Column]:
    """The rows of all partitions before one, from (partition, rows)."""
    rows = dict(map(tuple, counts))
    sums = accumulate((rows.get(part, 0) for part in range(max(rows, default=0) + 1)), initial=0)
    # One literal, however many partitions there are.
    known = F.split(F.lit(",".join(map(str, sums))), ",").cast("array<long>")
    return lambda part: F.get(known, part.cast("int"))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` with NULL equal to NULL; keeps the left side's keys."""
    names = free_names(left, *[f"_{key}_right" for key in keys])
    renamed = right.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    condition = F.lit(True)
    for key, other in zip(keys, names, strict=True):
        condition = condition & left[key].eqNullSafe(renamed[other])
    return left.join(renamed, condition).drop(*names)
