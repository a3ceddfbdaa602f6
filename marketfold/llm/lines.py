"""Repeated runs of lines, found by winnowing over line hashes.

A *run* is a stretch of consecutive lines with at least ``run_words`` words that would fall below
without its first or its last line; every longer repetition is a union of such runs. A *passage* is a
stretch of at least ``passage_words`` words in the same sense, from each line on. In the run that
begins at a line, the passage with the least hash is selected, the last of equals: the fingerprint of
all runs that begin there. As the choice depends on the run's own lines only, two places that share a
run are guaranteed to share its fingerprint.

Occurrences of a fingerprint that only one place has are dropped. For the others the match is extended
both ways: the hashes of the runs around it came along with the fingerprint, so that no text has to be
fetched for comparing. Every run meets its first occurrence, by document and line, and the lines of
all later ones are deleted. So a line goes if and only if it lies in lines of ``run_words`` words
or more that stand in the same order at an earlier place, in another document or the same.

Lines are compared without blanks at either end; blank lines are passed over. Documents are ordered by
id, equal ids by a hash of the text. Rows that repeat an id and text are one document: none of them is
deleted for the other, each loses what an earlier document has. A null id comes first. Null text counts
as empty, and stays null. Other columns are passed on as they are.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marketfold.functions import free_names
from marketfold.llm.common import staged, whole_text

PASSAGE_WORDS = 25
RUN_WORDS = 50

Run = tuple[int, int, int]


def fingerprints(text: str, passage_words: int, run_words: int) -> dict[int, list[Run]]:
    """The selected passages of a text and, for each, its runs as (hash, first line, last line)."""
    hashes, words, number = [], [], []
    for i, line in enumerate(text.split("\n")):
        if n := len(line.split()):
            hashes.append(xxhash.xxh3_64_intdigest(line.strip()))
            words.append(n)
            number.append(i)
    upto = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    if upto[-1] < run_words:
        return {}
    data = np.array(hashes, np.uint64)
    n = len(data)
    # The last line of the shortest stretch from each line on; n where the text ends before.
    passage_end = (np.searchsorted(upto, upto[:-1] + passage_words) - 1).tolist()
    run_end = (np.searchsorted(upto, upto[:-1] + run_words) - 1).tolist()
    run_start = (np.searchsorted(upto, upto[1:] - run_words, "right") - 1).tolist()

    digest = functools.cache(lambda a, b: xxhash.xxh3_64_intdigest(data[a : b + 1].tobytes()))
    found: dict[int, list[Run]] = defaultdict(list)
    chosen: dict[int, int] = {}
    runs = {(a, b) for a, b in enumerate(run_end) if b < n}
    runs |= {(a, b) for b, a in enumerate(run_start) if a >= 0}
    for a, b in sorted(runs):
        if a not in chosen:
            inside = range(a, run_end[a] + 1)
            chosen[a] = min(
                (digest(i, passage_end[i]), -i) for i in inside if passage_end[i] <= run_end[a]
            )[0]
        found[chosen[a]].append((digest(a, b), number[a], number[b]))
    return found


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    passage_words: int = PASSAGE_WORDS,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """(id, text_hash, spans): the lines to delete from each document that has any.

    ``spans`` is a sorted array of disjoint (first, last) line numbers from 0. Documents are named by
    their id and ``xxhash64`` of their text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        F.col(id_col).alias("id"),
        _text_hash(text_col).alias("text_hash"),
        whole_text(text_col).alias("text"),
    )
    selected = staged(
        texts.mapInArrow(
            functools.partial(_select, passage_words=passage_words, run_words=run_words),
            f"id {kind}, text_hash long, fingerprint long, twice boolean, "
            "runs array<struct<run long, first int, last int>>",
        )
    )
    # Alone in its document and with no run twice, a fingerprint has nothing to match.
    several = (
        selected.groupBy("fingerprint")
        .agg(F.count("*").alias("places"), F.bool_or("twice").alias("twice"))
        .filter("places > 1 OR twice")
    )
    matched = selected.join(staged(several.select("fingerprint")), "fingerprint")
    runs = staged(
        matched.select("id", "text_hash", F.explode("runs").alias("at")).select(
            "id", "text_hash", "at.run", "at.first", "at.last"
        )
    )
    place = F.struct("id", "text_hash", "first")
    earliest = staged(
        runs.groupBy("run")
        .agg(F.min(place).alias("place"), F.max(place).alias("final"))
        .filter("place <> final")
        .select("run", "place")
    )
    later = runs.join(earliest, "run").filter(place > F.col("place"))
    return (
        later.groupBy("id", "text_hash")
        .agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("all"))
        .select("id", "text_hash", _merged("all").alias("spans"))
    )


def delete_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    passage_words: int = PASSAGE_WORDS,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """``docs`` without the later occurrences; documents of which nothing is left are dropped.

    Documents that were empty before stay, and so does everything about documents that lose nothing.
    """
    joined, spans = with_spans(docs, id_col, text_col, passage_words, run_words)
    (left_text,) = free_names(joined, "left_text")
    lost = F.col(spans).isNotNull()
    left = without_lines(F.when(lost, F.col(text_col)), F.when(lost, F.col(spans)))
    cut = joined.withColumn(left_text, left)
    kept = cut.filter(~lost | F.col(left_text).rlike(r"\S"))
    text = F.when(lost, F.col(left_text)).otherwise(F.col(text_col)).alias(text_col)
    return kept.select(*[text if name == text_col else F.col(f"`{name}`") for name in docs.columns])


def with_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    passage_words: int = PASSAGE_WORDS,
    run_words: int = RUN_WORDS,
) -> tuple[DataFrame, str]:
    """``docs`` with the spans to be deleted, null for none, and the name of that column."""
    spans, lost_id, lost_hash = free_names(docs, "spans", "lost_id", "lost_hash")
    found = staged(repeated_lines(docs, id_col, text_col, passage_words, run_words))
    found = found.withColumnsRenamed({"id": lost_id, "text_hash": lost_hash, "spans": spans})
    same = F.col(id_col).eqNullSafe(F.col(lost_id)) & (_text_hash(text_col) == F.col(lost_hash))
    joined = docs.join(found.hint("shuffle_hash"), same, "left").drop(lost_id, lost_hash)
    return joined, spans


@F.pandas_udf(StringType())
def without_lines(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The text without the lines of the given spans."""
    return pd.Series(
        [
            None if t is None or s is None else _cut(t, [(x["first"], x["last"]) for x in s])
            for t, s in zip(text, spans, strict=True)
        ],
        dtype=object,
    )


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    lines = text.split("\n")
    for first, last in reversed(spans):
        del lines[first : last + 1]
    return "\n".join(lines)


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(whole_text(text_col))


def _merged(spans: str) -> Column:
    """Sorted spans as disjoint ones; spans that touch become one."""
    kind = "array<struct<first:int,last:int>>"
    start = F.struct(
        F.array().cast(kind).alias("done"),
        F.element_at(spans, 1)["first"].alias("first"),
        F.element_at(spans, 1)["last"].alias("last"),
    )

    def closed(so_far: Column) -> Column:
        return F.concat(
            so_far["done"], F.array(F.struct(so_far["first"], so_far["last"])).cast(kind)
        )

    def step(so_far: Column, span: Column) -> Column:
        apart = span["first"] > so_far["last"] + 1
        return F.struct(
            F.when(apart, closed(so_far)).otherwise(so_far["done"]).alias("done"),
            F.when(apart, span["first"]).otherwise(so_far["first"]).alias("first"),
            F.greatest(so_far["last"], span["last"]).alias("last"),
        )

    return F.aggregate(spans, start, step, closed)


def _select(
    batches: Iterator[pa.RecordBatch], passage_words: int, run_words: int
) -> Iterator[pa.RecordBatch]:
    entry = pa.struct([("run", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
    for batch in batches:
        row, chosen, twice, runs = [], [], [], []
        for i, text in enumerate(batch["text"].to_pylist()):
            for fingerprint, around in fingerprints(text, passage_words, run_words).items():
                row.append(i)
                chosen.append(_signed(fingerprint))
                twice.append(len({run for run, _, _ in around}) < len(around))
                runs.append([{"run": _signed(h), "first": a, "last": b} for h, a, b in around])
        at = pa.array(row, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch["id"].take(at),
                batch["text_hash"].take(at),
                pa.array(chosen, pa.int64()),
                pa.array(twice, pa.bool_()),
                pa.array(runs, pa.list_(entry)),
            ],
            ["id", "text_hash", "fingerprint", "twice", "runs"],
        )


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number
