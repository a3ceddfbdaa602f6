"""Token counts by rank-synchronous merging of ragged arrays.

Pre-tokens that a worker has not met lie side by side in one flat array of symbols. In every round
each of them finds its lowest-ranked pair, and all places of that pair merge at once; a pre-token
without a known pair is done. Only the number of its symbols is kept. This equals merging one place at
a time, since a merge can only make pairs of higher rank than its own.

A round passes over all symbols that are left, which a long pre-token with pairs of many ranks cannot afford. One of more
than ``LONG`` bytes has its places filed under the rank of their pair: a round takes up the places of the
lowest rank and files only their neighbours anew.

For tokenizers of words in lower case that end in a mark and drop white space. Null text counts as
empty. Repeated rows give repeated results, a null document id is kept, other columns are not read.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketfold.llm.chunks import REMEMBERED, byte_letters, pieces, pre_tokens, special_strings
from marketfold.llm.common import whole_text

END_OF_WORD = "</w>"

# Texts that are counted together.
TEXTS = 64

# Bytes from which on the places of a pre-token are filed by rank.
LONG = 1024


class Ranks:
    """The vocabulary's merges as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        vocabulary, merges = definition["model"]["vocab"], definition["model"]["merges"]
        pairs = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        keys = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank = order.astype(np.int32)
        self.merged = np.array([to for _, _, to in pairs], np.int64)[order]
        self.made = np.array([to for _, _, to in pairs], np.int64)
        self.none = len(pairs)
        letter = byte_letters()
        self.inner = np.array([vocabulary[letter[b]] for b in range(256)], np.int64)
        self.last = np.array([vocabulary[letter[b] + END_OF_WORD] for b in range(256)], np.int64)

    def counts(self, tokens: list[str]) -> np.ndarray:
        """Symbols that survive in each of ``tokens``, none of them empty."""
        data = [token.encode() for token in tokens]
        length = np.fromiter(map(len, data), np.int64, len(data))
        counts = np.zeros(len(data), np.int64)
        long = length > LONG
        for i in np.flatnonzero(long):
            counts[i] = self._count_long(data[i])
        short = np.flatnonzero(~long)
        if len(short):
            counts[short] = self._count_side_by_side([data[i] for i in short], length[short])
        return counts

    def _count_side_by_side(self, data: list[bytes], length: np.ndarray) -> np.ndarray:
        flat = np.frombuffer(b"".join(data), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(length) - 1
        symbols[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(data)), length)
        counts = length.copy()
        while len(symbols):
            same = owner[1:] == owner[:-1]
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = same & (self.keys[at] == key)
            rank = np.where(known, self.rank[at], self.none)
            rank = np.append(rank, self.none)
            starts = np.flatnonzero(np.append(True, ~same))
            lowest = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(symbols)))
            hit = (rank == np.repeat(lowest, size)) & (rank < self.none)
            # Of overlapping places ("aaa") every other one counts, from the left.
            run = np.flatnonzero(hit)
            if len(run):
                first = np.append(True, np.diff(run) > 1)
                place = np.arange(len(run)) - np.maximum.accumulate(
                    np.where(first, np.arange(len(run)), 0)
                )
                run = run[place % 2 == 0]
                symbols[run] = self.merged[at[run]]
            # A pre-token that merged nothing is done.
            live = np.repeat(lowest < self.none, size)
            finished = starts[lowest == self.none]
            counts[owner[finished]] = size[lowest == self.none]
            live[run + 1] = False
            symbols, owner = symbols[live], owner[live]
        return counts

    def _count_long(self, data: bytes) -> int:
        """Symbols that survive in one long pre-token; the work follows its merges."""
        symbols = self.inner[np.frombuffer(data, np.uint8)]
        symbols[-1] = self.last[data[-1]]
        size = left = len(symbols)
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        # The rank of the pair that begins at each place; merged symbols and the last one have none.
        rank = np.full(size, self.none, np.int64)
        filed: dict[int, list[np.ndarray]] = defaultdict(list)
        waiting: list[int] = []

        def file(places: np.ndarray) -> None:
            # Places whose symbol or neighbour is new, in order.
            inside = places[after[places] < size]
            rank[places] = self.none
            rank[inside] = self._ranks(symbols[inside], symbols[after[inside]])
            known = inside[rank[inside] < self.none]
            if not len(known):
                return
            known = known[np.argsort(rank[known], kind="stable")]
            firsts = np.flatnonzero(np.append(True, np.diff(rank[known]) > 0))
            for each, same in zip(rank[known[firsts]].tolist(), np.split(known, firsts[1:]), strict=True):
                if each not in filed:
                    heapq.heappush(waiting, each)
                filed[each].append(same)

        file(np.arange(size))
        while waiting:
            lowest = heapq.heappop(waiting)
            places = np.unique(np.concatenate(filed.pop(lowest)))
            places = places[rank[places] == lowest]
            if not len(places):
                continue
            # Of overlapping places ("aaa") every other one counts, from the left.
            first = np.append(True, after[places[:-1]] != places[1:])
            number = np.arange(len(places))
            places = places[(number - np.maximum.accumulate(np.where(first, number, 0))) % 2 == 0]
            gone = after[places]
            next_one = after[gone]
            symbols[places] = self.made[lowest]
            rank[gone] = self.none
            after[places] = next_one
            inner = next_one < size
            before[next_one[inner]] = places[inner]
            left -= len(places)
            ahead = before[places]
            file(np.unique(np.concatenate([places, ahead[ahead >= 0]])))
        return left

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.none)


@functools.cache
def ranks(path: str) -> Ranks:
    return Ranks(path)


@functools.cache
def _known(path: str) -> dict[str, int]:
    """Counts of the runs without white space that this worker has met."""
    return {}


def count_chunks(chunks: list[str], path: str) -> dict[str, int]:
    """Tokens of each run without white space."""
    special = special_strings(path)
    split = []
    for chunk in chunks:
        parts = special.split(chunk) if special and "<|" in chunk else [chunk]
        found = [word for part in parts[::2] if part for word in pre_tokens(part)]
        split.append((len(parts) // 2, found))
    unique = list({word for _, found in split for word in found})
    counted = dict(zip(unique, ranks(path).counts(unique).tolist(), strict=True)) if unique else {}
    return {
        chunk: specials + sum(map(counted.__getitem__, found))
        for chunk, (specials, found) in zip(chunks, split, strict=True)
    }


def count_texts(texts: list[str], path: str) -> list[int]:
    known = _known(path)
    split = [pieces(text, special_strings(path)) for text in texts]
    new = set().union(*split).difference(known)
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = set().union(*split)
    known.update(count_chunks(list(new), path))
    counts = [sum(map(known.__getitem__, chunks)) for chunks in split]
    for chunk in new:
        if len(chunk) > 64:
            del known[chunk]
    return counts


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_bytes`` (UTF-8) and ``n_tokens``. No shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    counted = texts.mapInArrow(
        functools.partial(_count, path=tokenizer_path), f"id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumnRenamed("id", id_col)


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].to_pylist()
        tokens = [
            n for i in range(0, len(texts), TEXTS) for n in count_texts(texts[i : i + TEXTS], path)
        ]
        size = pa.compute.binary_length(batch["text"].cast(pa.binary())).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["id"], size, pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"]
        )
