"""Repeated byte strings of a corpus, by sorting sampled suffixes and merging the others in.

A window is a string of ``window`` bytes. A byte is repeated if some window that covers it also starts earlier: in
a row with a smaller id, or in the same row before. Windows never cross rows.

The method is the difference-cover construction of a suffix array, cut off at the depth of a window:

* **Sample.** A cover is a choice of positions such that equal windows have one at the same distance from their
  starts. Here each window samples its least hashed gram of ``gram`` bytes, the leftmost of equals; equal windows
  sample at equal distances, as a difference cover does for each pair. All windows that sample a position begin
  in one stretch before it. A sampled position stands for the triple of what its first window has before the
  gram, the gram, and what its last window has behind it.
* **Sort and name.** Triples are sorted by gram, then by all of the triple. Where a gram stands alone, so do all of
  its windows, and it is discarded. Where triples are equal, so are all of their windows: all but the
  earliest are repeated throughout.
* **Recurse.** Distinct triples of one gram share some windows perhaps. They are opened: a window is
  named by the distance to its sampled gram and its bytes.
* **Merge and compare.** These windows are sorted by name; neighbours with equal names are equal, and all
  but the earliest are repeated.

Names are 128-bit hashes, of which two different strings share one with a chance below 1e-12 for 10**13 strings.

Sorting is done in buckets that Spark shuffles as packed arrays: by the hash of the gram, and by the name. Each
task combines what it has first, so that a triple or window that many rows share is sent once by each task. A gram
with more than ``HOT`` distinct triples in one task goes to buckets by triple; a marker tells the gram's own bucket
that it is not alone. No bucket depends on how often one string stands.

Rows are known by id and a hash of their text. Rows with equal ids are ordered by that hash, null ids come first,
and of rows equal in both all but one count as later. Null text counts as empty. Very long texts are handled in
slices. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.llm.common import staged, whole_text
from marketfold.llm.shingles import Powers, mix

# Windows of a text that are sampled at once. Less than 2**20: a place has 20 bits beside its hash.
SLICE = 1 << 19
# Sampled positions or windows of a bucket, and those a task holds before it sends them.
BUCKET = 1_000_000
HELD = 1_500_000
# Bytes of text that are cut together.
TEXTS = 1 << 24
HOT = 64
# Keys of rows a task remembers to send equal ones once.
REMEMBERED = 500_000

# What a position of the sample is in its gram's bucket.
_PLACED, _SHARED, _MARKER = 0, 1, 2


@dataclass(frozen=True)
class Repeats:
    """Bytes of a window, and of the gram that is sampled in each."""

    window: int = 100
    gram: int = 48


def cut_repeats(
    docs: DataFrame, how: Repeats | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_bytes``, ``spans`` and ``kept``.

    ``spans`` are the maximal runs (start, end) of repeated bytes, end exclusive; ``kept`` are the bytes between
    them. Runs jobs when called.
    """
    how = how or Repeats()
    texts = _keyed(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // TEXTS + 1
    # Of so many grams in a window about two are the least of some window.
    buckets = size * 2 // (how.window - how.gram + 2) // BUCKET + 1

    bucketed, result = "bucket int, part int, packed binary", "part int, opened long, packed binary"
    sampled = texts.mapInArrow(functools.partial(_sample, how=how, buckets=buckets, parts=parts), bucketed)
    named = staged(
        sampled.groupBy("bucket").applyInArrow(
            lambda table: _name_triples(table, how, parts), result
        )
    )
    opened = named.filter("opened > 0")
    windows = opened.agg(F.sum("opened")).first()[0] or 0

    # Rows that are equal in id and text are sent once by each task.
    sent = "part int, known boolean, id long, hash long, text string, copies long"
    by_part = texts.mapInArrow(functools.partial(_once, parts=parts), sent).groupBy("part")
    others = by_part.cogroup(opened.groupBy("part")).applyInArrow(
        lambda own, places: _open(own, places, how, windows // BUCKET + 1, parts), bucketed
    )
    merged = others.groupBy("bucket").applyInArrow(
        lambda table: _merge_windows(table, how, parts), result
    )
    repeated = staged(named.filter("opened = 0").unionAll(merged))
    cut = by_part.cogroup(repeated.groupBy("part")).applyInArrow(
        lambda own, places: _cut(own, places, how),
        "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, copies long",
    )
    each = F.explode(F.expr("SEQUENCE(1L, copies)")).alias("copy")
    return cut.select(F.col("id").alias(id_col), "n_bytes", "spans", "kept", each).drop("copy")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole_text(text_col)
    # A null id is the smallest; another seed keeps its rows apart from those that have that id.
    known: Column = F.col(id_col).cast("long")
    return docs.select(known.alias("id"), F.xxhash64(text, known.isNull()).alias("hash"), text.alias("text"))


# --- packed arrays -------------------------------------------------------------------------------

Columns = dict[str, np.ndarray]
# What a row is known by and ordered by.
_KEY = ("known", "id", "hash")


def _pack(columns: Columns) -> bytes:
    """Columns as one compressed string. Rows are written once each, bytes of equal weight together."""
    keys = np.rec.fromarrays([columns[name] for name in _KEY], names=_KEY)
    rows, number = np.unique(keys, return_inverse=True)
    written = {name: each for name, each in columns.items() if name not in _KEY}
    written |= {"row": number.astype(np.uint32)}
    written |= {f"row_{name}": np.ascontiguousarray(rows[name]) for name in _KEY}
    out = []
    for name, column in written.items():
        planes = np.ascontiguousarray(column.view(np.uint8).reshape(len(column), column.itemsize).T)
        out += [f"{name}:{column.dtype.str}:{len(column)};".encode(), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(packed: bytes) -> Columns:
    data, at, columns = zstandard.ZstdDecompressor().decompress(packed), 0, {}
    while at < len(data):
        end = data.index(b";", at)
        name, kind, n = data[at:end].decode().split(":")
        width, size = np.dtype(kind).itemsize, int(n)
        planes = np.frombuffer(data, np.uint8, size * width, end + 1).reshape(width, size)
        columns[name] = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        at = end + 1 + size * width
    row = columns.pop("row")
    return columns | {name: columns.pop(f"row_{name}")[row] for name in _KEY}


def _concat(several: list[Columns]) -> Columns:
    return {name: np.concatenate([each[name] for each in several]) for name in several[0]}


def _taken(columns: Columns, chosen: np.ndarray) -> Columns:
    return {name: each[chosen] for name, each in columns.items()}


def _dealt(columns: Columns, to: np.ndarray) -> Iterator[tuple[int, Columns]]:
    """(number, rows) for each of the numbers that rows go to."""
    order = np.argsort(to, kind="stable")
    edges = np.flatnonzero(np.diff(to[order])) + 1
    for own in np.split(order, edges) if len(order) else ():
        yield int(to[own[0]]), _taken(columns, own)


def _row_parts(columns: Columns, parts: int) -> np.ndarray:
    """The part of the texts in which a row is."""
    mixed = mix(columns["id"].view(np.uint64) + np.uint64(1)) ^ columns["hash"].view(np.uint64)
    return (mix(mixed) % np.uint64(parts)).astype(np.int64)


def _key_columns(known: bool, doc_id: int | None, key: int, n: int) -> Columns:
    return {
        "known": np.full(n, known, np.uint8),
        "id": np.full(n, doc_id or 0, np.int64),
        "hash": np.full(n, key, np.int64),
    }


def _in_order(columns: Columns, *names: str) -> tuple[Columns, np.ndarray]:
    """Rows sorted by names, then from early to late, each place once; and which have another name than
    the row before."""
    by = [*names, *_KEY, "start"]
    columns = _taken(columns, np.lexsort([columns[name] for name in reversed(by)]))
    fresh = np.ones(len(columns["start"]), bool)
    again = ~fresh
    if len(fresh):
        changed = {name: columns[name][1:] != columns[name][:-1] for name in by}
        fresh[1:] = np.logical_or.reduce([changed[name] for name in names])
        again[1:] = ~np.logical_or.reduce(list(changed.values()))
    return _taken(columns, ~again), fresh[~again]


def _batch(rows: list[tuple], second: str) -> pa.RecordBatch:
    """Rows of (bucket, part, packed) or (part, opened, packed)."""
    types = {"part": (pa.int32(), "bucket"), "opened": (pa.int64(), "part")}
    kind, first = types[second]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], kind), pa.array(columns[2], pa.binary())],
        [first, second, "packed"],
    )


def _repeated(columns: Columns, how: Repeats, parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, packed) of the bytes of windows: the first window's start and the last one's end."""
    kept = {name: columns[name] for name in (*_KEY, "start", "length")}
    for part, own in _dealt(kept, _row_parts(kept, parts)):
        yield part, _pack(own)


# --- sampling ------------------------------------------------------------------------------------

_powers = Powers()
_VALUES = np.random.default_rng(90210).integers(1, 2**63, (2, 256), np.uint64)


def _sums(data: np.ndarray, kind: int) -> np.ndarray:
    up, _ = _powers.upto(len(data) + 1)
    return np.concatenate(([np.uint64(0)], np.cumsum(_VALUES[kind][data] * up[: len(data)])))


def _string_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _powers.upto(len(sums))
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def samples(data: np.ndarray, how: Repeats) -> Iterator[dict[str, np.ndarray]]:
    """Sampled positions of a text, by slices: gram, name, first and last window that sample it.

    The gram's hash is half of the triple's name: ``gram`` and ``name`` together have 128 bits.
    """
    windows = len(data) - how.window + 1
    for start in range(0, windows, SLICE):
        piece = data[start : min(start + SLICE, windows) + how.window - 1]
        first, last, at, grams, sums = sampled_slice(piece, how)
        shape = (at - first).astype(np.uint64) << np.uint64(32)
        names = _string_hash(sums, first, last + how.window) ^ mix(shape)
        yield {
            "gram": grams,
            "name": names,
            "start": (first + start).astype(np.int64),
            "length": (last - first + 1).astype(np.uint8 if how.window < 256 else np.uint32),
        }


def sampled_slice(piece: np.ndarray, how: Repeats) -> tuple[np.ndarray, ...]:
    """(first window, last window, sampled position, hash of its gram), and sums over the piece for names."""
    sums, others = _sums(piece, 0), _sums(piece, 1)
    n = len(piece) - how.gram + 1
    begin = np.arange(n)
    hashed = _string_hash(others, begin, begin + how.gram)
    # The least hash, then the leftmost place.
    least = hashed >> np.uint64(20) << np.uint64(20) | begin.astype(np.uint64)
    span, wide = 1, how.window - how.gram + 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: len(least) - wide + span], least[wide - span :])
    at = (least & np.uint64(2**20 - 1)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    last = np.append(first[1:] - 1, len(at) - 1)
    return first, last, at[first], hashed[at[first]], sums


def _bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def _sample(
    batches: Iterator[pa.RecordBatch], how: Repeats, buckets: int, parts: int
) -> Iterator[pa.RecordBatch]:
    """Distinct triples by bucket, and by part what an equal one in the same task makes repeated."""
    held: list[Columns] = []
    size = 0
    for batch in batches:
        columns = (batch[name].to_pylist() for name in ("id", "hash", "text"))
        for doc_id, key, text in zip(*columns, strict=True):
            for found in samples(_bytes_of(text), how):
                n = len(found["gram"])
                held.append(found | _key_columns(doc_id is not None, doc_id, key, n))
                size += n
                if size >= HELD:
                    yield _sent_triples(_concat(held), how, buckets, parts)
                    held, size = [], 0
    if held:
        yield _sent_triples(_concat(held), how, buckets, parts)


def _bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def _sent_triples(columns: Columns, how: Repeats, buckets: int, parts: int) -> pa.RecordBatch:
    columns, fresh = _in_order(columns, "gram", "name")
    bucket = mix(columns["gram"]) % np.uint64(buckets)
    later = _repeated(_taken(columns, ~fresh), how, parts)
    # They are only passed on: any bucket will do.
    rows = [(part % buckets, part, packed) for part, packed in later]

    first, bucket = _taken(columns, fresh), bucket[fresh]
    _, number, several = np.unique(first["gram"], return_inverse=True, return_counts=True)
    hot = several[number] > HOT
    bucket[hot] = mix(first["name"][hot]) % np.uint64(buckets)
    first["kind"] = np.where(hot, _SHARED, _PLACED).astype(np.uint8)
    # One row of every hot gram marks it in its own bucket.
    marked = np.flatnonzero(hot)
    marked = marked[np.unique(first["gram"][marked], return_index=True)[1]]
    markers = _taken(first, marked)
    markers["kind"] = np.full(len(marked), _MARKER, np.uint8)
    to = np.concatenate((bucket, mix(markers["gram"]) % np.uint64(buckets)))
    for number, own in _dealt(_concat([first, markers]), to):
        rows.append((number, None, _pack(own)))
    return _batch(rows, "part")


def _split(table: pa.Table) -> tuple[list[tuple[int, bytes]], Columns | None]:
    """What a bucket only passes on, and its own rows."""
    passed, own = [], []
    for part, packed in zip(table["part"].to_pylist(), table["packed"].to_pylist(), strict=True):
        if part is None:
            own.append(_unpack(packed))
        else:
            passed.append((part, packed))
    return passed, _concat(own) if own else None


def _name_triples(table: pa.Table, how: Repeats, parts: int) -> pa.Table:
    """Sorted triples of a bucket: equal ones but the earliest are repeated, different ones of a gram opened."""
    passed, columns = _split(table)
    rows = [(part, 0, packed) for part, packed in passed]
    if columns is not None:
        marks = columns["gram"][columns["kind"] == _MARKER]
        columns, fresh = _in_order(_taken(columns, columns["kind"] != _MARKER), "gram", "name")
        for part, packed in _repeated(_taken(columns, ~fresh), how, parts):
            rows.append((part, 0, packed))
        first = _taken(columns, fresh)
        _, number, several = np.unique(first["gram"], return_inverse=True, return_counts=True)
        shared = (several[number] > 1) | (first["kind"] == _SHARED) | np.isin(first["gram"], marks)
        first = {name: first[name][shared] for name in (*_KEY, "start", "length")}
        for part, own in _dealt(first, _row_parts(first, parts)):
            rows.append((part, int(own["length"].sum(dtype=np.int64)), _pack(own)))
    return pa.Table.from_batches([_batch(rows, "opened")])


# --- texts by part -------------------------------------------------------------------------------


def _once(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows with their part; of rows equal in id and text the text once and the number of the others."""
    names = ["part", "known", "id", "hash", "text", "copies"]
    schema = pa.schema(
        list(zip(names, [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64()], strict=True))
    )
    others: dict[tuple, int] = {}

    def rows_of(keys: list[tuple], texts: list[str | None], copies: list[int]) -> pa.RecordBatch:
        ids = pa.array([key[0] for key in keys], pa.int64())
        hashes = pa.array([key[1] for key in keys], pa.int64())
        known = [key[0] is not None for key in keys]
        columns = {"id": ids.fill_null(0).to_numpy(), "hash": hashes.to_numpy()}
        part = _row_parts(columns, parts).astype(np.int32)
        arrays = [pa.array(part), pa.array(known, pa.bool_()), ids, hashes, pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(copies, pa.int64())], schema=schema)

    def rest() -> pa.RecordBatch:
        repeated = [(key, n) for key, n in others.items() if n]
        others.clear()
        return rows_of([key for key, _ in repeated], [None] * len(repeated), [n for _, n in repeated])

    for batch in batches:
        keys, texts = [], []
        columns = (batch[name].to_pylist() for name in ("id", "hash", "text"))
        for doc_id, key, text in zip(*columns, strict=True):
            if (doc_id, key) in others:
                others[doc_id, key] += 1
            else:
                others[doc_id, key] = 0
                keys.append((doc_id, key))
                texts.append(text)
        yield rows_of(keys, texts, [1] * len(keys))
        if len(others) >= REMEMBERED:
            yield rest()
    yield rest()


def _texts(table: pa.Table) -> Iterator[tuple[bool, int | None, int, str, int]]:
    """(known, id, hash, text, copies) of every different row of a part, texts one at a time."""
    place: dict[tuple, int] = {}
    copies: dict[tuple, int] = {}
    known = zip(*(table[name].to_pylist() for name in ("known", "id", "hash", "copies")), strict=True)
    whole = table["text"].is_valid().to_pylist()
    for i, (is_known, doc_id, key, n) in enumerate(known):
        row = (is_known, doc_id, key)
        copies[row] = copies.get(row, 0) + n
        if whole[i]:
            place.setdefault(row, i)
    for row, i in place.items():
        yield *row, table["text"][i].as_py(), copies[row]


def _by_row(table: pa.Table) -> dict[tuple, Columns]:
    """The packed places of every row of a part."""
    several = [_unpack(each) for each in table["packed"].to_pylist()]
    if not several:
        return {}
    columns, _ = _in_order(_concat(several), *_KEY)
    edge = np.logical_or.reduce([np.diff(columns[name].astype(np.int64)) != 0 for name in _KEY])
    rows = np.split(np.arange(len(columns["start"])), np.flatnonzero(edge) + 1)
    return {
        (bool(columns["known"][own[0]]), int(columns["id"][own[0]]), int(columns["hash"][own[0]])): _taken(
            columns, own
        )
        for own in rows
        if len(own)
    }


def _open(
    texts: pa.Table, opened: pa.Table, how: Repeats, buckets: int, parts: int
) -> pa.Table:
    """The windows of opened triples by the bucket of their name; and by part those repeated inside this part."""
    of_row, rows, held, size = _by_row(opened), [], [], 0

    def flush() -> None:
        columns, fresh = _in_order(_concat(held), "name", "other")
        held.clear()
        for part, packed in _repeated(_taken(columns, ~fresh), how, parts):
            rows.append((part % buckets, part, packed))
        first = _taken(columns, fresh)
        del first["length"]
        for bucket, own in _dealt(first, mix(first["name"]) % np.uint64(buckets)):
            rows.append((bucket, None, _pack(own)))

    for known, doc_id, key, text, _ in _texts(texts):
        places = of_row.get((known, doc_id or 0, key))
        if places is None:
            continue
        for found in opened_windows(_bytes_of(text), places["start"], places["length"], how):
            n = len(found["start"])
            held.append(found | _key_columns(known, doc_id, key, n))
            size += n
            if size >= HELD:
                flush()
                size = 0
    if held:
        flush()
    return pa.Table.from_batches([_batch(rows, "part")])


def opened_windows(
    data: np.ndarray, start: np.ndarray, length: np.ndarray, how: Repeats
) -> Iterator[Columns]:
    """The windows of stretches of a text, named by their bytes. Stretches lie inside slices."""
    for number in np.unique(start // SLICE):
        own = start // SLICE == number
        begin = number * SLICE
        piece = data[begin : begin + SLICE + how.window - 1]
        lengths = length[own].astype(np.int64)
        first = np.repeat(start[own] - begin - (np.cumsum(lengths) - lengths), lengths)
        at = first + np.arange(lengths.sum())
        yield {
            "name": _string_hash(_sums(piece, 0), at, at + how.window),
            "other": _string_hash(_sums(piece, 1), at, at + how.window),
            "start": at + begin,
            "length": np.ones(len(at), np.uint8),
        }


def _merge_windows(table: pa.Table, how: Repeats, parts: int) -> pa.Table:
    """Sorted windows of a bucket: of neighbours that are equal, all but the earliest are repeated."""
    passed, columns = _split(table)
    rows = [(part, 0, packed) for part, packed in passed]
    if columns is not None:
        columns, fresh = _in_order(columns, "name", "other")
        columns["length"] = np.ones(len(fresh), np.uint8)
        rows += [(part, 0, packed) for part, packed in _repeated(_taken(columns, ~fresh), how, parts)]
    return pa.Table.from_batches([_batch(rows, "opened")])


_CUT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
        ("copies", pa.int64()),
    ]
)


def _cut(texts: pa.Table, repeated: pa.Table, how: Repeats) -> pa.Table:
    of_row, rows = _by_row(repeated), []
    for known, doc_id, key, text, copies in _texts(texts):
        data = text.encode()
        spans: list[tuple[int, int]] = []
        places = of_row.get((known, doc_id or 0, key))
        if places is not None:
            spans = joined_spans(places["start"], places["start"] + places["length"] + (how.window - 1))
        ends = [0, *(end for _, end in spans)]
        begins = [*(start for start, _ in spans), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(ends, begins, strict=True))
        rows.append((doc_id, len(data), spans, kept, 1))
        if copies > 1:
            whole = len(data) >= how.window
            left = (doc_id, len(data), [(0, len(data))] if whole else [], b"" if whole else data, copies - 1)
            rows.append(left)
    return pa.Table.from_pylist(
        [
            {"id": i, "n_bytes": n, "spans": [{"start": a, "end": b} for a, b in spans], "kept": kept, "copies": c}
            for i, n, spans, kept, c in rows
        ],
        _CUT,
    )


def joined_spans(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Spans that overlap or touch, as one."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    edge = np.flatnonzero(start[1:] > reach[:-1])
    firsts, lasts = np.append(0, edge + 1), np.append(edge, len(start) - 1)
    return list(zip(start[firsts].tolist(), reach[lasts].tolist(), strict=True))
