"""BPE encoding and decoding of whole texts by tree concatenation.

A text is cut into leaves that are encoded apart from one another, on any executor, and put together
again in a binary tree. Most cuts fall where the pre-tokenizer ends a piece anyway and cost nothing.
Inside one long unsplit piece (a run of letters, blanks or signs without end) the cut is arbitrary:
the tokens around the join are encoded again in a window that grows until its outermost tokens are
those of the two sides.

Why that is exact: merges that happen inside a run of final tokens do not depend on what lies outside,
so every run of a right encoding is the right encoding of its own text; and a sequence all of whose
neighbouring pairs are right is right as a whole, since the first merge across a boundary would also
happen in that pair alone. If the window starts with the left side's token and ends with the right
side's, every pair lies inside a right encoding: the left's, the window's or the right's.

Null text counts as empty: no ids, empty decoded text. Repeated rows give repeated results, a null
document id is kept, other columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketfold.llm.chunks import (
    SPACED,
    WHITE,
    byte_letters,
    chunk_ids,
    special_strings,
    tokenizer,
)
from marketfold.llm.common import whole_text

# Characters of a leaf. Longer texts are spread over several.
LEAF_CHARS = 32_768

# A blank between plain letters: a piece of the pre-tokenizer always ends before it.
PLAIN_CUT = re.compile("[A-Za-z](?= [A-Za-z])")

ENDS_WHITE = re.compile(f"[{WHITE}]$")

TEXT, PART, SPECIAL = 0, 1, 2

_specials = functools.cache(special_strings)


def encode_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """One row per document: its id, ``ids`` (little-endian unsigned 32 bit) and ``decoded``.

    The tokenizer must be a byte-level BPE without normalizer. Texts of one leaf are finished where
    they are read; only the leaves of longer ones are dealt out and meet again by document.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        whole_text(text_col).alias("text"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    long = F.length("text") > leaf_chars
    short = texts.filter(~long).mapInArrow(
        functools.partial(_encode_whole, path=tokenizer_path),
        f"id {kind}, ids binary, decoded string",
    )
    leaves = (
        texts.filter(long)
        .mapInArrow(
            functools.partial(_cut, path=tokenizer_path, size=leaf_chars),
            f"row long, id {kind}, seq int, kind int, leaf string",
        )
        .repartition(F.col("row"), F.col("seq"))
        .mapInArrow(
            functools.partial(_encode_leaves, path=tokenizer_path),
            f"row long, id {kind}, seq int, kind int, ids binary",
        )
    )
    joined = leaves.groupBy("row").applyInArrow(
        lambda table: _join_leaves(table, tokenizer_path),
        f"id {kind}, ids binary, decoded string",
    )
    return short.unionAll(joined).select(F.col("id").alias(id_col), "ids", "decoded")


def decode(ids: bytes, path: str) -> str:
    """The text of encoded ids."""
    table = _id_bytes(path)
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def encode(text: str, path: str) -> bytes:
    """The ids of one text, chunk by chunk."""
    remembered = chunk_ids(path)
    specials = _specials(path)
    if specials is None or not specials.search(text):
        return b"".join(map(remembered.__getitem__, SPACED.findall(text)))
    # Special strings are cut out first; what stands between them is split on its own.
    parts = specials.split(text)
    return b"".join(
        remembered[part] if i % 2 else b"".join(map(remembered.__getitem__, SPACED.findall(part)))
        for i, part in enumerate(parts)
    )


def leaves_of(text: str, path: str, size: int) -> Iterator[tuple[int, str]]:
    """Cut ``text`` into (kind, leaf).

    TEXT and SPECIAL leaves stand alone. PART leaves in a row are the parts of one long piece, each
    byte written as one character; an empty TEXT leaf stands before the first of them.
    """
    start = 0
    specials = _specials(path)
    while len(text) - start > size:
        last = None
        for last in PLAIN_CUT.finditer(text, start + size // 2, start + size):
            pass
        # A special string may hold a plain cut.
        around = text[max(start, last.end() - 64) : last.end() + 64] if last is not None else ""
        if specials is not None and specials.search(around):
            last = None
        if last is not None:
            yield TEXT, text[start : last.end()]
            start = last.end()
            continue
        ahead = PLAIN_CUT.search(text, start + size)
        stop = ahead.end() if ahead else len(text)
        yield from _unsplit(text[start:stop], path, size)
        start = stop
    yield TEXT, text[start:]


def _unsplit(text: str, path: str, size: int) -> Iterator[tuple[int, str]]:
    """Leaves of a stretch without a plain cut: whole pieces together, long pieces by halves."""
    specials = _specials(path)
    for i, section in enumerate(specials.split(text) if specials else [text]):
        if i % 2:
            yield SPECIAL, section
            continue
        data = section.encode()
        begin = end = solid = 0
        blank: list[str] = []  # pieces of white space since the end of the last other one
        for mapped, _ in tokenizer(path).pre_tokenizer.pre_tokenize_str(section):
            start, end = end, end + len(mapped)
            if len(mapped) > size:
                # A leaf that ends in white space would be split otherwise on its own.
                yield TEXT, data[begin:solid].decode()
                for piece in [*blank, mapped]:
                    yield TEXT, ""
                    yield from ((PART, half) for half in _halves(piece, size))
                begin, solid, blank = end, end, []
            elif ENDS_WHITE.search(data[start:end].decode()):
                blank.append(mapped)
            else:
                solid, blank = end, []
                if end - begin >= size:
                    yield TEXT, data[begin:end].decode()
                    begin = end
        yield TEXT, data[begin:].decode()


def _halves(piece: str, size: int) -> list[str]:
    if len(piece) <= size:
        return [piece]
    middle = len(piece) // 2
    return _halves(piece[:middle], size) + _halves(piece[middle:], size)


def concatenate(left: list[str], right: list[str], path: str) -> list[str]:
    """Tokens of two adjoining parts of one piece, from the tokens of each part."""
    tokenize = tokenizer(path).model.tokenize
    if not left or not right:
        return left + right
    reach = 1
    while True:
        a, b = left[-reach:], right[:reach]
        window = [token.value for token in tokenize("".join(a) + "".join(b))]
        agree_left = len(left) <= reach or window[0] == a[0]
        agree_right = len(right) <= reach or window[-1] == b[-1]
        if agree_left and agree_right:
            return left[: len(left) - len(a)] + window + right[len(b) :]
        reach *= 2


def concatenate_all(parts: list[list[str]], path: str) -> list[str]:
    """Join neighbours pairwise until one sequence is left."""
    while len(parts) > 1:
        pairs = [
            concatenate(parts[i], parts[i + 1], path) if i + 1 < len(parts) else parts[i]
            for i in range(0, len(parts), 2)
        ]
        parts = pairs
    return parts[0] if parts else []


def _encode_whole(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [encode(text, path) for text in batch["text"].to_pylist()]
        decoded = [decode(each, path) for each in ids]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
            ["id", "ids", "decoded"],
        )


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, text in enumerate(batch["text"].to_pylist()):
            leaves = list(leaves_of(text, path, size))
            at = pa.array([i] * len(leaves), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"].take(at),
                    batch["id"].take(at),
                    pa.array(range(len(leaves)), pa.int32()),
                    pa.array([kind for kind, _ in leaves], pa.int32()),
                    pa.array([leaf for _, leaf in leaves], pa.string()),
                ],
                ["row", "id", "seq", "kind", "leaf"],
            )


def _encode_leaves(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokenize = tokenizer(path).model.tokenize
    for batch in batches:
        ids = [
            np.array([token.id for token in tokenize(leaf)], "<u4").tobytes()
            if kind == PART
            else encode(leaf, path)
            for kind, leaf in zip(batch["kind"].to_pylist(), batch["leaf"].to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["row"], batch["id"], batch["seq"], batch["kind"], pa.array(ids, pa.binary())],
            ["row", "id", "seq", "kind", "ids"],
        )


def _join_leaves(table: pa.Table, path: str) -> pa.Table:
    table = table.sort_by("seq")
    model = tokenizer(path)
    done: list[bytes] = []
    parts: list[list[str]] = []

    def close() -> None:
        joined = concatenate_all(parts, path)
        done.append(np.array([model.token_to_id(token) for token in joined], "<u4").tobytes())
        parts.clear()

    for kind, ids in zip(table["kind"].to_pylist(), table["ids"].to_pylist(), strict=True):
        if kind == PART:
            parts.append([model.id_to_token(i) for i in np.frombuffer(ids, "<u4").tolist()])
            continue
        if parts:
            close()
        done.append(ids)
    if parts:
        close()
    ids = b"".join(done)
    return pa.table(
        {
            "id": table["id"].slice(0, 1).combine_chunks(),
            "ids": pa.array([ids], pa.binary()),
            "decoded": pa.array([decode(ids, path)], pa.string()),
        }
    )


@functools.cache
def _id_bytes(path: str) -> list[bytes]:
    """The bytes of each id. Byte-level tokens are written with one printable character a byte."""
    model = tokenizer(path)
    byte_of = {letter: b for b, letter in byte_letters().items()}
    special = {i: t.content.encode() for i, t in model.get_added_tokens_decoder().items()}
    by_id = {i: token for token, i in model.get_vocab().items()}
    return [
        special[i] if i in special else bytes(byte_of[c] for c in by_id.get(i, ""))
        for i in range(max(by_id) + 1)
    ]
