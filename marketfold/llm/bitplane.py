"""Token ids in a binary file format of compressed bit planes.

A data set is a folder with three Parquet tables, which any storage that Spark writes to can hold:

* ``chunks``: (part, chunk, n_docs, n_ids, payload), chunks of whole documents in ascending order;
* ``index``: one row per chunk: (part, chunk, first_doc, last_doc, start, n_ids, n_bytes), ``start``
  counting the ids of all chunks before it;
* ``parts``: the number of ids in every part and in all parts before it.

A payload starts with a header and its plane index, then come the planes. Ids are cut into blocks of
``BLOCK_IDS``; every block is transposed so that the same bit of all its ids lies together, and each
plane of the chunk is compressed with zstandard. Planes above the highest bit in use are left out.

Documents keep ascending order of id: a range partitioning on the id and a sort inside each part.
Documents with the same id are ordered by a hash of the text, then by text; a null id comes first. Null
text counts as empty.
"""

from __future__ import annotations

import functools
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.llm.chunks import pieces, special_strings, word_chunk_ids
from marketfold.llm.common import whole_text
from marketfold.session import checkpoint_dir

BLOCK_IDS = 65_536
LEVEL = 1

# magic, ids, documents, planes
HEADER = struct.Struct("<4sQII")
MAGIC = b"BPL1"

CHUNK = "docs array<struct<id {kind}, n_tokens long>>, part int, chunk int, n_ids long, payload binary"


def encode_text(text: str, path: str, end: bytes) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers, followed by ``end``."""
    remembered = word_chunk_ids(path)
    return b"".join(map(remembered.__getitem__, pieces(text, special_strings(path)))) + end


def pack(ids: np.ndarray, lengths: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    """One payload from the ids of several documents and the number of ids in each."""
    planes = int(ids.max()).bit_length() if len(ids) else 0
    bits: list[list[bytes]] = [[] for _ in range(planes)]
    for start in range(0, len(ids), block):
        each = ids[start : start + block]
        for plane in range(planes):
            bits[plane].append(np.packbits((each >> np.uint32(plane)).astype(np.uint8) & 1).tobytes())
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    stored = [compress(lengths.astype("<u8").tobytes()), *(compress(b"".join(p)) for p in bits)]
    index = np.array([len(each) for each in stored], "<u8").tobytes()
    return HEADER.pack(MAGIC, len(ids), len(lengths), planes) + index + b"".join(stored)


def unpack(payload: bytes, block: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """Ids and document lengths of a payload."""
    magic, n, _, planes = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a chunk of bit planes")
    at = HEADER.size + 8 * (planes + 1)
    stored = []
    for size in np.frombuffer(payload, "<u8", planes + 1, HEADER.size).tolist():
        stored.append(zstandard.ZstdDecompressor().decompress(payload[at : at + size]))
        at += size
    ids = np.zeros(n, np.uint32)
    whole = block // 8
    for plane, data in enumerate(stored[1:]):
        packed = np.frombuffer(data, np.uint8)
        for i, start in enumerate(range(0, n, block)):
            size = min(block, n - start)
            bits = np.unpackbits(packed[i * whole : i * whole + (size + 7) // 8], count=size)
            ids[start : start + size] |= bits.astype(np.uint32) << np.uint32(plane)
    return ids, np.frombuffer(stored[0], "<u8").astype(np.int64)


def write_ids(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK_IDS,
) -> str:
    """Encode and write a data set; returns its folder, a new one in the checkpoint folder if unset.

    The text is shuffled once, by range of id; encoding and packing happen behind that shuffle, so
    ids are never shuffled. ``block`` is a multiple of 8.
    """
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    # Sorted by what the range goes by, so that any partitioning gives one order.
    order = ("id", F.xxhash64("text"))
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    chunks = ordered.mapInArrow(
        functools.partial(
            _to_chunks, path=tokenizer_path, end=struct.pack("<I", end_id), block=block
        ),
        CHUNK.format(kind=kind),
    )
    chunks.write.parquet(f"{folder}/chunks")
    written = spark.read.schema(chunks.schema).parquet(f"{folder}/chunks")

    # One row per part, so that a single ordered window over them is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    parts.coalesce(1).write.parquet(f"{folder}/parts")

    starts = spark.read.schema(parts.schema).parquet(f"{folder}/parts")
    earlier = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    index = (
        written.select(
            "part",
            "chunk",
            F.element_at("docs", 1)["id"].alias("first_doc"),
            F.element_at("docs", -1)["id"].alias("last_doc"),
            F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("inside"),
            "n_ids",
            F.octet_length("payload").alias("n_bytes"),
        )
        .join(starts.select("part", F.col("start").alias("before")), "part")
        .select(
            "part",
            "chunk",
            "first_doc",
            "last_doc",
            (F.col("before") + F.col("inside")).alias("start"),
            "n_ids",
            "n_bytes",
        )
    )
    index.write.parquet(f"{folder}/index")
    return folder


def read_ids(
    spark, folder: str, id_type: str = "bigint", id_col: str = "doc_id", block: int = BLOCK_IDS
) -> DataFrame:
    """One row per document of a data set: its id, ``start``, ``n_tokens`` and ``ids`` (binary)."""
    chunks = spark.read.parquet(f"{folder}/chunks")
    index = spark.read.parquet(f"{folder}/index")
    placed = chunks.join(index.select("part", "chunk", "start"), ["part", "chunk"])
    read = placed.select(F.col("docs")["id"].alias("docs"), "start", "payload").mapInArrow(
        functools.partial(_from_chunks, block=block),
        f"id {id_type}, start long, n_tokens long, ids binary",
    )
    return read.withColumnRenamed("id", id_col)


def _to_chunks(
    batches: Iterator[pa.RecordBatch], path: str, end: bytes, block: int
) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, chunk, size = TaskContext.get().partitionId(), 0, 0
    docs, ids = [], []

    def close() -> pa.RecordBatch:
        flat = np.frombuffer(b"".join(ids), "<u4")
        lengths = np.array([len(each) // 4 for each in ids], np.int64)
        entries = [{"id": d, "n_tokens": n} for d, n in zip(docs, lengths.tolist(), strict=True)]
        kind = pa.list_(pa.struct([("id", id_type), ("n_tokens", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([entries], kind),
                pa.array([part], pa.int32()),
                pa.array([chunk], pa.int32()),
                pa.array([len(flat)], pa.int64()),
                pa.array([pack(flat, lengths, block)], pa.binary()),
            ],
            ["docs", "part", "chunk", "n_ids", "payload"],
        )

    for batch in batches:
        id_type = batch.schema.field("id").type
        for doc, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            docs.append(doc)
            ids.append(encode_text(text, path, end))
            size += len(ids[-1]) // 4
            if size >= block:
                yield close()
                chunk, size, docs, ids = chunk + 1, 0, [], []
    if docs:
        yield close()


def _from_chunks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, lengths = unpack(batch["payload"][i].as_py(), block)
            ends = np.cumsum(lengths)
            data = ids.astype("<u4").tobytes()
            begins = ends - lengths
            yield pa.RecordBatch.from_arrays(
                [
                    batch["docs"][i].values,
                    pa.array(begins + batch["start"][i].as_py()),
                    pa.array(lengths),
                    pa.array(
                        [data[4 * a : 4 * b] for a, b in zip(begins, ends, strict=True)], pa.binary()
                    ),
                ],
                ["id", "start", "n_tokens", "ids"],
            )
