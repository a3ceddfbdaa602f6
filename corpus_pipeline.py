"""The corpus pipeline: from raw documents to token ids.

Rejects bad documents, deletes repeated lines, keeps one document of each group of near duplicates,
removes documents that hold benchmark passages, and encodes what is left.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketfold.llm import bpe, decontaminate, lines, minhash, quality
from marketfold.llm.common import prepare, read
from marketfold.session import checkpoint_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good."""
    labels = read(prepare(spark), sf_dir, "labels", "doc_id LONG, quality INT")
    return quality.keep_good(docs, labels)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand at an earlier place; emptied documents go."""
    prepare(spark)
    cut = lines.delete_repeated_lines(docs)
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", n_chars)
    return cut


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Documents without an id stay. Rows that repeat an id stay or go together.
    """
    prepare(spark)
    near = minhash.near_duplicates(docs)
    dropped = near.filter("NOT kept").select("doc_id").distinct()
    # Quoted, as a name may hold a dot.
    columns = ["`" + name.replace("`", "``") + "`" for name in docs.columns]
    return docs.join(dropped, "doc_id", "left_anti").select(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of which stands in a benchmark item."""
    benchmark = read(prepare(spark), sf_dir, "benchmark", "item_id LONG, text STRING")
    return decontaminate.keep_clean(docs, benchmark)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text (little-endian unsigned 32 bit) and a digest of what they decode to."""
    prepare(spark)
    encoded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

# A trained classifier and a tokenizer have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to all documents; each result is written and read again by the next."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
