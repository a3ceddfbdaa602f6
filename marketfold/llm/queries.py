"""The queries of this folder by name, each over its whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketfold.llm import (
    bitplane,
    bpe,
    chat,
    counts,
    decontaminate,
    lines,
    merkle,
    minhash,
    pii,
    quality,
    sketch,
    spelling,
    suffixes,
)
from marketfold.llm.common import documents, prepare, read, staged

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode_documents(
        documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json")
    )
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def _spans(column: Column) -> Column:
    """Spans as text, ``kind:start:end`` by kind as listed, then by start."""
    kinds = F.array(*map(F.lit, pii.KINDS))
    each = F.transform(
        F.array_sort(column),
        lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"]),
    )
    return F.concat_ws(",", each)


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(documents(spark, folder))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(i).alias(f"n_{name}") for i, name in enumerate(pii.KINDS[: pii.BASE])],
        F.sha2(_spans(F.col("base")), 256).alias("base_sha256"),
        _spans(F.concat("base", "added")).alias("spans"),
        (F.size("base") + F.size("added")).cast("long").alias("n_spans"),
    )


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = read(spark, folder, "labels", "doc_id LONG, quality INT")
    return quality.score_documents(documents(spark, folder), labels)


def op4_bloom_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.compare_with_edit(documents(spark, folder))


def op5_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    written = bitplane.write_ids(documents(spark, folder), path, end_id=2)
    return bitplane.read_ids(spark, written).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


# Documents with more tokens do not fit into one training sequence.
TOKEN_LIMIT = 2048


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    counted = counts.count_tokens(documents(spark, folder), path)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text): turns as they stand in raw transcripts of three styles.

    A turn ends with a blank line. Three in four begin with a speaker marker, the others with nothing.
    """
    style = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(3))
    name = F.initcap("role")
    human = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI")
    marker = (
        F.when(style == 0, F.concat(name, F.lit(": ")))
        .when(style == 1, F.concat(F.coalesce(human, name), F.lit(": ")))
        .otherwise(F.concat(F.lit("["), "role", F.lit("] ")))
    )
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 3
    text = F.concat(
        F.when(bare, "").otherwise(F.coalesce(marker, F.lit(""))),
        F.coalesce("text", F.lit("")),
        F.lit("\n"),
    )
    return conversations.select(F.col("conv_id").alias("conv"), "turn", "role", text.alias("text"))


def op6_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    schema = "conv_id LONG, turn LONG, role STRING, text STRING"
    turns = transcripts(read(prepare(spark), folder, "conversations", schema))
    known = turns.filter(F.col("role").isin(*chat.ROLES) & ~quality.held_out("conv"))
    model = chat.train(staged(chat.labelled_lines(known)))
    return chat.parse(turns, model).withColumnRenamed("conv", "conv_id")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked, _ = lines.with_spans(documents(spark, folder))
    lost = F.col("spans").isNotNull()
    left = lines.without_lines(F.when(lost, F.col("text")), F.when(lost, F.col("spans")))
    size = F.aggregate(
        F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>")),
        F.lit(0),
        lambda n, span: n + span["last"] - span["first"] + 1,
    )
    span = F.transform("spans", lambda s: F.concat_ws("-", s["first"], s["last"]))
    kept = F.coalesce(F.when(lost, left).otherwise(F.col("text")), F.lit(""))
    return marked.select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        size.cast("long").alias("n_removed"),
        F.coalesce(F.concat_ws(",", span), F.lit("")).alias("removed"),
        F.sha2(F.encode(kept, "UTF-8"), 256).alias("kept_sha256"),
    )


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder), minhash.Likeness(words=4))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = read(spark, folder, "benchmark", "item_id LONG, text STRING")
    found = decontaminate.contamination(documents(spark, folder), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated("n_words", "n_hit").alias("contaminated"),
    )


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    schema = "doc_id LONG, source STRING, lang STRING, n_chars LONG, text STRING"
    docs = read(prepare(spark), folder, "documents", schema)

    def leaf(text: Column) -> Column:
        names = ("doc_id", "source", "lang", "n_chars")
        return merkle.digest(*[merkle.field(F.col(name)) for name in names], merkle.field(text))

    lowered = F.translate("text", _CAPITALS, _CAPITALS.lower())
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(
        "lang", "doc_id", leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(lowered)).alias("shown")
    )
    proved = merkle.build(leaves, "lang", "doc_id", "leaf", "shown")
    folded = merkle.fold(F.coalesce("shown", "leaf"), F.col("proof"))
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


# Rarer words are no words of the corpus.
LEAST_OCCURRENCES = 5


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.count_words(documents(spark, folder)).filter(F.col("n") >= LEAST_OCCURRENCES)
    return spelling.group_variants(words)


def op13_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.cut_repeats(documents(spark, folder))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_bpe_round_trip": op1_bpe_round_trip,
        "op2_pii": op2_pii,
        "op3_quality": op3_quality,
        "op4_bloom_lookup": op4_bloom_lookup,
        "op5_bit_planes": op5_bit_planes,
        "op6_transcripts": op6_transcripts,
        "op7_line_dedup": op7_line_dedup,
        "op8_token_counts": op8_token_counts,
        "op9_minhash": op9_minhash,
        "op10_decontaminate": op10_decontaminate,
        "op11_merkle": op11_merkle,
        "op12_spelling": op12_spelling,
        "op13_suffixes": op13_suffixes,
    }


def oracle_sql() -> dict[str, str]:
    return {}
