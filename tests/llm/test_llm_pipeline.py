from __future__ import annotations

import random

import public_tokenizers
import pytest

import corpus_pipeline
from marketfold.llm import bpe, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """The result of every stage, in order."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        results.append(docs)
    return results


def test_stages_keep_the_columns_and_only_drop_rows(written):
    first, *stages, last = written
    for before, after in zip([first, *stages], stages, strict=False):
        assert after.columns == first.columns
        assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    assert last.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert last.count() == stages[-1].count() > 0


def test_the_last_stage_encodes_the_texts_of_the_one_before(written):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = {r.doc_id: r.text for r in written[-2].collect()}
    for row in written[-1].collect():
        assert bpe.decode(bytes(row.ids), path) == texts[row.doc_id]
        assert row.n_tokens * 4 == len(row.ids)


def test_bad_labelled_documents_go_and_good_ones_stay(spark, written):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r.doc_id for r in written[1].collect()}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_one_document_of_each_group_of_copies_stays(spark):
    pick = random.Random(1)
    base = [f"w{pick.randrange(500)}" for _ in range(200)]
    rows = [(i, " ".join([*base[:60], f"x{i}", *base[61:]]), "en", "s", 0) for i in range(5)]
    rows += [(10 + i, " ".join(f"v{pick.randrange(500)}" for _ in range(80)), "en", "s", 0) for i in range(5)]
    rows += [(None, "a b c", "en", "s", 0), (30, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect()}
    assert left == {0, *range(10, 15), None, 30}
    dotted = docs.withColumnRenamed("source", "of.source")
    assert corpus_pipeline.near_dedup(spark, dotted, DATA).columns == dotted.columns


def test_registered_queries_are_the_operators_and_the_pipeline():
    import __spark_entry__ as entry

    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert "pipeline" not in entry.oracle_sql()
