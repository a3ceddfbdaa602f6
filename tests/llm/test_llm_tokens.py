from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from marketfold.llm import bitplane, bpe, counts
from marketfold.llm.chunks import Remembered, tokenizer

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

PARTS = [
    *("a", "b", " ", "  ", "\n", "'s", "'RE", "'", "é", "É", "中", "1", "22", "!!!", "<|endoftext|>"),
    *("<|startoftext|>", "\x1c", "\x85", "🙂", "the", "ING", "\t", "́", "Σ", "İ", "ß", "aaaa", "²"),
    *("a.", "b,", ". ", ", ", ".\n", "_", "<|", " ", "<b>"),
]
EDGES = [None, "", " ", "\n\n", "x" * 5000, "ab" * 3000 + " end", "中" * 900, " " * 3000, "a b " * 2000]


def random_texts(n, length=40, seed=1):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, length))) for _ in range(n)]


def library(path, texts):
    return [e.ids for e in tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_byte_encoding_and_decoding_equal_the_library():
    texts = random_texts(1500)
    for text, ids in zip(texts, library(BYTES, texts), strict=True):
        assert bpe.encode(text, BYTES) == packed(ids)
        expected = tokenizer(BYTES).decode(ids, skip_special_tokens=False)
        assert bpe.decode(packed(ids), BYTES) == expected


@pytest.mark.parametrize("size", [3, 8, 31])
def test_joined_halves_equal_the_whole(size):
    model = tokenizer(BYTES).model
    pick = random.Random(size)
    for _ in range(150):
        piece = "".join(pick.choice("abethingĠ") for _ in range(pick.randint(1, 300)))
        parts = [[t.value for t in model.tokenize(h)] for h in bpe._halves(piece, size)]
        assert bpe.concatenate_all(parts, BYTES) == [t.value for t in model.tokenize(piece)]


@pytest.mark.parametrize("leaf_chars", [4, 16, 4096])
def test_documents_of_many_leaves_equal_the_library(docs, leaf_chars):
    texts = EDGES + random_texts(60, seed=leaf_chars) + ["same", "same"]
    found = bpe.encode_documents(docs(enumerate(texts)), BYTES, leaf_chars=leaf_chars).collect()
    assert len(found) == len(texts)
    whole = [t or "" for t in texts]
    ids = library(BYTES, whole)
    for row in found:
        assert bytes(row.ids) == packed(ids[row.doc_id])
        assert row.decoded == whole[row.doc_id]


def test_null_ids_repeated_rows_and_an_empty_table(docs):
    rows = [(None, "a"), (1, "b c"), (1, "b c")]
    found = bpe.encode_documents(docs(rows), BYTES).collect()
    assert sorted((r.doc_id is None, r.decoded) for r in found) == [
        (False, "b c"),
        (False, "b c"),
        (True, "a"),
    ]
    assert bpe.encode_documents(docs([]), BYTES).collect() == []
    assert counts.count_tokens(docs([]), WORDS).collect() == []


def test_counts_equal_the_library(docs):
    texts = EDGES + random_texts(800, seed=3)
    whole = [t or "" for t in texts]
    expected = {
        i: (len(t.encode()), len(ids))
        for i, (t, ids) in enumerate(zip(whole, library(WORDS, whole), strict=True))
    }
    found = counts.count_tokens(docs(enumerate(texts)), WORDS).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found} == expected


@pytest.mark.parametrize("letters", ["a", "ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "aéß中x", "=-!"])
def test_long_words_are_counted_like_the_library(letters):
    pick = random.Random(8)
    for size in (counts.LONG - 1, counts.LONG, counts.LONG + 1, 5001, 20_000):
        word = "".join(pick.choice(letters) for _ in range(size))
        assert counts.count_texts([word], WORDS) == [len(library(WORDS, [word])[0])]


def test_a_word_of_a_million_letters_takes_work_by_its_merges(monkeypatch):
    pick = random.Random(9)
    word = "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    looked_up, ranks_of = [], counts.Ranks._ranks

    def counted(self, left, right):
        looked_up.append(len(left))
        return ranks_of(self, left, right)

    monkeypatch.setattr(counts.Ranks, "_ranks", counted)
    tokens = counts.count_texts([word], WORDS)
    assert tokens == [len(library(WORDS, [word])[0])]
    # Each merge files at most two places anew.
    assert sum(looked_up) <= len(word) + 2 * (len(word) - tokens[0])


def test_word_ids_equal_the_library():
    texts = random_texts(1500, seed=4)
    for text, ids in zip(texts, library(WORDS, texts), strict=True):
        assert bitplane.encode_text(text, WORDS, b"") == packed(ids)


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 4096, 20_001])
def test_planes_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 2**20, n).astype("<u4")
    lengths = np.array([n // 2, 0, n - n // 2])
    got, got_lengths = bitplane.unpack(bitplane.pack(ids, lengths, 4096), 4096)
    assert (got == ids).all()
    assert got_lengths.tolist() == lengths.tolist()


def test_written_ids_are_read_back_in_order(spark, docs):
    texts = EDGES + random_texts(300, seed=5)
    order = list(range(len(texts)))
    random.Random(6).shuffle(order)
    rows = [(10 * i, texts[i]) for i in order]
    folder = bitplane.write_ids(docs(rows).repartition(5), WORDS, end_id=2, block=64)
    found = {r.doc_id: r for r in bitplane.read_ids(spark, folder, block=64).collect()}
    start = 0
    for i, ids in enumerate(library(WORDS, [t or "" for t in texts])):
        row = found[10 * i]
        assert (row.start, row.n_tokens) == (start, len(ids) + 1)
        assert zlib.crc32(bytes(row.ids)) == zlib.crc32(packed([*ids, 2]))
        start += len(ids) + 1


def test_written_ids_of_null_ids_repeated_rows_and_nothing(spark, docs):
    rows = [(5, "x y"), (None, "z"), (5, "x y")]
    folder = bitplane.write_ids(docs(rows), WORDS, end_id=2)
    found = bitplane.read_ids(spark, folder).collect()
    assert sorted((r.start, r.n_tokens, r.doc_id) for r in found) == [(0, 2, None), (2, 3, 5), (5, 3, 5)]
    assert bitplane.read_ids(spark, bitplane.write_ids(docs([]), WORDS, end_id=2)).collect() == []


def test_memory_forgets_what_was_not_needed_for_long():
    asked = []
    memory = Remembered(lambda k: asked.append(k) or k.encode(), limit=8)
    for key in ["a", "b", "c", "d", "a", "e", "a", "f"]:
        assert memory[key] == key.encode()
    assert asked.count("a") == 1
    assert len(memory) + len(memory.older) <= 9
    assert memory["x" * 100] == b"x" * 100
    assert "x" * 100 not in memory


def test_documents_of_one_id_stand_in_one_order_on_any_partitioning(spark, docs):
    rows = [(7, f"text {i} " + "word " * (i % 9)) for i in range(500)] + [(7, "again")] * 3 + [(None, "x")] * 2
    starts, shuffles = [], spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in (1, 8):
        try:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            folder = bitplane.write_ids(docs(rows).repartition(3), WORDS, end_id=2)
            found = bitplane.read_ids(spark, folder).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        starts.append(sorted((r.start, r.n_tokens, bytes(r.ids)) for r in found))
    assert len(starts[0]) == len(rows)
    assert starts[0] == starts[1]
