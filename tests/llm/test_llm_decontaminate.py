from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from marketfold.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(SMALL))


def brute(texts, items, window):
    windows = defaultdict(set)
    for item, text in items:
        own = words(text)
        size = min(window, len(own))
        if item is not None and own:
            for s in range(len(own) - size + 1):
                windows[tuple(own[s : s + size])].add(str(item))
    sizes = {len(w) for w in windows}
    rows = []
    for text in texts:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for s in range(len(own) - size + 1):
                if items_of := windows.get(tuple(own[s : s + size])):
                    found |= items_of
                    hit |= set(range(s, s + size))
        rows.append((len(own), len(hit), sorted(found)))
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 100_000), (2, 7), (3, 1000)])
def test_hits_equal_those_of_all_windows(spark, docs, seed, block):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["Éa", "éa", "中文", "THE", "the", "9"]
    signs = [" ", ", ", "-", "\n", "!"]

    def text(n):
        return "".join(pick.choice(vocabulary) + pick.choice(signs) for _ in range(n))

    items = [(i, text(pick.randint(0, 9))) for i in range(25)] + [(99, None), (None, "w1 w2"), (3, text(8))]
    texts = [text(pick.randint(0, 60)) for _ in range(60)]
    texts += [None, "", "...", f"x {items[1][1]} y", items[2][1], items[2][1]]
    texts += [" ".join(t or "" for _, t in items)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(
        docs(enumerate(texts)).repartition(4), benchmark, window=5, block_windows=block
    ).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found}
    assert got == dict(enumerate(brute(texts, items, 5)))


def test_rows_that_repeat_an_empty_benchmark_and_empty_documents(spark, docs):
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    rows = [(1, "x a b c"), (1, "x a b c"), (None, "a b")]
    found = decontaminate.contamination(docs(rows), benchmark).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit) for r in found) == [(0, 2, 0), (1, 4, 3), (1, 4, 3)]
    nothing = benchmark.filter("false")
    assert [r.n_hit for r in decontaminate.contamination(docs(rows), nothing).collect()] == [0, 0, 0]
    assert decontaminate.contamination(docs([]), benchmark).collect() == []


def test_only_contaminated_documents_go(spark, docs):
    benchmark = spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(20)))], "item_id long, text string")
    passage = " ".join(f"b{i}" for i in range(13))
    rows = [
        (1, passage),
        (2, passage + " x" * 247),  # exactly a twentieth
        (3, passage + " x" * 248),
        (4, " ".join(f"b{i}" for i in range(12))),
        (5, None),
        (None, "free"),
    ]
    left = decontaminate.keep_clean(docs(rows), benchmark).collect()
    assert sorted(r.doc_id or 0 for r in left) == [0, 3, 4, 5]


def test_one_scan_joins_the_prefixes_without_shuffling_texts(spark, docs):
    texts = docs([(1, "a b c")]).selectExpr("0L AS row", "doc_id AS id", "split(text, ' ') AS words")
    prefixes = spark.createDataFrame(
        [("b", 1, ["a", "b"], "w")], "word string, offset int, passage array<string>, window string"
    )
    found = decontaminate._occurrences(texts, prefixes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    assert [(r.start, r.end) for r in found.collect()] == [(1, 3)]


def test_rows_go_one_by_one_whatever_their_ids(spark, docs):
    passage = " ".join(f"b{i}" for i in range(13))
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = [(1, passage), (1, "clean"), (None, passage), (None, None), (2, passage.upper()), (2, "")]
    table = docs(rows).withColumnRenamed("id", "text_key").withColumnRenamed("row", "of.row")
    left = decontaminate.keep_clean(table, benchmark)
    assert left.columns == table.columns
    kept = sorted((r.doc_id or 0, r.text or "") for r in left.collect())
    assert kept == [(0, ""), (1, "clean"), (2, "")]


def test_blocks_hold_at_most_their_number_of_windows(spark, docs):
    # One word stands in every window: seen least of all, or in no document.
    items = [(i, f"w{i} v{i} common x{i}") for i in range(300)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    of_item = decontaminate.item_windows(benchmark, 4, "item_id", "text")
    windows = of_item.select("words").distinct().withColumn("window", decontaminate.F.expr("uuid()"))
    windows = decontaminate.staged(windows.repartition(5))

    def prefixes(texts):
        split = docs(texts).select(decontaminate.words_of("text").alias("words"))
        return decontaminate._in_blocks(decontaminate._prefixes(split, windows, 7), 7)

    seen = [(i, f"w{i} v{i} x{i} w{i} v{i} x{i}" + " common" * (i < 1)) for i in range(300)]
    found, blocks = prefixes(seen)
    sizes = [r["count"] for r in found.groupBy("block").count().collect()]
    assert (sum(sizes), max(sizes), blocks) == (300, 7, 43)
    assert {r.word for r in found.collect()} == {"common"}
    unseen, blocks = prefixes([(i, t.replace("common", "")) for i, t in seen])
    assert (unseen.count(), blocks) == (0, 1)


def test_very_long_texts_and_a_benchmark_with_other_columns(spark, docs):
    passage = " ".join(f"b{i}" for i in range(13))
    benchmark = spark.createDataFrame(
        [(7, passage, 1, "w")], "item_id long, text string, row int, words string"
    )
    long = " ".join(f"a{i}" for i in range(60_000))
    rows = [(1, f"{long} {passage} {long}"), (2, long), (3, "z" * 300_000), (4, f"{passage} " * 3000)]
    found = decontaminate.contamination(docs(rows), benchmark).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found}
    assert got == {1: (120_013, 13, ["7"]), 2: (60_000, 0, []), 3: (1, 0, []), 4: (39_000, 39_000, ["7"])}
