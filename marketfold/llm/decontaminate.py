"""Benchmark passages in documents, by a prefix-filtered set join in DataFrame functions.

Benchmark items are cut into windows of ``window`` consecutive words; an item of fewer words is one
window. Containment of a whole window needs all its words, so a prefix of one word is enough: its
rarest word over all documents. Only document words that are such a prefix are joined, each at the
place the word has in its window; a window that would begin before the document or end after it is
passed over, and the others are compared word by word.

Windows with a word that no document has cannot occur and are left out. The others are numbered and
joined in blocks of at most ``block_windows``, whatever their words; so are the words to be counted. That
is the bound of what is sent to every executor at once; each block reads the documents once. With
several blocks the documents are staged first, so that all blocks mean the same rows.

Null or empty text has no words. Rows that repeat are counted one by one. Items that repeat share
their windows; each counts by its own id. An item without an id takes no part. Other columns are not
read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.functions.names import free_names
from marketfold.llm.common import quoted, staged, whole_text

WINDOW = 13
BLOCK_WINDOWS = 100_000

# Plain characters other than digits and letters stand between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# No word is empty, so an empty one at place 0 stands for the document itself.
NO_WORD = ""


def words_of(text: Column) -> Column:
    """The words of a text in order; plain capital letters become small."""
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))
    return F.array_remove(F.split(lowered, BETWEEN), NO_WORD)


def item_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(words, item) for every window of every item; few words are one window, none have none."""
    items = benchmark.select(
        F.col(id_col).alias("item"), words_of(whole_text(text_col)).alias("all")
    ).filter("item IS NOT NULL AND size(all) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - F.lit(window - 1), F.lit(1)))
    return (
        items.select("item", "all", F.explode(starts).alias("start"))
        .select(F.slice("all", F.col("start"), window).alias("words"), "item")
        .distinct()
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_hit`` and ``items``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` holds the distinct ids of
    the items whose windows occur, sorted as strings. A row of ``docs`` gives a row here.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        words_of(whole_text(text_col)).alias("words"),
    )
    of_item = staged(item_windows(benchmark, window, item_col, item_text_col))
    windows = staged(of_item.select("words").distinct().withColumn("window", F.expr("uuid()")))
    prefixes, blocks = _in_blocks(_prefixes(texts, windows, block_windows), block_windows)
    if blocks > 1:
        texts = staged(texts)

    sentinel = prefixes.sparkSession.range(1).select(
        F.lit(NO_WORD).alias("word"),
        F.lit(0).alias("offset"),
        F.array().cast("array<string>").alias("passage"),
        F.lit(None).cast("string").alias("window"),
        F.lit(0).cast("long").alias("block"),
    )
    probed = prefixes.unionByName(sentinel)
    found = [_occurrences(texts, probed.filter(F.col("block") == b)) for b in range(blocks)]
    hits = (
        reduce(DataFrame.unionAll, found)
        .groupBy("row")
        .agg(
            F.max("id").alias("id"),
            F.max("n_words").alias("n_words"),
            F.collect_set(F.struct("start", "end")).alias("spans"),
            F.collect_set("window").alias("windows"),
        )
        .select("row", "id", "n_words", _covered("spans").alias("n_hit"), "windows")
    )
    hits = staged(hits)
    item_of = windows.join(of_item, "words").select("window", "item")
    items = (
        hits.select("row", F.explode("windows").alias("window"))
        .join(item_of, "window")
        .select("row", "item")
        .distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.col("item").cast("string"))).alias("items"))
    )
    return hits.join(items, "row", "left").select(
        F.col("id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated.

    A row goes by its own text alone: a clean row stays whatever its id, and a contaminated one goes
    without an id, too. ``id_col`` is not read.
    """
    (key,) = free_names(docs, "text_key")
    digest = F.sha2(F.encode(whole_text(quoted(text_col)), "UTF-8"), 256)
    keyed = docs.select(digest.alias(key), F.col(quoted(text_col)).alias("text"))
    found = contamination(keyed, benchmark, window, key, "text", item_col, item_text_col)
    dropped = found.filter(is_contaminated("n_words", "n_hit")).select(key).distinct()
    columns = [F.col(quoted(name)) for name in docs.columns]
    return docs.withColumn(key, digest).join(dropped, key, "left_anti").select(*columns)


def is_contaminated(n_words: str, n_hit: str) -> Column:
    """At least a twentieth of the words stand inside benchmark windows."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))


def _in_blocks(df: DataFrame, most: int) -> tuple[DataFrame, int]:
    """``df`` staged with a number ``block``, at most ``most`` rows of each, and the number of blocks."""
    numbered = staged(df.withColumn("block", F.monotonically_increasing_id()))
    # Such an id is the number of the partition and, in the lower bits, the row's in it.
    part, place = F.shiftright("block", 33), F.col("block").bitwiseAND((1 << 33) - 1)
    counts = numbered.groupBy(part.alias("part")).count().collect()  # a row for each partition
    before, rows = [F.lit(-1).cast("long"), F.lit(0).cast("long")], 0
    for row in sorted(counts):
        before += [F.lit(row["part"]), F.lit(rows).cast("long")]
        rows += row["count"]
    number = F.create_map(*before)[part] + place
    return numbered.withColumn("block", F.floor(number / most)), max(1, -(-rows // most))


def _prefixes(texts: DataFrame, windows: DataFrame, most: int) -> DataFrame:
    """(word, offset, passage, window): every window all of whose words occur, under its rarest word."""
    placed = windows.select(
        "window", F.col("words").alias("passage"), F.posexplode("words").alias("offset", "word")
    )
    vocabulary, blocks = _in_blocks(placed.select("word").distinct(), most)
    words = texts.select(F.explode("words").alias("word"))
    counted = [
        words.join(F.broadcast(vocabulary.filter(F.col("block") == b).select("word")), "word")
        .groupBy("word")
        .agg(F.count("*").alias("seen"))
        for b in range(blocks)
    ]
    seen = staged(reduce(DataFrame.unionAll, counted))
    rarest = (
        placed.join(seen, "word", "left")
        .groupBy("window")
        .agg(
            F.min(F.coalesce("seen", F.lit(0))).alias("least"),
            F.min_by(F.struct("word", "offset", "passage"), F.struct("seen", "word", "offset")).alias("first"),
        )
        .filter("least > 0")
    )
    return rarest.select("first.word", "first.offset", "first.passage", "window")


def _occurrences(texts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(row, id, n_words, start, end, window) of every window found, ``end`` exclusive.

    The words stay with the exploded place up to the comparison, inside one generated loop; only what
    is found leaves it.
    """
    with_head = F.concat(F.array(F.lit(NO_WORD)), "words")
    headed = texts.select("row", "id", "words", with_head.alias("headed"))
    places = headed.select("row", "id", "words", F.posexplode("headed").alias("place", "word"))
    start = F.col("place") - F.col("offset")
    length = F.size("passage")
    inside = (start >= 1) & (start + length - 1 <= F.size("words"))
    same = F.slice("words", F.greatest(start, F.lit(1)), length) == F.col("passage")
    return (
        places.join(F.broadcast(prefixes), "word")
        .filter(F.col("window").isNull() | (inside & same))
        .select(
            "row",
            "id",
            F.size("words").alias("n_words"),
            start.alias("start"),
            (start + length).alias("end"),
            "window",
        )
    )


def _covered(spans: str) -> Column:
    """Places inside the union of [start, end) spans."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    return F.aggregate(
        F.array_sort(spans),
        start,
        lambda done, span: F.struct(
            F.greatest(done["upto"], span["end"]).alias("upto"),
            (
                done["n"]
                + F.greatest(span["end"] - F.greatest(done["upto"], span["start"]), F.lit(0))
            ).alias("n"),
        ),
        lambda done: done["n"],
    )
