"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches.

A text is a set of paragraph digests: its sentences, which end with a line or after a full stop, question
or exclamation mark of any script. A sentence of more than ``LONG`` characters is cut once more after words
chosen by the hash of the word and the one before it, so that a change costs only the pieces around it;
scripts without blanks, and words of more than ``LONG_WORD`` characters, count by character. Every digest is added
to three of ``CELLS`` cells, one in each third; a cell keeps the number, the exclusive or of the digests
and of their check values. Subtracting the sketches of two versions leaves the digests in which they
differ. Cells with one digest left give it away; taking it out of its other cells frees more (peeling).

If peeling stops early, the pair is tried again with a larger sketch: two to 64 sketches, as many as its
digests need, each for the digests of one share by a hash and with hash functions of its own; of these, the
ones that fail are split again by another hash. A share of more than ``MOST_TRIED`` digests, far more than a
sketch holds, is split without a try. So sketches stay small and the work grows with the digests.

Everything is DataFrame and SQL functions. Null text counts as empty. Two empty texts are alike (1).
The next document is that with the next greater id (nulls first, equal ids by a hash of the text), after
the last the first. Rows that repeat follow each other. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketfold.llm.common import staged, whole_text

THIRD = 16
CELLS = 3 * THIRD
# More rounds than peeling of so few cells needs.
ROUNDS = 16
# Documents that are sorted together, and the most groups of them.
GROUP_ROWS = 1024
MOST_GROUPS = 16_384

# Where sentences end, with or without a closing quote or bracket, and where words do. A blank
# is looked for first, as that costs least; only texts with a full stop that needs no blank look for those.
BLANK_END = (
    r"[\n \t\u00a0](?:(?<=\n)|(?:(?<=[.!?…؟۔।॥։።][ \t\u00a0])"
    r"|(?<=[.!?…؟۔।॥։።][\"'”’»)\]][ \t\u00a0]))[ \t\u00a0]*)"
)
WIDE_STOPS = "。！？｡"
PARAGRAPH_END = rf"{BLANK_END}|(?<=[{WIDE_STOPS}])"
PLAIN_WORD_END = r"(?<=\s)"
WORD_END = (
    r"(?<=[\s\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
)
# Characters of a sentence and of a word that stay whole, and words a piece of a longer sentence has on average.
LONG = 160
LONG_WORD = 64
PIECE_WORDS = 16
# Digests of both sides for which a larger sketch has room: an edit keeps about half of them.
ROOM = {"edit": 2 * THIRD + THIRD // 2, "next": THIRD + THIRD // 2}
MOST_SHARES = 64
MOST_TRIED = 3 * CELLS

_EMPTY = "named_struct('n', 0, 'k', 0L, 'h', 0)"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _cell(key: str, third: int, salt: int) -> str:
    """The cell of a digest in a third."""
    return f"pmod(hash({key}, {third + 1}, {salt}), {THIRD})"


def _mask(key: str, salt: int) -> str:
    """The three cells of a digest as bits of a number."""
    bits = (f"shiftleft(1L, {i * THIRD} + {_cell(key, i, salt)})" for i in range(3))
    return " | ".join(bits)


def _cells_of(entries: str, start: str, step: int, cell: str) -> str:
    """Array of the cells from ``start`` on, four times ``step`` of them; entries are dealt out by fours."""
    bits = str((1 << step) - 1) + "L"
    if step == 1:
        inner = _let(f"filter({entries}, e -> getbit(e.m, i{step}) = 1)", "own", cell)
    else:
        own = f"filter({entries}, e -> (shiftright(e.m, i{step}) & {bits}) <> 0L)"
        inner = _let(own, f"own{step}", _cells_of(f"own{step}", f"i{step}", step // 4, cell))
    each = f"transform(sequence({start}, {start} + {3 * step}, {step}), i{step} -> {inner})"
    return each if step == 1 else f"flatten({each})"


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs that are not blank."""
    wide = reduce(Column.__or__, [F.contains(text, F.lit(stop)) for stop in WIDE_STOPS])
    ended = F.when(wide, F.split(text, PARAGRAPH_END)).otherwise(F.split(text, BLANK_END))
    parts = F.filter(ended, lambda part: F.trim(part) != "")
    digest = F.transform(
        parts,
        lambda part: F.when(
            F.char_length(part) > LONG, F.transform(_pieces(part), lambda piece: F.xxhash64(piece))
        ).otherwise(F.array(F.xxhash64(part))),
    )
    return F.array_distinct(F.flatten(digest))


def _pieces(part: Column) -> Column:
    """A long sentence cut by its content; it holds no line end, so that one can mark the cuts."""
    plain = F.octet_length(part) == F.char_length(part)
    parted = F.when(plain, F.split(part, PLAIN_WORD_END)).otherwise(F.split(part, WORD_END))

    def by_character(words: Column) -> Column:
        letters = F.transform(
            words, lambda word: F.when(F.char_length(word) > LONG_WORD, F.split(word, "")).otherwise(F.array(word))
        )
        return F.when(F.exists(words, lambda word: F.char_length(word) > LONG_WORD), F.flatten(letters)).otherwise(words)

    words = F.element_at(F.transform(F.array(parted), by_character), 1)

    def marked(all_words: Column) -> Column:
        # No cut inside a run of one word: it would make pieces that are all alike.
        def ends(word: Column, i: Column) -> Column:
            before = F.get(all_words, i - 1)
            return (F.pmod(F.hash(before, word), F.lit(PIECE_WORDS)) == 0) & (before != word)

        return F.transform(
            all_words, lambda word, i: F.when(ends(word, i), F.concat(word, F.lit("\n"))).otherwise(word)
        )

    joined = F.element_at(F.transform(F.array(words), lambda w: F.array_join(marked(w), "")), 1)
    return F.filter(F.split(joined, "\n"), lambda piece: F.trim(piece) != "")


def cells_sql(keys: str, salt: int = 0) -> str:
    """The sketch of an array of digests."""
    entries = (
        f"transform({keys}, k -> named_struct('k', k, 'h', hash(k, 0, {salt}), 'm', {_mask('k', salt)}))"
    )
    # The number is a size and the rest two sums: a struct for each cell and not for each entry.
    sums = "'k', aggregate(own, 0L, (x, e) -> x ^ e.k), 'h', aggregate(own, 0, (x, e) -> x ^ e.h)"
    cell = f"IF(size(own) = 0, {_EMPTY}, named_struct('n', size(own), {sums}))"
    # An entry is in one cell of each third; it is looked for in four groups of four cells.
    third = _cells_of("entries", "t", THIRD // 4, cell)
    return _let(entries, "entries", f"flatten(transform(sequence(0, {CELLS - THIRD}, {THIRD}), t -> {third}))")


def _dealt(keys: str, number: str, count: str) -> str:
    """Array of ``count`` arrays: the digests k of ``keys`` by ``number``, a number of k from 0 on.

    Places in the array are sorted by number, with a mark before each number. So the work grows with the
    digests and not with their product with ``count``.
    """
    marks = f"sequence(-1L, shiftleft(CAST({count} AS BIGINT), 32) - 1L, {1 << 32}L)"
    places = f"sort_array(concat(transform(ks, (k, p) -> shiftleft(CAST({number} AS BIGINT), 32) + p), {marks}))"
    begins = f"transform({marks}, mark -> CAST(array_position(places, mark) AS INT))"
    size = "begins[c + 1] - begins[c] - 1"
    each = f"transform(slice(places, begins[c] + 1, {size}), p -> ks[CAST(p & {(1 << 32) - 1}L AS INT)])"
    groups = f"transform(sequence(0, {count} - 1), c -> {each})"
    return _let(keys, "ks", _let(places, "places", _let(begins, "begins", groups)))


def subtract_sql(a: str, b: str) -> str:
    """The sketch of what is in ``a`` (counted up) or in ``b`` (counted down) only."""
    return (
        f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h))"
    )


def peel_sql(cells: str, salt: int = 0) -> str:
    """struct(ok, a, b): whether all was recovered, and how many digests on either side."""
    pure = f"filter(state.cells, c -> (c.n = 1 OR c.n = -1) AND c.h = hash(c.k, 0, {salt}))"

    def only(n: int) -> str:
        return f"array_distinct(transform(filter(pure, c -> c.n = {n}), c -> c.k))"

    def entries(side: str, n: int) -> str:
        entry = f"named_struct('h', hash(k, 0, {salt}), 'k', k, 's', {n}, 'm', {_mask('k', salt)})"
        return f"transform({side}, k -> {entry})"

    found = f"concat({entries('up', 1)}, {entries('down', -1)})"
    taken = "named_struct('n', x.n - e.s, 'k', x.k ^ e.k, 'h', x.h ^ e.h)"
    # Only the cells of what was found change.
    changed = f"aggregate(filter(found, e -> getbit(e.m, i) = 1), c, (x, e) -> {taken})"
    rest = _let(
        "aggregate(found, 0L, (x, e) -> x | e.m)",
        "hit",
        f"transform(state.cells, (c, i) -> IF(getbit(hit, i) = 0, c, {changed}))",
    )
    after = f"named_struct('cells', {rest}, 'a', state.a + size(up), 'b', state.b + size(down), 'on', true)"
    after = _let(only(1), "up", _let(only(-1), "down", _let(found, "found", after)))
    ended = "named_struct('cells', state.cells, 'a', state.a, 'b', state.b, 'on', false)"
    step = f"IF(state.on, {_let(pure, 'pure', f'IF(size(pure) = 0, {ended}, {after})')}, state)"
    left = "exists(state.cells, c -> c.n <> 0 OR c.k <> 0L OR c.h <> 0)"
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('cells', {cells}, 'a', 0, 'b', 0, 'on', true), "
        f"(state, round) -> {step}, "
        f"state -> named_struct('ok', NOT {left}, 'a', state.a, 'b', state.b))"
    )


def packed_sql(cells: str) -> str:
    """A sketch as bytes: number, digests and check values of its cells."""
    # The hexadecimal form of a negative int has 16 digits, of which the last eight are its own.
    cell = (
        "concat(right(concat('0000000', hex(c.n)), 8), lpad(hex(c.k), 16, '0'), "
        "right(concat('0000000', hex(c.h)), 8))"
    )
    return f"unhex(array_join(transform({cells}, c -> {cell}), ''))"


def written_sql(cells: str) -> str:
    """A sketch as text."""
    return f"base64({packed_sql(cells)})"


def read_sql(written: str) -> str:
    """The sketch that :func:`written_sql` wrote."""

    def number(first: int, digits: int) -> str:
        # A signed number of its digits, by halves that fit.
        part = f"substr(w, c * 32 + {first}, {digits})"
        if digits == 8:
            return f"CAST(CAST(conv({part}, 16, 10) AS BIGINT) - IF({part} >= '8', 4294967296L, 0L) AS INT)"
        high, low = number(first, 8), f"CAST(conv(substr(w, c * 32 + {first + 8}, 8), 16, 10) AS BIGINT)"
        return f"shiftleft(CAST({high} AS BIGINT), 32) | {low}"

    cell = f"named_struct('n', {number(1, 8)}, 'k', {number(9, 16)}, 'h', {number(25, 8)})"
    cells = f"transform(sequence(0, {CELLS - 1}), c -> {cell})"
    return _let(f"hex(unbase64({written}))", "w", cells)


def compare_with_edit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of every document and of an edited version of it, and how alike they are.

    The edited text ends in the beginning of the next document in place of its own second half.
    ``near_edited`` and ``near_next`` are twice the common digests over the digests of both texts.
    Columns: the id, ``n_chars``, ``edited``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``
    and ``near_next``.
    """
    versions = _with_next(docs, id_col, text_col)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - half),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    kept = ("digests", "next_digests", "cells", "next_cells")
    texts = versions.select("id", "text", edited.alias("edited"), *kept).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.char_length("text").cast("long").alias("n_chars"),
        "edited",
        F.col("digests").alias("own"),
        digests(F.col("edited")).alias("of_edited"),
        F.col("next_digests").alias("of_next"),
        F.col("cells").alias("own_cells"),
        "next_cells",
    )
    sketches = texts.withColumn("edited_cells", F.expr(cells_sql("of_edited")))
    peeled = sketches.withColumns(
        {
            "edit": F.expr(peel_sql(subtract_sql("own_cells", "edited_cells"))),
            "next": F.expr(peel_sql(subtract_sql("own_cells", "next_cells"))),
        }
    )
    first = staged(
        peeled.select(
            "row",
            "id",
            "n_chars",
            F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
            F.expr(packed_sql("own_cells")).alias("fingerprint"),
            F.expr(packed_sql("edited_cells")).alias("edited_fingerprint"),
            F.size("own").alias("n_own"),
            F.size("of_edited").alias("n_edited"),
            F.size("of_next").alias("n_next"),
            "edit",
            "next",
            F.when(~F.col("edit.ok") | ~F.col("next.ok"), F.col("own")).alias("own"),
            F.when(~F.col("edit.ok"), F.col("of_edited")).alias("of_edited"),
            F.when(~F.col("next.ok"), F.col("of_next")).alias("of_next"),
        )
    )
    # Only pairs that were tried again are joined: fingerprints are most of what a row holds.
    peeled_at_once = F.col("edit.ok") & F.col("next.ok")
    again = first.filter(~peeled_at_once).join(_larger_sketches(first), "row", "left")
    whole = first.filter(peeled_at_once).withColumns(
        {f"{pair}_only": F.lit(None).cast("long") for pair in ("edit", "next")}
    )
    likeness = {}
    for pair, size in (("edit", "n_edited"), ("next", "n_next")):
        only_own = F.when(F.col(f"{pair}.ok"), F.col(f"{pair}.a")).otherwise(F.col(f"{pair}_only"))
        both = F.col("n_own") + F.col(size)
        common = (F.col("n_own") - only_own) * F.lit(2.0)
        likeness[pair] = F.when(both == 0, 1.0).otherwise(common / F.nullif(both, F.lit(0)))
    return whole.unionByName(again).select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        F.base64("fingerprint").alias("fingerprint"),
        F.base64("edited_fingerprint").alias("edited_fingerprint"),
        likeness["edit"].alias("near_edited"),
        likeness["next"].alias("near_next"),
    )


def _with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, digests, cells) of every row and of the next; only the text is shuffled, once.

    Rows are grouped by range of id. Each group also gets a copy of the first row of the group after
    it, the last group of the first one, so that the next row is always at hand.
    """
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    number = F.coalesce(F.col("id").cast("double"), F.lit(float("-inf")))
    rows = docs.count()
    groups = min(MOST_GROUPS, rows // GROUP_ROWS + 1)
    shares = [i / groups for i in range(1, groups)]
    bounds: list[float] = []
    if shares:
        cuts = texts.agg(F.percentile_approx(F.col("id").cast("double"), shares, 100 * groups)).first()[0]
        bounds = sorted(set(cuts or []))
    grouped = texts.withColumn("part", _part(number, bounds))

    # One row for every group that has rows, at most MOST_GROUPS.
    heads = grouped.groupBy("part").agg(F.min(F.struct("id")).alias("head"))
    before = Window.orderBy("part")
    last = F.max("part").over(Window.partitionBy())
    heads = staged(
        heads.select(
            F.col("head.id").alias("head"), F.coalesce(F.lag("part").over(before), last).alias("to")
        )
    )
    copies = texts.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("head"))).select(
        "id", "text", F.col("to").alias("part"), F.lit(True).alias("copy")
    )
    all_rows = grouped.withColumn("copy", F.lit(False)).unionByName(copies)
    keys = ("copy", "id", "text_hash")
    sorted_rows = (
        all_rows.withColumn("text_hash", F.xxhash64("text"))
        .repartition("part")
        .sortWithinPartitions("part", *keys)
        .withColumn("digests", digests(F.col("text")))
        .withColumn("cells", F.expr(cells_sql("digests")))
    )
    order = Window.partitionBy("part").orderBy(*keys)
    taken = ("text", "digests", "cells")
    with_next = [F.lead(name).over(order).alias(f"next_{name}") for name in taken]
    return sorted_rows.select("id", *taken, "copy", *with_next).filter("NOT copy").drop("copy")


def _part(number: Column, bounds: list[float]) -> Column:
    """How many of the sorted bounds a number reaches: first among every so many, then between."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    fine = F.array(*map(F.lit, bounds))
    coarse = F.array(*map(F.lit, bounds[step - 1 :: step]))
    passed = F.size(F.filter(coarse, lambda b: b <= number)) * step
    rest = F.slice(fine, passed + 1, F.lit(step))
    return passed + F.size(F.filter(rest, lambda b: b <= number))


def _larger_sketches(first: DataFrame) -> DataFrame:
    """(row, edit_only, next_only): digests of the document only, for pairs that did not peel."""
    pairs = [
        first.filter(f"NOT {pair}.ok").select(
            "row", F.lit(pair).alias("pair"), F.col("own").alias("a"), F.col(other).alias("b")
        )
        for pair, other in (("edit", "of_edited"), ("next", "of_next"))
    ]
    failed = reduce(DataFrame.unionAll, pairs)
    level, recovered = 0, []
    room = F.when(F.col("pair") == "edit", ROOM["edit"]).otherwise(ROOM["next"])
    while True:
        level += 1
        shares = F.greatest(F.lit(2), F.least(F.lit(MOST_SHARES), F.ceil((F.size("a") + F.size("b")) / room)))
        share = f"pmod(xxhash64(k, {level}), shares)"
        sides = (_dealt(side, share, "shares") for side in "ab")
        split = (
            failed.withColumn("shares", shares.cast("int"))
            .select("row", "pair", F.expr(f"inline(arrays_zip({', '.join(sides)}))").alias("a", "b"))
            .filter("size(a) + size(b) > 0")
        )
        difference = subtract_sql(cells_sql("a", level), cells_sql("b", level))
        few = F.size("a") + F.size("b") <= MOST_TRIED
        peeled = split.withColumn("peeled", F.when(few, F.expr(peel_sql(difference, level))))
        left = ~F.coalesce("peeled.ok", F.lit(False))
        tried = staged(
            peeled.select(
                "row",
                "pair",
                left.alias("left"),
                F.col("peeled.a").alias("only"),
                F.when(left, F.col("a")).alias("a"),
                F.when(left, F.col("b")).alias("b"),
            )
        )
        recovered.append(tried.filter("NOT left").select("row", "pair", F.col("only").alias("a")))
        failed = tried.filter("left").select("row", "pair", "a", "b")
        if failed.isEmpty():
            break
    found = reduce(DataFrame.unionAll, recovered).groupBy("row")
    return found.agg(
        F.sum(F.when(F.col("pair") == "edit", F.col("a"))).alias("edit_only"),
        F.sum(F.when(F.col("pair") == "next", F.col("a"))).alias("next_only"),
    )
