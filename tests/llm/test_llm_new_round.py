from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketfold.llm import merkle, minhash, queries, sketch, spelling, suffixes

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# --- Merkle trees --------------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grow(nodes):
    """The top of a tree and, for every leaf, what stands before and after it on its way up."""
    ways = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(place):
            run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
            ways[i].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
            place[i] = at // 8
        nodes = [digest(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], ways


def merkle_brute_force(rows):
    """Rows (doc_id, source, lang, n_chars, text); result rows as the query has them."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row, digest(*map(field, row))))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda each: (each[0][0] is not None, each[0][0] or 0, each[1]))
        trees[lang] = grow([leaf for _, leaf in groups[lang]])
    root, crown = grow([trees[lang][0] for lang in order])
    out = []
    for lang, above in zip(order, crown, strict=True):
        for (row, leaf), way in zip(groups[lang], trees[lang][1], strict=True):
            shown = leaf
            if row[0] is not None and crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                shown = digest(*map(field, row[:4]), field(row[4].translate(LOWER)))
            for before, after in way + above:
                shown = digest(before, shown, after)
            proof = digest(*[b + a for b, a in way + above])
            out.append((row[0], leaf, trees[lang][0], root, proof, shown, shown == root))
    return sorted(out, key=str)


def documents_table(spark, folder, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def merkle_rows(seed):
    pick = random.Random(seed)
    sizes = {"en": 70, "de": 9, "fr": 8, "Fr": 1, None: 3, "": 1, "é": 64}
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = pick.choice([None, "", "Straße ÄÖ", "lower", "Mixed Case", "x" * 5000 + "Y"])
            rows.append((len(rows) + 7, pick.choice(["s", None, ""]), lang, pick.choice([None, 5]), text))
    # Rows that repeat, share an id or have none.
    rows += [rows[0], rows[0], (rows[1][0], "other", "en", 1, "Again"), (None, None, "en", None, None)]
    rows += [(None, "a", "en", 2, "B"), (None, None, None, None, None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_proofs_equal_those_of_one_list(spark, tmp_path, seed):
    rows = merkle_rows(seed)
    found = queries.op11_merkle(spark, documents_table(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, found), key=str) == merkle_brute_force(rows)
    assert {r["verified"] for r in found} == {True, False}


@pytest.mark.parametrize("rows", [[], [(1, "s", None, 1, "A")], [(i, "s", "en", 1, "A") for i in range(9)]])
def test_small_datasets_have_roots(spark, tmp_path, rows):
    found = queries.op11_merkle(spark, documents_table(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, found), key=str) == (merkle_brute_force(rows) if rows else [])


def test_a_tree_of_other_columns_keeps_what_it_is_given(spark):
    df = spark.range(30).selectExpr(
        "id % 2 AS place", "id AS proof", "sha2(string(id), 256) AS node", "id * 2 AS row", "'z' AS g"
    )
    found = merkle.build(df, "place", "proof", "node", "row").orderBy("row").collect()
    assert [r["row"] for r in found] == [2 * i for i in range(30)]
    assert len({r["subroot"] for r in found}) == 2 and len({r["root"] for r in found}) == 1


# --- spelling ------------------------------------------------------------------------------------


def near(a, b):
    """One inserted, deleted or replaced character."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def spelling_brute_force(rows, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    out, form = {}, {}
    for word, n in words.items():
        close = [w for w in words if near(word, w)]
        best = min(close, key=lambda w: (-words[w], w), default=None)
        if best is not None and words[best] >= 5 * n:
            form[word] = best
        out[word] = (n, len(close))
    rows = []
    for word, (n, n_near) in out.items():
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n, n_near, words[form[word]] if word in form else None))
    return sorted(rows)


def variants(pick, word):
    letters = "abcdefghijklmnopqrstuvwxyzéßÀ÷"
    i = pick.randrange(len(word))
    kind = pick.randrange(3)
    return word[:i] + (pick.choice(letters) if kind else "") + word[i + (kind != 1) :]


def spelling_rows(seed):
    pick = random.Random(seed)
    base = ["banana", "bananas", "anananana", "aaaaaa", "aaaaaaa", "Übermut", "übermut", "abcdefg", "xyzxyzxyz"]
    base += ["".join(pick.choice("abcé") for _ in range(pick.randint(6, 9))) for _ in range(60)]
    words = []
    for word in base:
        words += [word] * pick.choice([1, 6, 30, 160])
        for _ in range(4):
            once = variants(pick, word)
            words += [once] * pick.choice([4, 5, 6])
            words += [variants(pick, once)] * pick.choice([1, 5])
    pick.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    return [*rows, (None, "banana, BANANA"), (3, None), (4, ""), (5, "abcdefg " * 3000), (5, "abcdefg " * 3000)]


@pytest.mark.parametrize("seed", range(3))
def test_variants_equal_those_of_all_pairs(spark, docs, seed):
    rows = spelling_rows(seed)
    counted = spelling.count_words(docs(rows)).filter("n >= 5")
    found = spelling.group_variants(counted).collect()
    assert sorted(map(tuple, found)) == spelling_brute_force(rows)


def test_no_words(spark, docs):
    assert spelling.group_variants(spelling.count_words(docs([(1, None), (2, "a b")]))).collect() == []
    assert spelling.group_variants(spelling.count_words(docs([]))).collect() == []


def test_chains_of_forms_lead_to_one_root(spark):
    rows = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 125), ("aaabbb", 625), ("aabbbb", 3125), ("zzzzzz", 5)]
    found = spelling.group_variants(spark.createDataFrame(rows, "word string, n long")).collect()
    assert {r["word"]: r["root"] for r in found} == {w: "aabbbb" if w != "zzzzzz" else w for w, _ in rows}


def test_ties_of_forms_go_to_the_smallest_word(spark):
    rows = [("aaaaaa", 1), ("aaaaac", 9), ("aaaaab", 9), ("aaaaaé", 9)]
    found = spelling.group_variants(spark.createDataFrame(rows, "word string, n long")).collect()
    assert {r["word"]: r["form"] for r in found}["aaaaaa"] == "aaaaab"


def test_pivots_are_the_cheapest_disjoint_pair():
    pick = random.Random(3)
    for _ in range(500):
        at = sorted(pick.sample(range(1, 12), pick.randint(3, 7)))
        prefix = [(i, pick.randint(1, 9)) for i in at]
        cost = dict(prefix)
        a, b = spelling.cheapest_pair(prefix)
        assert b - a >= 2
        assert cost[a] + cost[b] == min(cost[i] + cost[j] for i in at for j in at if j - i >= 2)


def test_words_too_short_for_the_method_are_an_error(spark):
    with pytest.raises(Exception, match="too short"):
        spelling.near_pairs(spark.createDataFrame([("abc",)], "word string")).collect()


# --- repeated byte strings -----------------------------------------------------------------------


def text_hash(spark, text):
    return spark.range(1).select(F.xxhash64(F.lit(text), F.lit(False))).first()[0]


def repeats_brute_force(rows, window=100):
    """Rows in order; (n_bytes, spans, kept) of each."""
    seen, out = set(), []
    for text in rows:
        data = (text or "").encode()
        marked = bytearray(len(data))
        for i in range(len(data) - window + 1):
            piece = data[i : i + window]
            if piece in seen:
                marked[i : i + window] = b"\1" * window
            seen.add(piece)
        edges = [m.span() for m in re.finditer(b"\1+", bytes(marked))]
        out.append((len(data), edges, bytes(c for c, m in zip(data, marked, strict=True) if not m)))
    return out


def cut(df, **how):
    found = suffixes.cut_repeats(df, suffixes.Repeats(**how)).collect()
    return [(r["doc_id"], (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))) for r in found]


def repeat_rows(seed):
    pick = random.Random(seed)

    def prose(n):
        return " ".join("".join(pick.choice("aeiostrné") for _ in range(pick.randint(1, 8))) for _ in range(n))

    shared = [prose(30) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(pick.randint(0, 40)) for _ in range(3)]
        for _ in range(pick.randint(0, 3)):
            passage = pick.choice(shared)
            start = pick.randrange(len(passage) - 100)
            parts.insert(pick.randrange(len(parts) + 1), passage[start : start + pick.randint(90, 160)])
        rows.append((i * 3, pick.choice([" ", "", "\n"]).join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    rows += [(300, "ab" * 700), (301, "x" * 99), (302, "x" * 100), (303, "x" * 101), (304, None), (305, "")]
    return rows + [(306, "x" * 5000 + prose(20)), (307, "\n".join([prose(25)] * 4))]


@pytest.mark.parametrize("seed", range(3))
def test_repeats_equal_those_of_all_windows(docs, seed):
    rows = repeat_rows(seed)
    expected = repeats_brute_force([text for _, text in sorted(rows, key=lambda r: r[0])])
    found = dict(cut(docs(random.Random(seed).sample(rows, len(rows))).repartition(3)))
    assert found == dict(zip(sorted(i for i, _ in rows), expected, strict=True))


@pytest.mark.parametrize("how", [{"window": 40, "gram": 20}, {"window": 300, "gram": 64}, {"window": 8, "gram": 8}])
def test_other_windows(docs, how):
    rows = repeat_rows(9)
    expected = repeats_brute_force([text for _, text in rows], how["window"])
    assert sorted(cut(docs(rows), **how)) == sorted(zip([i for i, _ in rows], expected, strict=True))


def test_slices_hot_grams_and_small_buckets_change_nothing(docs, monkeypatch):
    # What workers see of a changed constant is the sliced text itself, so this part runs in this process.
    rows = repeat_rows(4)
    how = suffixes.Repeats()
    data = "\n".join(text or "" for _, text in rows).encode() * 2
    whole = np.frombuffer(data, np.uint8)
    monkeypatch.setattr(suffixes, "SLICE", 777)
    windows = 0
    for found in suffixes.samples(whole, how):
        assert (found["start"] // 777 == (found["start"] + found["length"] - 1) // 777).all()
        windows += int(found["length"].sum())
    assert windows == len(data) - how.window + 1
    several = suffixes._concat(
        [f | suffixes._key_columns(True, 1, 5, len(f["gram"])) for f in suffixes.samples(whole, how)]
    )
    monkeypatch.setattr(suffixes, "HOT", 1)
    batch = suffixes._sent_triples(several, how, 7, 3)
    kinds = Counter()
    for part, packed in zip(batch["part"].to_pylist(), batch["packed"].to_pylist(), strict=True):
        if part is None:
            kinds.update(suffixes._unpack(packed)["kind"].tolist())
    assert kinds[1] > kinds[2] > 0
    merged = suffixes._name_triples(pa.Table.from_batches([batch]), how, 3)
    assert sum(merged["opened"].to_pylist()) > 0


def test_equal_ids_null_ids_and_repeated_rows(spark, docs):
    a, b, c = ("".join(random.Random(k).choices("abcdefgh ", k=300)) for k in "abc")
    rows = [(7, a), (7, a + b), (7, a), (None, c), (None, c), (9, c), (9, "short"), (9, "short")]
    found = cut(docs(rows).repartition(4))
    assert len(found) == len(rows)
    # Null ids come first; of equal rows one is first. Texts of one id are in the order of their hash.
    first, second = sorted([a, a + b], key=lambda text: text_hash(spark, text))
    one, two = repeats_brute_force([first, second])
    copy = (300, [(0, 300)], b"")
    assert sorted(r for i, r in found if i == 7) == sorted([one, two, copy])
    assert sorted(r for i, r in found if i is None) == sorted([(300, [], c.encode()), copy])
    assert sorted(r for i, r in found if i == 9) == sorted([copy, (5, [], b"short"), (5, [], b"short")])


def test_no_documents_and_one_very_long_text(docs):
    assert cut(docs([])) == []
    unit = "".join(random.Random(1).choices("abcdefghij klmnop", k=400_000))
    found = cut(docs([(1, unit + unit[:1000] + "#" + unit[5:700_000])]))
    n, spans, kept = found[0][1]
    assert n == 800_996
    assert spans[0][0] == 400_000 and kept.startswith(unit.encode()) and n - len(kept) == sum(e - s for s, e in spans)
    assert len(kept) <= 400_000 + 202


# --- stored sketches, and similarities other than 80 percent --------------------------------------


def test_stored_sketches_read_back_subtract_and_peel(spark):
    pick = random.Random(6)
    common = [pick.randrange(-(2**63), 2**63) for _ in range(200)]
    a = [pick.randrange(-(2**63), 2**63) for _ in range(9)]
    b = [pick.randrange(-(2**63), 2**63) for _ in range(7)]
    df = spark.createDataFrame([(common + a, common + b)], "a array<long>, b array<long>")
    cells = df.selectExpr(f"{sketch.cells_sql('a')} AS a", f"{sketch.cells_sql('b')} AS b")
    stored = cells.selectExpr("a", "b", f"{sketch.written_sql('a')} AS wa", f"{sketch.written_sql('b')} AS wb")
    row = stored.selectExpr(
        f"{sketch.read_sql('wa')} = a AS same",
        f"{sketch.peel_sql(sketch.subtract_sql(sketch.read_sql('wa'), sketch.read_sql('wb')))} AS peeled",
    ).first()
    assert row["same"]
    assert (row["peeled"]["ok"], row["peeled"]["a"], row["peeled"]["b"]) == (True, 9, 7)


@pytest.mark.parametrize(("percent", "common"), [(60, 78), (90, 96)])
def test_pairs_just_above_another_similarity_are_all_found(docs, percent, common):
    rows = []
    for pair in range(150):
        words = [f"w{pair}x{i}" for i in range(100)]
        other = words[:common] + [f"v{pair}x{i}" for i in range(100 - common)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(other))]
    # Single words: of the 200 - common different ones, common are in both.
    assert 100 * common >= percent * (200 - common)
    found = minhash.near_duplicates(docs(rows), minhash.Likeness(words=1, percent=percent)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i // 2 * 2 for i, _ in rows}


def test_the_limits_at_80_percent_are_those_derived_by_hand():
    like = minhash.Likeness()
    assert (like.coordinates, like.matches, like.different, like.crowd_different) == (16, 4, 52, 276)
    with pytest.raises(ValueError, match="percent"):
        minhash.Likeness(percent=10)
