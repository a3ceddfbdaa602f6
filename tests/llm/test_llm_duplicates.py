from __future__ import annotations

import random
import re

import pytest

from marketfold.llm import lines, minhash
from marketfold.llm.components import smallest_reachable
from marketfold.llm.shingles import shingle_set

WORD = re.compile("[^\x20\x09-\x0d]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size):
    words = WORD.findall((text or "").translate(SMALL))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(rows, size, percent=80):
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in root}


def test_shingle_sets_have_the_size_of_word_sets():
    texts = ["", " ", "a", "A a", "A b C d e", "\x0b\x0cé É", "x\ty\nz w v", "one two " * 40]
    for size in (1, 4, 5):
        for text in texts:
            assert len(shingle_set(text, size)) == len(shingles(text, size))
    assert (shingle_set("A b C", 2) == shingle_set("a B c", 2)).all()


def copies(pick, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(pick.randint(0, edits)):
            words[pick.randrange(len(words))] = f"n{pick.randrange(10**9)}"
        out.append(" ".join(words))
    return out


def corpus(seed):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [pick.choice(vocabulary) for _ in range(120)]
    line = " ".join(pick.choice(vocabulary) for _ in range(15))
    texts = copies(pick, base, 70, 9) + [" ".join(base)] * 5
    texts += [f"{line} " + " ".join(pick.choice(vocabulary) for _ in range(30)) for _ in range(60)]
    for _ in range(10):
        own = [pick.choice(vocabulary) for _ in range(pick.randint(3, 60))]
        texts += copies(pick, own, 4, 2)
    texts += [None, "", "  ", "one", "ONE", "one two", "a b c d", "a b c d e"]
    pick.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "crowd", "long_list"), [(1, 24, 128), (2, 3, 3), (3, 999, 1), (4, 1, 1)])
def test_components_equal_those_of_all_pairs(docs, seed, crowd, long_list):
    rows = corpus(seed)
    like = minhash.Likeness(words=4, crowd=crowd, long_list=long_list)
    found = minhash.near_duplicates(docs(rows).repartition(6), like).collect()
    expected = components(rows, 4)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t, 4)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_with_null_ids_shared_ids_and_repeated_rows(docs):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = [(None, a), (4, a), (4, a), (2, b), (4, b), (9, None), (7, "x y z")]
    found = minhash.near_duplicates(docs(rows)).collect()
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in found)
    assert got == [
        (0, None, True),
        (2, 2, True),
        (4, 2, False),
        (4, 2, False),
        (4, 2, False),
        (7, 7, True),
        (9, 9, True),
    ]


def test_near_duplicates_of_nothing(docs):
    assert minhash.near_duplicates(docs([])).collect() == []
    assert minhash.near_duplicates(docs([(1, None)])).collect()[0].kept


def test_smallest_reachable_follows_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(500 + i, 7) for i in range(50)] + [(520, 300), (8, 300)]
    found = smallest_reachable(spark.createDataFrame(path + hub, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, 8, 300, *range(500, 550)]}
    assert smallest_reachable(spark.createDataFrame([], "a long, b long")).collect() == []


def runs(numbered, least):
    """(first, last) places of all runs that fall below ``least`` words without an end line."""
    found = set()
    for a in range(len(numbered)):
        for b in range(a, len(numbered)):
            words = [len(line.split()) for _, line in numbered[a : b + 1]]
            if sum(words) >= least and (sum(words[1:]) < least or sum(words[:-1]) < least):
                found.add((a, b))
    return sorted(found)


def deleted(rows, least):
    first, gone = {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        own = gone.setdefault(i, set())
        numbered = [(k, x.strip()) for k, x in enumerate((text or "").split("\n")) if x.split()]
        for a, b in runs(numbered, least):
            place = first.setdefault(tuple(x for _, x in numbered[a : b + 1]), (i, a))
            if place != (i, a):
                own |= set(range(numbered[a][0], numbered[b][0] + 1))
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_deleted_lines_are_all_that_stand_at_an_earlier_place(docs, seed):
    pick = random.Random(seed)
    pool = [" ".join(f"w{pick.randrange(99)}" for _ in range(pick.randint(0, 6))) for _ in range(12)]
    rows = []
    for i in range(40):
        own = [pick.choice(pool) if pick.random() < 0.7 else f" u{i} {k} v" for k in range(pick.randint(0, 14))]
        rows.append((i, "\n".join(own)))
    found = lines.repeated_lines(docs(rows), passage_words=3, run_words=8).collect()
    got = {r.id: {k for s in r.spans for k in range(s.first, s.last + 1)} for r in found}
    expected = {i: gone for i, gone in deleted(rows, 8).items() if gone}
    assert got == expected
    left = lines.delete_repeated_lines(docs(rows), passage_words=3, run_words=8).collect()
    kept = {}
    for i, text in rows:
        rest = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in expected.get(i, ()))
        if rest.strip() or i not in expected:
            kept[i] = rest
    assert {r.doc_id: r.text for r in left} == kept
    assert all((r.id, r.node, r.key) == ("x", 7, "z") for r in left)


def test_line_dedup_of_null_empty_repeated_and_unnamed_documents(docs):
    passage = "\n".join(" ".join(f"p{i}_{j}" for j in range(30)) for i in range(2))
    rows = [(3, passage), (3, passage), (None, passage), (5, None), (6, ""), (8, f"own\n{passage}\nend")]
    left = lines.delete_repeated_lines(docs(rows)).collect()
    got = sorted(((r.doc_id or 0), r.text) for r in left if r.text is not None)
    # Nulls come first, so the unnamed document keeps the passage, and document 3 is emptied.
    assert got == [(0, passage), (6, ""), (8, "own\nend")]
    assert [r.doc_id for r in left if r.text is None] == [5]
    assert lines.delete_repeated_lines(docs([])).collect() == []


def test_a_long_passage_inside_other_lines_is_found(docs):
    passage = "\n".join(" ".join(f"p{i}_{j}" for j in range(13)) for i in range(4))
    rows = [(i, f"before {i} alone\n{passage}\nafter {i} alone") for i in range(6)]
    left = {r.doc_id: r.text for r in lines.delete_repeated_lines(docs(rows)).collect()}
    assert left == {0: rows[0][1]} | {i: f"before {i} alone\nafter {i} alone" for i in range(1, 6)}
