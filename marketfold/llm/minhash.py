"""Near-duplicate documents by a signature-coordinate inverted join.

Documents with equal shingle sets are one class. Every class has a MinHash signature of
``coordinates`` places and is posted under its (coordinate, value) pairs. A pair of classes that
agrees in ``matches`` of them meets in one of the first ``coordinates - matches + 1``, the prefix, and
only those are posted. It is taken from the list of its first common coordinate and skipped in all
others. Of each further coordinate up to ``bits`` the signature keeps one bit; a pair is skipped if
more of these differ than ``different``. What is left is confirmed on the full shingle sets.

Three things keep lists short and leave nothing out:

* In a list that is crowded with look-alikes, all members are compared with the smallest one first,
  which joins most of a large group of near copies. Connected pairs need no comparison.
* A shingle that no other member of crowded lists has cannot be common to a pair from such a list. A pair
  is skipped if what is left of its sets is too small. It is also skipped if too many bits of a longer
  sketch differ, which only members of such lists have.
* Members of a long list that is not crowded are posted again under pairs of coordinates, then triples and so
  on: a pair that agrees in ``matches`` places meets at each of these depths.

A pair of exactly the similarity asked for is missed with a chance of 8e-7: a third each for too few equal coordinates
(fewer than 4 of 16 at 0.8), where lists go that deep, for too many different bits (more than 52 of 256), and
for too many of the longer sketch (more than 276 of 2048), in crowded lists.

Texts without words have an empty set, are linked with nothing and are their own component. Repeated
rows and rows that share an id belong together. A null id cannot be named as a component: such a row
has a null component and is kept. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.llm.common import staged, whole_text
from marketfold.llm.components import smallest_reachable
from marketfold.llm.shingles import shingle_set


@dataclass(frozen=True)
class Likeness:
    """What counts as near: shingle length in words and intersection over union in percent.

    The numbers of coordinates and of equal ones, and of bits that may differ, follow from ``percent`` and the
    chance ``miss`` of each of the three limits to lose a pair of exactly that similarity.
    """

    words: int = 5
    percent: int = 80
    bits: int = 256
    crowd_bits: int = 2048
    miss: float = 2.7e-7
    # A list with more members that look like its smallest one is crowded.
    crowd: int = 24
    # Any other list with more members outside its largest component is posted again, one deeper. Posting a
    # member again (some ten rows, shuffled and written) costs as much as comparing it with some two thousand others.
    long_list: int = 2048

    def __post_init__(self) -> None:
        # Below a quarter, so many coordinates are needed that lists no longer tell texts apart.
        if not 25 <= self.percent <= 100:
            raise ValueError("percent must be from 25 to 100")

    @functools.cached_property
    def coordinates(self) -> int:
        """Places of a signature: as many as it takes for at least four equal ones."""
        return next(n for n in range(16, self.bits + 1, 4) if self._fewest(n) >= 4)

    @functools.cached_property
    def matches(self) -> int:
        """Equal coordinates that a near pair has."""
        return self._fewest(self.coordinates)

    @functools.cached_property
    def different(self) -> int:
        return self._most(self.bits)

    @functools.cached_property
    def crowd_different(self) -> int:
        return self._most(self.crowd_bits)

    def _fewest(self, n: int) -> int:
        """Of ``n`` coordinates, each equal with the chance of the similarity."""
        return _quantile(n, self.percent / 100, self.miss)

    def _most(self, n: int) -> int:
        """Of ``n`` bits, each different with half the chance of a different coordinate."""
        return n - _quantile(n, (1 + self.percent / 100) / 2, self.miss)


def _quantile(n: int, chance: float, miss: float) -> int:
    """The most k such that fewer than k of ``n`` events of that chance are rarer than ``miss``."""
    if chance == 1:
        return n
    below, k = 0.0, 0
    while k < n:
        ways = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
        below += exp(ways + k * log(chance) + (n - k) * log(1 - chance))
        if below > miss:
            break
        k += 1
    return k


def near_duplicates(
    docs: DataFrame, like: Likeness | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id that links lead to; a document that bears it is kept.
    """
    like = like or Likeness()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    signed = staged(
        texts.mapInArrow(
            functools.partial(_sign, like=like), "id long, n int, digest binary, sig array<long>, bits array<long>"
        )
    )
    classes = signed.filter("n > 0 AND id IS NOT NULL").groupBy("digest")
    nodes = staged(
        classes.agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bits").alias("bits"))
    )
    links = _links(nodes, texts, like)
    # One id may stand in several classes; it connects them.
    shared = (
        signed.filter("n > 0 AND id IS NOT NULL")
        .select("digest", "id")
        .join(nodes.select("digest", "node"), "digest")
        .filter("id <> node")
        .join(nodes.select(F.col("node").alias("id")), "id", "left_semi")
        .select(F.col("id").alias("a"), F.col("node").alias("b"))
    )
    found = staged(smallest_reachable(links.unionAll(shared)))
    of_class = staged(
        nodes.join(found, "node", "left").select(
            "digest", F.coalesce("component", "node").alias("component")
        )
    )
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return (
        signed.select("id", "n", "digest")
        .join(of_class, "digest", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), component).alias("component_id"),
            (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
        )
    )


def _links(nodes: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """Confirmed links (a, b) between classes that connect all near duplicates."""
    prefix = like.coordinates - like.matches + 1
    posted = nodes.select("node", F.explode(F.slice("sig", 1, prefix)).alias("key"))
    repeated = staged(
        posted.groupBy("key")
        .agg(F.count("*").alias("size"), F.min("node").alias("hub"))
        .filter("size > 1")
    )
    lists = staged(posted.join(repeated, "key"))
    crowd, starred = _crowded(lists, nodes, texts, like)
    joined = staged(smallest_reachable(starred))

    # Every node once with all of its lists: what it brings along is joined by node only here.
    own_lists = (
        lists.select("key", F.shiftright("key", 32).cast("int").alias("place"), "node")
        .join(crowd.keys, "key", "left")
        .groupBy("node")
        .agg(F.collect_list(F.struct("key", "place", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("own"))
    )
    known = own_lists.join(nodes.drop("digest"), "node").join(joined, "node", "left")
    known = known.join(crowd.members, "node", "left")
    members = known.select(
        "node", "n", "sig", "bits", F.coalesce("component", "node").alias("component"), "alone", "longer", F.inline("own")
    )
    members = members.withColumns(
        {
            "alone": F.when(F.col("crowded"), F.coalesce("alone", F.lit(0))).otherwise(0),
            "longer": F.when(F.col("crowded"), F.col("longer")),
        }
    )
    found = None
    depth = 1
    while True:
        members = staged(members)
        groups = members.groupBy("key", "component").agg(F.count("*").alias("size"))
        shape = groups.groupBy("key").agg(
            F.max_by("component", F.struct("size", "component")).alias("largest"),
            (F.sum("size") - F.max("size")).alias("others"),
        )
        members = staged(members.join(shape.filter("others > 0"), "key"))
        short = F.col("crowded") | (F.col("others") <= like.long_list)
        short = short | F.lit(depth == like.matches)
        pairs = staged(_pairs_across(members.filter(short), depth, like))
        found = pairs if found is None else found.unionAll(pairs)
        long = members.filter(~short)
        if depth == like.matches or long.isEmpty():
            break
        depth += 1
        members = _deeper(long, depth, like)
    return starred.unionAll(_confirm(found.distinct(), _sets_of(found, texts, like), like))


@dataclass(frozen=True)
class _Crowd:
    """``keys``: (key, crowded) of the crowded lists. ``members``: (node, alone, longer), the number of
    shingles that no other member of any of them has, and the longer sketch."""

    keys: DataFrame
    members: DataFrame


def _crowded(
    lists: DataFrame, nodes: DataFrame, texts: DataFrame, like: Likeness
) -> tuple[_Crowd, DataFrame]:
    """Lists with many members that look like their smallest one, and the links to that one."""
    long = lists.filter((F.col("size") > like.crowd) & (F.col("node") != F.col("hub")))
    stars = long.select("key", F.col("hub").alias("a"), F.col("node").alias("b"))
    near = (F.least("n_a", "n_b"), F.greatest("n_a", "n_b"))
    stars = staged(
        stars.join(_signed(nodes, "a"), "a")
        .join(_signed(nodes, "b"), "b")
        .filter((near[0] * 100 >= near[1] * like.percent) & _alike("bits_a", "bits_b", like))
        .select("key", "a", "b")
    )
    keys = stars.groupBy("key").agg((F.count("*") > like.crowd).alias("crowded"))
    keys = staged(keys.filter("crowded"))
    members = lists.join(keys, "key").select("node").distinct()
    sets = _sets_of(members.select(F.col("node").alias("a"), F.col("node").alias("b")), texts, like)
    shingles = sets.mapInArrow(_each_shingle, "node long, shingle long")
    alone = (
        shingles.groupBy("shingle")
        .agg(F.count("*").alias("seen"), F.min("node").alias("node"))
        .filter("seen = 1")
        .groupBy("node")
        .agg(F.count("*").cast("int").alias("alone"))
    )
    longer = sets.mapInArrow(
        functools.partial(_longer, bits=like.crowd_bits), "node long, longer array<long>"
    )
    both = longer.join(alone, "node", "left").fillna(0, "alone")
    pairs = stars.join(keys, "key").select("a", "b").distinct()
    return _Crowd(keys, staged(both)), _confirm(pairs, sets, like)


def _deeper(long: DataFrame, depth: int, like: Likeness) -> DataFrame:
    """Members of long lists under one more coordinate, after the last one."""
    # The d-th of the required matches lies in the first ``coordinates - matches + d``.
    last = like.coordinates - like.matches + depth - 1
    following = F.slice("sig", F.col("place") + 2, F.lit(last) - F.col("place"))
    return (
        long.filter(F.col("place") < last)
        .select("node", "n", "sig", "bits", "component", "alone", "key", F.explode(following).alias("next"))
        .select(
            F.xxhash64("key", "next").alias("key"),
            F.shiftright("next", 32).cast("int").alias("place"),
            "node",
            "n",
            "sig",
            "bits",
            "component",
            F.lit(False).alias("crowded"),
            "alone",
            F.lit(None).cast("array<long>").alias("longer"),
        )
    )


def _pairs_across(members: DataFrame, depth: int, like: Likeness) -> DataFrame:
    """Pairs of a list between different components, one side outside the largest of them.

    Only pairs whose common coordinates up to the list's own are those of the list, ``depth`` in number.
    """
    words = [F.col("bits")[i].alias(f"w{i}") for i in range(like.bits // 64)]
    wide = members.select(
        "key", "place", "node", "n", "component", "largest", "alone", "sig", "longer", *words
    )
    # Of its own shingles a near pair has that share at least in common.
    enough = (F.col("n") - F.col("alone")) * 100 >= F.col("n") * like.percent
    wide = wide.filter(enough)
    # Sizes of near sets differ by less than a class and a bit; a pair meets in the class of its right side.
    size = F.floor(F.log("n") / log(101 / like.percent))
    left = wide.filter("component <> largest").withColumn("class", size)
    left = left.withColumn("class", F.explode(F.sequence(F.col("class") - 1, F.col("class") + 1)))
    left = left.withColumnsRenamed({name: f"{name}_a" for name in left.columns})
    right = wide.withColumn("class", size)
    right = right.withColumnsRenamed({name: f"{name}_b" for name in right.columns})
    differ = [
        F.bit_count(F.col(f"w{i}_a").bitwiseXOR(F.col(f"w{i}_b"))) for i in range(like.bits // 64)
    ]
    # As a loop: written out, the condition would be too long a method for the JVM to compile.
    further = F.aggregate(
        F.zip_with("longer_a", "longer_b", lambda a, b: F.bit_count(a.bitwiseXOR(b))),
        F.lit(0),
        lambda total, each: total + each,
    )

    def upto(side: str) -> Column:
        return F.slice(F.col(f"sig_{side}"), F.lit(1), F.col("place_a") + 1)

    usable = F.least(F.expr("n_a - alone_a"), F.expr("n_b - alone_b"))
    condition = (
        (F.col("key_a") == F.col("key_b"))
        & (F.col("class_a") == F.col("class_b"))
        & (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("largest_b")) | (F.col("node_a") < F.col("node_b")))
        & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * like.percent)
        # Of both sets together, the common part of a near pair is percent / (100 + percent).
        & (usable * (100 + like.percent) >= (F.col("n_a") + F.col("n_b")) * like.percent)
        & (sum(differ[1:], differ[0]) <= like.different)
        & (F.coalesce(further, F.lit(0)) <= like.crowd_different)
        & (F.size(F.array_intersect(upto("a"), upto("b"))) == depth)
    )
    return left.join(right, condition).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
    )


def _signed(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(
        F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")
    )


def _alike(a: str, b: str, like: Likeness) -> Column:
    differ = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(like.bits // 64)]
    return sum(differ[1:], differ[0]) <= like.different


def _sets_of(pairs: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """(id, shingles) of all nodes in the pairs (a, b)."""
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    return staged(
        texts.filter("id IS NOT NULL")
        .join(wanted.hint("shuffle_hash"), "id")
        .mapInArrow(functools.partial(_sets, words=like.words), "id long, shingles binary")
    )


def _confirm(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets are near."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    near = both.mapInArrow(functools.partial(_near, percent=like.percent), "a long, b long")
    return staged(near.distinct())


def signature(shingles: np.ndarray, places: int) -> np.ndarray:
    """The least value of every place's own hash over the set."""
    odd, shift = _place_hashes(places)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(places, np.iinfo(np.uint32).max, np.uint32)
    # In slices, so that a very long text takes no more memory than another.
    for start in range(0, len(short), 512):
        hashed = short[start : start + 512, None] * odd
        hashed += shift
        least = np.minimum(least, hashed.min(axis=0))
    return least


@functools.cache
def _place_hashes(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    odd, shift = random.integers(0, 2**32, (2, n), np.uint32)
    return odd | np.uint32(1), shift


def sketch_bits(least: np.ndarray) -> np.ndarray:
    """One bit of each place, packed into 64-bit numbers."""
    bits = (least * np.uint32(0x9E3779B1)) >> np.uint32(31)
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], like: Likeness) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(text, like.words) for text in batch["text"].to_pylist()]
        least = [signature(each, like.bits) if len(each) else None for each in sets]
        posted = [x if x is None else _placed(x[: like.coordinates]) for x in least]
        bits = [x if x is None else sketch_bits(x) for x in least]
        yield pa.RecordBatch.from_arrays(
            [
                batch["id"],
                pa.array([len(each) for each in sets], pa.int32()),
                pa.array([xxhash.xxh3_128_digest(each.tobytes()) for each in sets], pa.binary()),
                pa.array(posted, pa.list_(pa.int64())),
                pa.array(bits, pa.list_(pa.int64())),
            ],
            ["id", "n", "digest", "sig", "bits"],
        )


def _placed(least: np.ndarray) -> np.ndarray:
    """Values with their places in the upper half, so that no two places share one."""
    return np.arange(len(least), dtype=np.int64) << 32 | least.astype(np.int64)


def _longer(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = (np.frombuffer(each.as_py(), np.uint64) for each in batch["shingles"])
        sketches = [sketch_bits(signature(each, bits)) for each in sets]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(sketches, pa.list_(pa.int64()))], ["node", "longer"]
        )


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, shingles in zip(batch["id"].to_pylist(), batch["shingles"], strict=True):
            own = np.frombuffer(shingles.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), node, np.int64)), pa.array(own)], ["node", "shingle"]
            )


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(text, words).tobytes() for text in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sets, pa.binary())], ["id", "shingles"])


def _near(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch["set_a"], batch["set_b"], strict=True):
            left, right = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
            common = len(np.intersect1d(left, right, assume_unique=True))
            keep.append(100 * common >= percent * (len(left) + len(right) - common))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"]
        )
