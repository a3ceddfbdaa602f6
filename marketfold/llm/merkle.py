"""A Merkle tree over the rows of a dataset, grouped, with a proof for every row.

Every row is a leaf: the hash of its fields. The leaves of a group, in order, are the children of a tree whose
nodes have ``FANOUT`` children, the last of a level fewer. The tops of all groups, in order, are the leaves of
one more tree; its top is the root of the dataset.

A level is built by a slot pivot: children are grouped by their place divided by the fanout, and a conditional
aggregate for each slot spreads them into ``FANOUT`` columns. The columns in order make the parent's hash; the
columns without a child's own make its siblings. The proof of a row is its siblings, level by level up to the
root. Proofs are written from the top down: a parent hands its own proof to its children, so that what is
shuffled is a proof for each parent of leaves and not for each leaf.

No task sees a whole group: places come from a range partitioning by group and order with counted offsets.

Nulls: any field may be null and is hashed as such; null is a group of its own and comes first, as do rows
with a null key inside a group. Rows with equal keys follow each other by their leaf hash; rows equal in all fields
are leaves of their own. An empty table has no leaves, and no rows come out. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketfold.llm.common import staged

FANOUT = 8
# monotonically_increasing_id counts a partition's rows in its lower bits.
_ROW_BITS = 33
# A proof: what stands before and after a node in its run, level by level.
_PROOF = "array<struct<before:string,after:string>>"


def field(column: Column) -> Column:
    """A field as it is hashed: its length in bytes and its value, or a dash for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Hash of the concatenated parts, in lowercase hex."""
    return F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(
        proof, leaf, lambda node, step: digest(step["before"], node, step["after"])
    )


def proof_digest(proof: Column) -> Column:
    """Hash of all siblings of a proof, in order."""
    return digest(
        F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")
    )


def build(leaves: DataFrame, group: str, order: str, leaf: str, *payload: str) -> DataFrame:
    """Every leaf with its ``proof``, the ``subroot`` of its group and the ``root``.

    ``leaf`` names the column with the hash of a row. Leaves are ordered in their group by ``order``, then by
    ``leaf``. Columns: ``order``, ``leaf``, ``payload`` and the three above. Runs jobs when called.
    """
    rows = leaves.select(
        F.col(group).alias("g"),
        F.col(order).alias("o"),
        F.col(leaf).alias("node"),
        F.struct(F.col(order).alias("o"), *[F.col(each) for each in payload]).alias("row"),
    )
    forest = _grown(_placed(staged(rows), "o", "node"))
    # The tops of the groups, in the order of the groups, as the one group of another tree.
    tops = forest.tops.select(
        F.lit(0).alias("g"),
        F.col("g").alias("o"),
        "node",
        F.struct("g", "depth").alias("row"),
    )
    crown = _grown(_placed(staged(tops), "o", "node"))
    root = crown.tops.select(
        "g", "depth", F.array().cast(_PROOF).alias("proof"), F.struct(F.col("node").alias("root")).alias("top")
    )
    subroots = crown.proofs(root).select(
        "row.g",
        "row.depth",
        "proof",
        F.struct(F.col("node").alias("subroot"), "top.root").alias("top"),
    )
    return forest.proofs(staged(subroots)).select(
        F.col("row.o").alias(order),
        F.col("node").alias(leaf),
        *[F.col("row")[each].alias(each) for each in payload],
        "proof",
        "top.subroot",
        "top.root",
    )


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """(g, place, n, node, row): the place of each row in its group, from 0, and the rows of the group.

    The row's number breaks ties of the range partitioning, so that equal rows may be in several partitions.
    """
    # Strings compare by their bytes.
    by = [F.col(name).asc_nulls_first() for name in ("g", *order)]
    numbered = staged(
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*by, "tie")
        .sortWithinPartitions(*by, "tie")
        .select("g", "node", "row", F.monotonically_increasing_id().alias("at"))
    ).withColumn("part", F.shiftright("at", _ROW_BITS))
    # Rows are sorted by group, so these are at most as many as partitions and groups together.
    shares = numbered.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("share"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        F.col("g").alias("share_g"),
        F.col("part").alias("share_part"),
        (F.coalesce(F.sum("share").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("share").over(whole).alias("n"),
    )
    same = F.col("g").eqNullSafe(F.col("share_g")) & (F.col("part") == F.col("share_part"))
    return staged(
        numbered.join(staged(shares), same).select(
            "g", (F.col("at") + F.col("shift")).alias("place"), "n", "node", "row"
        )
    )


@dataclass(frozen=True)
class _Tree:
    """The trees of all groups: leaves, the parents of each level with their children in an array, and the
    tops (g, node, depth)."""

    leaves: DataFrame
    parents: list[DataFrame]
    tops: DataFrame

    def proofs(self, starts: DataFrame) -> DataFrame:
        """(node, row, proof, top) of all leaves. ``starts``: (g, depth, proof, top), the proof of each top."""
        columns = ("g", "place", "proof", "top")

        def beginning(depth: int) -> DataFrame:
            here = starts.filter(F.col("depth") == depth)
            return here.withColumn("place", F.lit(0).cast("long"))

        # Groups of a single leaf have no level above.
        alone = self.leaves.filter("n = 1").alias("leaf")
        same = F.col("leaf.g").eqNullSafe(F.col("start.g"))
        alone = alone.join(beginning(0).alias("start"), same).select("node", "row", "proof", "top")
        if not self.parents:
            return alone
        known = beginning(len(self.parents)).select(*columns)
        for depth in range(len(self.parents), 0, -1):
            same = F.col("p.g").eqNullSafe(F.col("k.g")) & (F.col("p.place") == F.col("k.place"))
            parents = self.parents[depth - 1].alias("p").join(known.alias("k"), same)
            children = parents.select(
                "p.g", "p.place", "proof", "top", F.explode("children").alias("child")
            )
            proof = F.concat(F.array(F.col("child.step")), "proof").alias("proof")
            if depth == 1:
                return children.select("child.node", "child.row", proof, "top").unionAll(alone)
            place = (F.col("place") * FANOUT + F.col("child.slot")).alias("place")
            known = children.select("g", place, proof, "top")
            known = staged(known.unionAll(beginning(depth - 1).select(*columns)))


def _grown(leaves: DataFrame) -> _Tree:
    """All levels above ``leaves`` (g, place, n, node, row)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    level, parents = leaves, []
    tops = [leaves.filter("n = 1").select("g", "node", F.lit(0).alias("depth"))]
    while most > 1:
        most = -(-most // FANOUT)
        level = staged(_pivoted(level.filter("n > 1")))
        parents.append(level)
        tops.append(level.filter("n = 1").select("g", "node", F.lit(len(parents)).alias("depth")))
    return _Tree(leaves, parents, reduce(DataFrame.unionAll, tops))


def _pivoted(level: DataFrame) -> DataFrame:
    """The parents of a level: every child in the column of its slot, then hashed together."""
    carried = ["node"] + (["row"] if "row" in level.columns else [])
    slots = [f"slot{i}" for i in range(FANOUT)]
    slot = F.pmod("place", F.lit(FANOUT))
    spread = level.groupBy("g", F.expr(f"place DIV {FANOUT}").alias("place")).agg(
        F.expr(f"MAX(n + {FANOUT - 1}) DIV {FANOUT}").alias("n"),
        # Of a slot there is one child.
        *[
            F.first(F.when(slot == i, F.struct(*carried)), ignorenulls=True).alias(name)
            for i, name in enumerate(slots)
        ],
    )

    def nodes(names: list[str]) -> Column:
        return F.concat_ws("", *[F.col(name)["node"] for name in names])

    children = [
        F.when(
            F.col(name).isNotNull(),
            F.struct(
                F.lit(i).alias("slot"),
                F.struct(nodes(slots[:i]).alias("before"), nodes(slots[i + 1 :]).alias("after")).alias("step"),
                F.col(name)["node"].alias("node"),
                *[F.col(name)[each].alias(each) for each in carried[1:]],
            ),
        )
        for i, name in enumerate(slots)
    ]
    return spread.select(
        "g", "place", "n", digest(nodes(slots)).alias("node"), F.array_compact(F.array(*children)).alias("children")
    )
