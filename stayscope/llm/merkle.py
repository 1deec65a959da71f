"""A Merkle manifest of a table: one tree per group, one tree over the groups; DataFrame functions only.

Every row is a leaf, the digest of its fields. Per group, leaves ascend by an order column; every
``fanout`` consecutive nodes (the last run may be shorter, even a single node) become the digest
of their concatenated digests, until one node remains, the group's subroot. The subroots, ordered
by group, become the root in the same way. A row's proof is the list of its run's other
digests, level by level; folding a leaf with its proof must give the root.

Method. A slot pivot makes each level: conditional aggregates spread a parent's children into
``fanout`` columns, by their position modulo the fanout. Concatenating the columns and hashing them
gives the parent; leaving out a child's own column gives its siblings. Proofs go from the root
down: a parent's row hands each of its slots the siblings and its own path. A level has
a ``fanout``-th of the rows of the one below, so all levels together cost little more than the lowest, and
leaves meet their parents' paths in a single join by (group, parent).

Texts are read once, hashed where they lie and never shuffled. Positions come from a range
partitioning by (group, order), so a group that holds a third of all rows is spread over many
tasks. The driver sees one number per range partition, the size of the largest group and the
root. Levels are written to the shared folder: a lost executor costs one level at most.

Edge cases: a null field counts as ``-``; a null group comes first, before the empty string. Null order values come
first; rows of equal order ascend by digest, so equal rows lie next to each other and each has a
proof of its own. Texts may have any length. A group of one row is its own subroot, a single
group's subroot the root; their paths have no level. An empty table gives no rows. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.operators.ordered import with_position
from stayscope.storage import materialise

FANOUT = 3
STEP = "struct<before:string,after:string>"


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated strings."""
    return F.sha2(F.concat(*values), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """A row's digest."""
    return digest(*[field(v) for v in values])


@dataclasses.dataclass(frozen=True)
class Tree:
    """Levels of all groups' trees: ``levels[k]`` has the parents that stand k + 1 steps above the leaves.

    A parent's row: ``tree, idx, n`` (nodes of its level in its tree), ``digest`` and its children's
    digests ``c0, c1, ...``, null for the slots of a short run.
    """

    base: DataFrame
    levels: list[DataFrame]
    fanout: int

    def tops(self, height: int) -> DataFrame:
        """``tree, digest`` of the trees whose top stands at this height."""
        at = self.levels[height - 1] if height else self.base
        return at.where("n = 1").select("tree", "digest")

    def roots(self) -> DataFrame:
        """``tree, digest`` of every tree."""
        found = self.tops(0)
        for height in range(1, len(self.levels) + 1):
            found = found.unionByName(self.tops(height))
        return found


def grow(base: DataFrame, largest: int, fanout: int = FANOUT) -> Tree:
    """The trees over ``base``: ``tree, idx, n, digest``, with idx from 0 to n - 1 per tree.

    ``largest`` is the largest n.
    """
    levels: list[DataFrame] = []
    below = base
    while largest > 1:
        slot = F.col("idx") % fanout
        children = [F.max(F.when(slot == k, F.col("digest"))).alias(f"c{k}") for k in range(fanout)]
        parents = (
            below.where("n > 1")
            .groupBy("tree", F.expr(f"idx div {fanout}").alias("idx"))
            .agg(F.expr(f"(max(n) + {fanout - 1}) div {fanout}").alias("n"), *children)
        )
        slots = [F.coalesce(f"c{k}", F.lit("")) for k in range(fanout)]
        below = materialise(parents.withColumn("digest", digest(*slots)), f"merkle-{len(levels) + 1}")
        levels.append(below)
        largest = -(-largest // fanout)
    return Tree(base, levels, fanout)


def _siblings(k: int, fanout: int) -> Column:
    """What stands before and after slot ``k`` in its run."""

    def side(slots) -> Column:
        return F.concat(F.lit(""), *[F.coalesce(f"c{i}", F.lit("")) for i in slots])

    return F.struct(side(range(k)).alias("before"), side(range(k + 1, fanout)).alias("after"))


def _children(parents: DataFrame, fanout: int) -> DataFrame:
    """``tree, idx, subroot, path`` of the children of parents that know their own."""
    slots = [
        F.when(
            F.col(f"c{k}").isNotNull(),
            F.struct(
                (F.col("idx") * fanout + k).alias("idx"),
                F.concat(F.array(_siblings(k, fanout)), "path").alias("path"),
            ),
        )
        for k in range(fanout)
    ]
    each = parents.select("tree", "subroot", F.explode(F.array_compact(F.array(*slots))).alias("c"))
    return each.select("tree", "c.idx", "subroot", "c.path")


def paths(tree: Tree, above: DataFrame, height: int) -> DataFrame:
    """``tree, idx, subroot, path`` of all nodes at a height; path: siblings from there to the root.

    ``above`` has ``tree, path`` with the path of each tree's top.
    """

    def tops(at: int) -> DataFrame:
        own = tree.tops(at).withColumnRenamed("digest", "subroot").join(above, "tree")
        return own.select("tree", F.lit(0).cast("long").alias("idx"), "subroot", "path")

    known = tops(len(tree.levels))
    for at in range(len(tree.levels) - 1, height - 1, -1):
        joined = known.join(tree.levels[at].drop("n", "digest"), ["tree", "idx"])
        known = _children(joined, tree.fanout).unionByName(tops(at))
    return known


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, start, lambda acc, x: digest(x["before"], acc, x["after"]))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def manifest(
    rows: DataFrame, group_col: str, order_col: str, keep: Sequence[str] = (), fanout: int = FANOUT
) -> DataFrame:
    """``order_col``, ``keep``, ``leaf, subroot, root, path`` of each row of ``rows``.

    ``rows`` holds the group, the order, ``leaf`` and the columns to keep; it is read once.
    """
    # A prefix makes the null group differ from the empty string and sort before it.
    group = F.coalesce(F.concat(F.lit("g"), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    held = rows.select(
        group.alias("group"),
        F.col(f"`{order_col}`").alias("at"),
        F.col("leaf").alias("digest"),
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
    )
    # The row number of the written table tells equal rows apart when ranges are cut.
    stored = materialise(held, "merkle-leaves").withColumn("tie", F.monotonically_increasing_id())
    placed = with_position(stored, ["group", "at", "digest", "tie"], "place")
    sizes = placed.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    groups = materialise(with_position(sizes, ["group"], "tree"), "merkle-groups")
    measures = groups.agg(F.max("n").alias("largest"), F.count("*").alias("n")).first()

    base = placed.join(groups, "group").select(
        "tree", (F.col("place") - F.col("first")).alias("idx"), "n", "digest", "at",
        *[f"k{i}" for i in range(len(keep))],
    )
    trees = grow(base, measures["largest"] or 0, fanout)
    subroots = materialise(trees.roots(), "merkle-subroots")
    over = grow(
        subroots.select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("idx"),
            F.lit(measures["n"]).cast("long").alias("n"),
            "digest",
        ),
        measures["n"],
        fanout,
    )
    top = over.roots().first()
    no_path = F.array().cast(f"array<{STEP}>")
    start = rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("tree"), no_path.alias("path"))
    above = materialise(
        paths(over, start, 0).select(F.col("idx").alias("tree"), "path"), "merkle-group-paths"
    )

    # Leaves join their parents, which are a fanout-th in number; a lone leaf has a path, no parent.
    own = [F.when(F.col("slot") == k, _siblings(k, fanout)) for k in range(fanout)]
    path = F.when(F.col("inner"), F.concat(F.array(F.coalesce(*own)), "path")).otherwise(F.col("path"))
    if trees.levels:
        parents = paths(trees, above, 1).join(trees.levels[0].drop("n", "digest"), ["tree", "idx"])
        parents = parents.withColumn("inner", F.lit(True))
    else:
        parents = trees.base.limit(0).select("tree", "idx", F.lit(None).cast("string").alias("subroot"))
        parents = parents.withColumns(
            {"path": no_path, "inner": F.lit(True)} | {f"c{k}": F.lit(None).cast("string") for k in range(fanout)}
        )
    lone = trees.tops(0).withColumnRenamed("digest", "subroot").join(above, "tree")
    lone = lone.withColumns({"idx": F.lit(0).cast("long"), "inner": F.lit(False)})
    parents = parents.unionByName(lone, allowMissingColumns=True)
    leaves = base.select(
        "tree", F.expr(f"idx div {fanout}").alias("idx"), (F.col("idx") % fanout).alias("slot"), "digest", "at",
        *[f"k{i}" for i in range(len(keep))],
    )
    return leaves.join(parents, ["tree", "idx"]).select(
        F.col("at").alias(order_col),
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(top["digest"] if top else None).cast("string").alias("root"),
        path.alias("path"),
    )


def verify(proven: DataFrame, claimed: Column) -> DataFrame:
    """``proven`` plus ``folded_root``, recomputed from the claimed leaves, and ``verified``."""
    found = proven.withColumn("folded_root", fold(claimed, F.col("path")))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
