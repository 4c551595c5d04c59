"""Merkle manifest of a table, by checkpoint and recompute.

A node's digest is the sha256 of the hex digests of ``FANOUT`` consecutive nodes below.
Leaves are ordered inside groups; each group has a tree, and the groups' roots, in group
order, have one more.  Only every ``STEP``-th level is written, so a stored node stands
over an aligned subtree of ``FANOUT ** STEP`` stored nodes.  To extract proofs, each
subtree makes its missing interior nodes again from the stored ones, emits the siblings
of every member and forgets them.  Proofs are made from the top down: the siblings above
a subtree are those of the stored node over it.

No step holds more than one subtree.  Positions inside a group come from a range
partitioning by (group, order), so a group of any size is cut into many partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwright.llm.tables import written

FANOUT = 8
STEP = 3
SUBTREE = FANOUT**STEP
PROOF = "array<struct<left:string,right:string>>"


def digest(*fields: str | Column) -> Column:
    """Hex sha256 over the fields: ``-`` for null, else the number of UTF-8 bytes, a colon, the value as text."""
    parts = []
    for field in fields:
        value = (F.col(f"`{field}`") if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _above(nodes: list[str]) -> list[str]:
    return [hashlib.sha256("".join(nodes[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(nodes), FANOUT)]


def interior(nodes: list[str], total: int) -> list[list[str]]:
    """The levels of one aligned subtree from its stored nodes up, at most ``STEP`` above them.

    ``total`` is the number of the group's nodes on the stored level: a group stops where
    one node is left.
    """
    levels = [nodes]
    for _ in range(STEP):
        if total == 1:
            break
        levels.append(_above(levels[-1]))
        total = -(-total // FANOUT)
    return levels


@dataclass
class Tree:
    """Stored levels from the leaves up: (grp, pos, n, digest, and ``own`` for leaves); n nodes are left in the group."""

    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """(grp, root), one for each group."""
        tops = [t.where("n = 1").select("grp", F.col("digest").alias("root")) for t in self.levels]
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        return out


def positions(rows: DataFrame) -> DataFrame:
    """(grp, by, digest, own) with pos, the place by (by, digest) inside grp, and n, the rows of grp."""
    dealt = rows.repartitionByRange("grp", F.col("by").asc_nulls_first(), "digest")
    # the number holds the partition and the place in it, as written
    listed = written(dealt.sortWithinPartitions("grp", F.col("by").asc_nulls_first(), "digest").withColumn("at", F.monotonically_increasing_id()))
    listed = listed.withColumn("part", F.shiftright("at", 33))
    runs = listed.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))  # a row for each partition a group meets
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("grp", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    return listed.join(runs, ["grp", "part"]).select("grp", (F.col("at") + F.col("shift")).alias("pos"), "n", "digest", "own")


def _subtrees(nodes: DataFrame, *own: str) -> DataFrame:
    """One row for each aligned subtree of a stored level."""
    held = F.array_sort(F.collect_list(F.struct("pos", "digest", *own)))
    return nodes.where("n > 1").groupBy("grp", F.floor(F.col("pos") / SUBTREE).alias("sub")).agg(F.first("n").alias("n"), held.alias("nodes"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, tops, left = batch.column("n").to_pylist(), [], []
        for nodes, total in zip(batch.column("digests").to_pylist(), totals):
            levels = interior(nodes, total)
            tops.append(levels[-1][0])
            for _ in levels[1:]:
                total = -(-total // FANOUT)
            left.append(total)
        yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("pos"), pa.array(left, pa.int64()), pa.array(tops, pa.string())], ["grp", "pos", "n", "digest"])


def grow(leaves: DataFrame) -> Tree:
    """The tree of every group over (grp, by, digest, own); each stored level is a written table, a few jobs for any size."""
    levels = [written(positions(leaves))]
    while levels[-1].where("n > 1").limit(1).count():
        below = _subtrees(levels[-1].select("grp", "pos", "n", "digest"))
        folded = below.select("grp", F.col("sub").alias("pos"), "n", F.col("nodes.digest").alias("digests")).mapInArrow(_fold, "grp string, pos long, n long, digest string")
        levels.append(written(folded))
    return Tree(levels)


def _siblings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each member of each subtree: the siblings on every level inside, then those above the subtree."""
    for batch in (b.slice(i, 4) for b in batches for i in range(0, b.num_rows, 4)):  # a member's proof takes a few kB
        nodes, above = batch.column("nodes"), batch.column("above").to_pylist()
        flat = nodes.flatten()
        digests, counts = flat.field("digest").to_pylist(), nodes.value_lengths().to_pylist()
        lefts, rights, ends, start, rows = [], [], [0], 0, []
        for row, (count, total, upper) in enumerate(zip(counts, batch.column("n").to_pylist(), above)):
            levels = interior(digests[start : start + count], total)[:-1]
            up, to = [s["left"] for s in upper], [s["right"] for s in upper]
            for i in range(count):
                for level in levels:
                    run = i - i % FANOUT
                    lefts.append("".join(level[run:i]))
                    rights.append("".join(level[i + 1 : run + FANOUT]))
                    i //= FANOUT
                lefts += up
                rights += to
                ends.append(len(lefts))
            rows += [row] * count
            start += count
        sides = pa.StructArray.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string())], ["left", "right"])
        of = pa.array(rows, pa.int64())
        out = {n: batch.column(n).take(of) for n in ("grp", "root", "top")}
        out |= {"pos": flat.field("pos"), "digest": flat.field("digest"), "proof": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), sides)}
        out |= {"own": flat.field("own")} if flat.type.get_field_index("own") >= 0 else {}
        yield pa.RecordBatch.from_pydict(out)


def proofs_in(tree: Tree, roots: DataFrame) -> DataFrame:
    """(grp, root, top, pos, digest, proof, own) of every leaf; ``roots`` holds (grp, root, top, proof) for the groups' roots."""
    found, last = None, len(tree.levels) - 1
    for c in range(last, -1, -1):
        level = tree.levels[c]
        own = ["own"] if c == 0 else []
        single = level.where("n = 1").join(roots, "grp").select("grp", "root", "top", "pos", "digest", "proof", *own)
        if found is not None:
            over = found.select("grp", F.col("pos").alias("sub"), "root", "top", F.col("proof").alias("above"))
            inside = _subtrees(level, *own).join(over, ["grp", "sub"]).mapInArrow(_siblings, single.schema)
            single = inside.unionByName(single)
        found = single if c == 0 else written(single)
    return found


def manifest(rows: DataFrame, leaf: Column, group: str, order: str) -> DataFrame:
    """The rows' columns as struct ``own``, with leaf, subroot, root and proof (a left and a right side for each level).

    Inside a group rows ascend by ``order`` (null first), those of one value by their
    digest; equal rows get places of their own.  Groups ascend bytewise, null first.  A lone
    leaf is its group's root, a lone group's root the root of all.  An empty table gives no
    rows.  ``order`` is a whole number, ``group`` a string; other columns may have any name.
    """
    grp = F.when(F.col(f"`{group}`").isNull(), "").otherwise(F.concat(F.lit("="), F.col(f"`{group}`")))  # keeps the order, null first
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    tree = grow(rows.select(grp.alias("grp"), F.col(f"`{order}`").cast("long").alias("by"), leaf.alias("digest"), own.alias("own")))
    # the same once more: one group, whose leaves are the groups' roots in the order of their names
    upper = grow(tree.roots().select(F.lit("all").alias("grp"), F.col("grp").alias("by"), F.col("root").alias("digest"), F.col("grp").alias("own")))
    top = upper.roots().select("grp", F.col("root").alias("top"), F.col("root"), F.array().cast(PROOF).alias("proof"))
    of_groups = proofs_in(upper, top).select(F.col("own").alias("grp"), F.col("digest").alias("root"), "top", "proof")
    whole = proofs_in(tree, written(of_groups))
    return whole.select("own", F.col("digest").alias("leaf"), F.col("root").alias("subroot"), F.col("top").alias("root"), "proof")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """Hex sha256 over all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
