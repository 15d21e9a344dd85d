"""Merkle manifest of a table: one tree per group, one tree over the groups' roots.

Leaves of a group get their places from a range partitioning: rows are sorted
once by group and key, and a place is the row's number in its partition plus
the rows of the group in the partitions before.  Each task then streams
aligned blocks of ``ARITY ** HEIGHT`` leaves into an append-only tree
(``Appender``): a new node attaches a partial witness to the leaves below it,
and each later sibling that completes a run extends the witnesses of all
nodes of the run.  Block roots are appended to the tree above in the same way,
until every tree has one root; roots of groups are appended to the last tree.
A block holds a bounded number of leaves, so a group of any size is spread
over all tasks.

A witness is text: one step per level, joined by ``|``; a step is the digests
of its run from left to right, ``*`` in the place of the node itself.  Folding
replaces ``*`` by the digest so far and hashes (``folded``, native).

Defined results: null columns are marked ``-`` and differ from empty ones; a
null group is a group (the first); null keys come first in their group; rows
with equal keys follow by leaf, repeated rows are leaves of their own; an
empty table gives an empty table; only the columns named in ``keep`` are
carried, and those with the names of result columns give way.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duoweave.llm import work

ARITY, HEIGHT = 3, 6
#: Rows of one partition in ``monotonically_increasing_id``.
PART_BITS = 33
RESULT = ("leaf", "witness", "subroot", "root")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(col: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = col.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*cols: Column) -> Column:
    return F.sha2(F.encode(F.concat(*[field(c) for c in cols]), "UTF-8"), 256)


def steps(witness: Column) -> Column:
    return F.filter(F.split(witness, r"\|"), lambda s: s != "")


def folded(leaf: Column, witness: Column) -> Column:
    """Root that follows from a leaf and its witness."""
    return F.aggregate(steps(witness), leaf, lambda now, s: F.sha2(F.encode(F.replace(s, F.lit("*"), now), "UTF-8"), 256))


def siblings(witness: Column) -> Column:
    """Digests of the witness alone, level by level, from left to right."""
    return F.translate(witness, "*|", "")


class Appender:
    """An append-only tree.

    Per level there is one open run of fewer than ``arity`` nodes; a node is
    its digest and the witnesses of the leaves below it.
    """

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.open: list[list[tuple[str, list[list[str]]]]] = []
        self.count: list[int] = []
        self.witnesses: list[list[str]] = []

    def append(self, leaf: str) -> None:
        self.witnesses.append([])
        self._push(0, leaf, [self.witnesses[-1]])

    def _push(self, level: int, node: str, below: list[list[str]]) -> None:
        while True:
            if level == len(self.open):
                self.open.append([])
                self.count.append(0)
            self.open[level].append((node, below))
            self.count[level] += 1
            if len(self.open[level]) < self.arity:
                return
            node, below = self._complete(level)
            level += 1

    def _complete(self, level: int) -> tuple[str, list[list[str]]]:
        """Close the run: every node's siblings extend the witnesses below it."""
        run, self.open[level] = self.open[level], []
        nodes = [n for n, _ in run]
        below = []
        for i, (_, witnesses) in enumerate(run):
            step = "".join(nodes[:i]) + "*" + "".join(nodes[i + 1:])
            for w in witnesses:
                w.append(step)
            below += witnesses
        return digest("".join(nodes)), below

    def close(self, height: int | None = None) -> str:
        """Complete the open runs up to ``height`` (None: until one node is left); the node there."""
        level = 0
        while self.count[level] > 1 if height is None else level < height:
            if self.open[level]:
                self._push(level + 1, *self._complete(level))
            level += 1
        return self.open[level][0][0]


def placed(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``nodes`` with tree (a number in the order of groups), idx (place in the group) and n (rows of the group).

    ``order`` must be unique within a group.
    """
    at = F.monotonically_increasing_id()
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    rows = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", at)
    rows, _ = work.save(rows.withColumn("__part", F.shiftright("__at", PART_BITS)), "merkle-order")
    cuts = rows.groupBy("__part", group).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    cuts = cuts.select(F.col("__part").alias("__p"), F.col(group).alias("__g"), "__first",
                       F.min("__first").over(of_group).alias("tree"), F.sum("__n").over(of_group).alias("n"),
                       F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return rows.join(cuts, (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g"))).select(
        *nodes.columns, "tree", (F.col("__at") - F.col("__first") + F.col("__before")).alias("idx"), "n")


def grown(nodes: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Blocks of leaves (tree, idx, n, node, others) appended by one task each.

    Returns the rows with block and witness (up to the block's root), and the
    block roots as nodes (tree, idx, n, node) of the tree above.
    """
    size = arity ** height
    blocks = nodes.withColumn("block", F.floor(F.col("idx") / size).cast("long"))

    def run(batches):
        def out(table: pa.Table):
            tree, block, n = (table.column(c).to_numpy() for c in ("tree", "block", "n"))
            starts = np.flatnonzero(np.diff(tree, prepend=-1) | np.diff(block, prepend=-1)).tolist()
            node = table.column("node").to_pylist()
            witness, root = [], [None] * len(node)
            for lo, hi in zip(starts, [*starts[1:], len(node)]):
                held = Appender(arity)
                for x in node[lo:hi]:
                    held.append(x)
                root[lo] = held.close(height if n[lo] > size else None)
                witness += ["|".join(w) for w in held.witnesses]
            table = table.append_column("witness", pa.array(witness, pa.string()))
            return table.append_column("block_root", pa.array(root, pa.string())).to_batches()

        held = None
        for b in batches:
            table = pa.Table.from_batches([b])
            table = (pa.concat_tables([held, table]) if held is not None else table).combine_chunks()
            tree, block = table.column("tree").to_numpy(), table.column("block").to_numpy()
            inside = (tree == tree[-1]) & (block == block[-1]) if len(tree) else np.zeros(0, bool)
            cut = len(tree) - int(inside.sum())
            held = table.slice(cut)
            if cut:
                yield from out(table.slice(0, cut))
        if held is not None and held.num_rows:
            yield from out(held)

    schema = blocks.schema.add("witness", "string").add("block_root", "string")
    rows, _ = work.save(blocks.repartition("tree", "block").sortWithinPartitions("tree", "idx").mapInArrow(run, schema),
                        "merkle-blocks")
    roots = rows.filter("block_root IS NOT NULL").select(
        "tree", F.col("block").alias("idx"), F.ceil(F.col("n") / size).cast("long").alias("n"),
        F.col("block_root").alias("node"))
    return rows, roots


def joined(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.when(p != "", p) for p in parts])


def tops(roots: DataFrame, **options) -> DataFrame:
    """(tree, block, rest, top): of each block root the witness up to its tree's root, and that root."""
    if roots.filter("n > 1").isEmpty():
        return roots.select("tree", F.col("idx").alias("block"), F.lit("").alias("rest"), F.col("node").alias("top"))
    rows, above = grown(roots, **options)
    return rows.join(tops(above, **options), ["tree", "block"]).select(
        "tree", F.col("idx").alias("block"), joined(F.col("witness"), F.col("rest")).alias("rest"), "top")


def manifest(df: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             key: str = "doc_id", group: str = "source", keep: tuple[str, ...] = ("doc_id",),
             arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``df``: the columns of ``keep``, leaf, witness (up to the root), subroot and root.

    Leaves hash ``columns``; each group of equal ``group`` is a tree over its
    leaves by ascending ``key``; the groups' roots, by group, are the leaves of
    the last tree.
    """
    options = {"arity": arity, "height": height}
    leaves, _ = work.save(df.select(
        F.col(f"`{group}`").alias("group"), F.col(f"`{key}`").alias("key"), F.monotonically_increasing_id().alias("id"),
        leaf(*[F.col(f"`{c}`") for c in columns]).alias("node"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.lit(0).alias("none")).alias("row")),
        "merkle-leaves")
    nodes = placed(leaves, "group", ["key", "node", "id"]).select("tree", "idx", "n", "node", "row")
    rows, roots = grown(nodes, **options)
    up, _ = work.save(tops(roots, **options), "merkle-subroots")
    # One more tree whose leaves are the roots of the others.
    last = up.filter("block = 0").select(F.lit(0).alias("group"), F.col("tree").alias("of"), F.col("top").alias("node"))
    last, last_roots = grown(placed(last, "group", ["of"]).select("tree", "idx", "n", "node", "of"), **options)
    last = last.join(tops(last_roots, **options), ["tree", "block"]).select(
        F.col("of").alias("tree"), joined(F.col("witness"), F.col("rest")).alias("last"), F.col("top").alias("root"))
    # Joined block by block, so that a large group is many keys.
    up, _ = work.save(up.join(last, "tree").select(
        "tree", "block", joined(F.col("rest"), F.col("last")).alias("rest"), F.col("top").alias("subroot"), "root"),
        "merkle-tops")
    carried = [F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(keep) if c not in RESULT]
    return rows.join(up, ["tree", "block"]).select(
        *carried, F.col("node").alias("leaf"), joined(F.col("witness"), F.col("rest")).alias("witness"), "subroot", "root")
