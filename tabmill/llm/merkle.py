"""Merkle manifest of a table, with few stored levels.

Every row is a leaf, the digest of its fields. The leaves of a tree are ordered by a column, and every eight consecutive
nodes become the digest of their digests until one, the subroot, is left; subroots, ordered by the name of their tree, are
joined to the root likewise. Only every third level is stored. What lies between is computed again from the stored nodes of
an aligned subtree (512 of them at most), serves the siblings of these nodes, and is thrown away; so building and proving
cost one shuffle per stored level, and no task holds more than one subtree at a time.

Positions come from a range partitioning, running numbers within partitions and the counts of partitions, so that a tree
with most of the rows is no task of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.skew import lookup_join
from ..sources.workspace import materialize, new_path

BITS = 3
FANOUT = 1 << BITS
EVERY = 3  # levels from one stored level to the next
NODES = "tree string, pos bigint, n bigint, node string"


def digest(*columns: Column) -> Column:
    """SHA-256 (lowercase hex) of `columns`: `-` for a null, else the count of UTF-8 bytes, a colon and the value as text."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def tree_name(column: Column) -> Column:
    """A text that orders as the column does by its UTF-8 bytes, null first."""
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), column.cast("string")))


@dataclass(frozen=True)
class Manifest:
    """The stored levels below `path`: of all trees (`trees/level=0`, 3, 6, ..), and of the tree over subroots (`top/..`).

    Each holds (tree, pos, n, node): the place of a node and the number of nodes of its tree on that level. Level 0 also
    holds the columns that were to be kept of each row.
    """

    spark: SparkSession
    path: str
    levels: tuple[int, ...]
    top_levels: tuple[int, ...]
    kept: str  # the columns kept with leaves, as a DDL text
    every: int

    def level(self, part: str, level: int) -> DataFrame:
        schema = NODES + (f", {self.kept}" if self.kept and part == "trees" and level == 0 else "")
        if part == "top" and level == 0:
            schema += ", of string"
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}/level={level}")

    def root(self) -> DataFrame:
        """(root): one row, none for an empty table."""
        return self.level("top", self.top_levels[-1]).select(F.col("node").alias("root"))

    def subroots(self) -> DataFrame:
        """(tree, subroot)."""
        return self.level("trees", self.levels[-1]).select("tree", F.col("node").alias("subroot"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with `pos` (from 0 in each `tree`, by `order`) and `n` (rows of the tree). Equal rows are numbered any way."""
    tied = materialize(rows.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
    by = ["tree", *order, "_tie"]
    placed = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed, "ordered-leaves").withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of = Window.partitionBy("tree")
    before = F.sum("_n").over(of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "_part", (F.col("_first") - F.coalesce(before, F.lit(0))).alias("_first"), F.sum("_n").over(of).alias("n"))
    return lookup_join(placed, runs, ["tree", "_part"], "inner").withColumn("pos", F.col("_at") - F.col("_first")).drop("_at", "_first", "_part")


def _subtrees(nodes: DataFrame, every: int, *extra: str) -> DataFrame:
    """One row per aligned subtree (tree, block): the nodes a0 of the stored level and those of the levels above (a1, ..)."""
    block = F.floor(F.col("pos") / FANOUT**every).alias("block")
    members = F.array_sort(F.collect_list(F.struct("pos", "node", *extra)))
    out = nodes.groupBy("tree", block).agg(F.first("n").alias("n"), members.alias("members"))
    out = out.withColumn("a0", F.transform("members", lambda m: m["node"]))
    for j in range(every):
        a, left = F.col(f"a{j}"), _left(j)
        runs = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / FANOUT).cast("int"))
        joined = F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(a, i * FANOUT + 1, FANOUT), ""), 256))  # noqa: B023
        out = out.withColumn(f"a{j + 1}", F.when(left > 1, joined).otherwise(a))
    return out


def _left(j: int) -> Column:
    """Nodes of the tree j levels above."""
    return F.ceil(F.col("n") / FANOUT**j).cast("bigint")


def _stored(leaves: DataFrame, path: str, every: int) -> list[int]:
    """Write the leaves and every `every`-th level above them until each tree has one node; the levels written."""
    spark, schema = leaves.sparkSession, leaves.schema
    leaves.write.parquet(f"{path}/level=0")
    nodes, levels = spark.read.schema(schema).parquet(f"{path}/level=0"), [0]
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        nodes = _subtrees(nodes, every).select("tree", F.col("block").alias("pos"), _left(every).alias("n"), F.col(f"a{every}")[0].alias("node"))
        at = f"{path}/level={levels[-1] + every}"
        nodes.write.parquet(at)
        nodes = spark.read.schema(NODES).parquet(at)
        levels.append(levels[-1] + every)
    return levels


def build(rows: DataFrame, tree: Column, order: str, leaf: Column, path: str | None = None, every: int = EVERY, **keep: Column) -> Manifest:
    """The manifest of `rows`: a leaf `leaf` per row, in the tree `tree` (any name, null too) by the column `order`, nulls first.

    `keep` names further columns that are stored with leaves. Rows of one tree and order follow their leaves; equal rows
    are leaves of their own. An empty table gives empty levels. The levels are written below `path`, which must be new.
    """
    path = path or new_path(rows.sparkSession, "merkle")
    columns = {"by": F.col(order), "node": leaf} | keep
    leaves = rows.select(tree_name(tree).alias("tree"), *[c.alias(k) for k, c in columns.items()])
    kept = list(keep)
    leaves = numbered(leaves, ["by", "node"]).select("tree", "pos", "n", "node", *kept)
    levels = _stored(leaves, f"{path}/trees", every)
    sub = rows.sparkSession.read.schema(NODES).parquet(f"{path}/trees/level={levels[-1]}")
    tops = numbered(sub.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node"), ["of"]).select("tree", "pos", "n", "node", "of")
    top_levels = _stored(tops, f"{path}/top", every)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema.fields if f.name in kept)
    return Manifest(rows.sparkSession, path, tuple(levels), tuple(top_levels), ddl, every)


def _steps(every: int, *extra: str) -> Column:
    """For each member of a subtree, the digests left and right of it and of its ancestors within the subtree."""

    def of(member: Column, i: Column) -> Column:
        steps = []
        for j in range(every):
            a, at = F.col(f"a{j}"), F.shiftright(i, BITS * j)
            inside = at % FANOUT
            left = F.array_join(F.slice(a, at - inside + 1, inside), "")
            right = F.array_join(F.slice(a, at + 2, FANOUT - 1 - inside), "")
            steps.append(F.when(_left(j) > 1, F.struct(left.alias("l"), right.alias("r"))))
        path = F.filter(F.array(*steps), lambda s: s.isNotNull())
        return F.struct(member["pos"].alias("pos"), *[member[x].alias(x) for x in ("node", *extra)], path.alias("steps"))

    return F.transform("members", of)


def _descend(manifest: Manifest, part: str, levels: tuple[int, ...], above: DataFrame, kept: list[str], passed: list[str]) -> DataFrame:
    """From the paths `above` (tree, pos, path, ..) of the last level's nodes to the leaves with theirs."""
    for at in reversed(levels[:-1]):
        extra = kept if at == 0 else []
        subtrees = _subtrees(manifest.level(part, at), manifest.every, *extra)
        subtrees = subtrees.join(above.withColumnRenamed("pos", "block"), ["tree", "block"])
        nodes = subtrees.select("tree", *passed, "path", F.inline(_steps(manifest.every, *extra)))
        above = nodes.select("tree", "pos", *(["node", *extra] if at == 0 else []), *passed, F.concat("steps", "path").alias("path"))
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof: (tree, pos, node, the kept columns, subroot, root, path).

    `path` holds, from the leaf to the root, the digests left (`l`) and right (`r`) of the node in its run, concatenated.
    """
    last = manifest.top_levels[-1]
    top = manifest.level("top", last)
    nothing = F.array().cast("array<struct<l:string,r:string>>")
    if last == 0:  # at most one tree
        tops = top.select("of", F.col("node").alias("subroot"), F.col("node").alias("root"), nothing.alias("path"))
    else:
        root = top.select("tree", "pos", nothing.alias("path"), F.col("node").alias("root"))
        tops = _descend(manifest, "top", manifest.top_levels, root, ["of"], ["root"]).select("of", F.col("node").alias("subroot"), "root", "path")
    kept = [f.split("`")[1] for f in manifest.kept.split(", ")] if manifest.kept else []
    if len(manifest.levels) == 1:
        leaves = manifest.level("trees", 0).join(tops.withColumnRenamed("of", "tree"), "tree")
        return leaves.select("tree", "pos", "node", *kept, "subroot", "root", "path")
    above = tops.select(F.col("of").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "subroot", "root", "path")
    return _descend(manifest, "trees", manifest.levels, above, kept, ["subroot", "root"])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, from the leaf's siblings on, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), "")
