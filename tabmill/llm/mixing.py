"""Mixing sources to target weights by hierarchical budgets, in DataFrame functions alone.

Documents are the leaves' rows of a tree, for instance domain, language, source. A budget of tokens goes down the tree by
weight. A child that cannot use its share, because all epochs of all its leaves hold fewer tokens, is filled, and what it
leaves goes to its siblings by weight; only what a whole subtree cannot use goes back to the subtree's own siblings. Shares
are whole numbers: each level is cut by water-filling over running sums, and what rounding leaves is given by rank.

A leaf's budget is taken as whole epochs and then a prefix of the next one, each epoch in its own seeded order. Leaves may
hold any share of the rows: a prefix is found from token sums per order bucket, whose number follows the leaf's size, and
only the one bucket that the budget cuts is put in order row by row.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialize

BUCKET_ROWS = 2000  # rows per order bucket, about
HASH_DIGITS = 8  # hex digits of a hash that decide the bucket


def tokens(text: Column) -> Column:
    """Number of words; 0 for nulls."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _weight(level: int, node: list[str], weights: dict | None) -> Column:
    """The weight of a node by its path; 1 where none is given."""
    out = F.lit(1)
    for path, w in sorted((weights or {}).items()):
        if len(path) == level + 1:
            same = F.lit(True)
            for c, v in zip(node, path):
                same &= F.col(c).eqNullSafe(F.lit(v))
            out = F.when(same, F.lit(int(w))).otherwise(out)
    return out.cast("decimal(38,0)")


def _met(path: tuple, leaf: Column, names: list[str]) -> Column:
    """Whether a leaf lies at or below a path."""
    same = F.lit(0 < len(path) <= len(names))
    for c, v in zip(names, path):
        same &= leaf[c].eqNullSafe(F.lit(v))
    return same


def _filled(nodes: DataFrame, parent: list[str], node: list[str]) -> DataFrame:
    """`nodes` (node columns, cap, w, and the parent's budget) with `given`, by water-filling.

    Children are ordered by the share at which they are full. Those before the first that a proportional share does not
    fill get all they can use; the others divide the rest by weight. Single tokens that rounding leaves go by that order.
    """
    live = F.col("w") > 0
    along = Window.partitionBy(*parent).orderBy((F.col("cap") / F.expr("nullif(w, 0)")).asc_nulls_last(), *node)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(*parent)
    # decimals: products of token counts and weights do not fit 64 bits
    left = F.col("budget") - F.coalesce(F.sum(F.when(live, F.col("cap")).otherwise(0)).over(before), F.lit(0))
    weight = F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0))
    n = nodes.withColumns({"_left": left.cast("decimal(38,0)"), "_weight": weight.cast("decimal(38,0)")})
    n = n.withColumn("_full", (F.col("w") > 0) & (F.col("_left") > 0) & (F.col("cap") * F.col("_weight") <= F.col("_left") * F.col("w")))
    # full ones come first; the first that is not full carries the rest and the weights that divide it
    n = n.withColumn("_open", ~F.col("_full") & (F.col("w") > 0))
    rest = F.max(F.when(F.col("_open"), F.struct(F.col("_weight").alias("weight"), F.col("_left").alias("left")))).over(all_)
    n = n.withColumn("_rest", rest)
    share = F.expr("cast(greatest(_rest.left, 0) * w div _rest.weight as bigint)")
    n = n.withColumn("given", F.when(F.col("_full"), F.col("cap")).when(F.col("_open"), F.least(share, F.col("cap"))).otherwise(0).cast("bigint"))
    spare = (F.col("budget") - F.sum("given").over(all_)).cast("bigint")
    room = F.col("_open") & (F.col("given") < F.col("cap"))
    rank = F.sum(F.when(room, 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    n = n.withColumns({"_spare": spare, "_rank": rank, "_room": room})
    extra = F.when(F.col("_room") & (F.col("_rank") <= F.col("_spare")), 1).otherwise(0)
    return n.withColumn("given", F.col("given") + extra).select(*node, F.col("given").cast("bigint").alias("given"))


def budgets(leaves: DataFrame, levels: list[str], budget: int, epochs: int, weights: dict | None = None) -> DataFrame:
    """(levels, tokens, rows, budget) per leaf from `leaves` (levels, tokens, rows).

    `weights` maps paths (value of the first level, of the first two, ...) to whole numbers; other nodes weigh 1, and a
    weight of 0 keeps a node out. Null values are values of their own.
    """
    given = None
    for i in range(len(levels)):
        node, parent = levels[: i + 1], levels[:i]
        caps = leaves.groupBy(*node).agg((F.sum("tokens") * epochs).cast("bigint").alias("cap")).withColumn("w", _weight(i, node, weights))
        if given is None:
            caps = caps.withColumn("budget", F.lit(budget).cast("bigint"))
        else:
            up = given.select(*[F.col(c).alias(f"_up_{c}") for c in parent], F.col("given").alias("budget"))
            same = F.lit(True)
            for c in parent:
                same &= F.col(c).eqNullSafe(F.col(f"_up_{c}"))
            caps = caps.join(up, same).select(*node, "cap", "w", "budget")
        given = _filled(caps, parent, node)
    up = given.select(*[F.col(c).alias(f"_up_{c}") for c in levels], F.col("given").alias("budget"))
    same = F.lit(True)
    for c in levels:
        same &= F.col(c).eqNullSafe(F.col(f"_up_{c}"))
    return leaves.join(up, same).select(*leaves.columns, "budget")


def select(docs: DataFrame, levels: dict[str, Column], budget: int | float, epochs: int = 1, weights: dict | None = None, seed: int = 1) -> DataFrame:
    """`docs` (with doc_id and text) with `mix_tokens` and `mix_epoch` (from 0): the rows that the budgets take.

    `levels` names the levels from the top and says how they come from a row. `budget` is a number of tokens, or a share
    (a float) of those there are. A document is taken whole, so a leaf stays below its budget by less than its next
    document. Ties in the order are broken by doc_id; rows equal in both are taken together. Documents without a word cost
    nothing and come with the leaf's prefix. Null ids order as empty texts. An empty table gives an empty result.
    Paths of `weights` that no leaf of the table meets have no effect and are named in a warning.
    """
    names = [f"_level_{n}" for n in levels]
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.withColumns(dict(zip(names, levels.values())) | {"_tokens": tokens(F.col("text")), "_key": key})
    slim = materialize(rows.select("_key", "_tokens", F.struct(*names).alias("leaf")), "leaf-rows")
    leaves = slim.groupBy("leaf").agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).select("leaf.*", "tokens", "rows")
    paths = list(weights or {})
    total, *met = slim.agg(F.sum("_tokens"), *[F.max(_met(p, F.col("leaf"), names)) for p in paths]).first()
    unmet = [p for p, m in zip(paths, met) if m is False]
    if unmet:
        warnings.warn(f"weights of paths that no row has: {unmet}", stacklevel=2)
    total = total or 0
    goal = int(budget * total) if isinstance(budget, float) else budget
    given = budgets(leaves, names, goal, epochs, weights)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div nullif(tokens, 0)")).otherwise(F.lit(epochs)).cast("int")
    given = given.withColumns({"leaf": F.struct(*names), "whole": whole, "buckets": F.ceil(F.col("rows") / BUCKET_ROWS).cast("bigint")})
    given = _bounded(materialize(given.select("leaf", "whole", "buckets", F.expr("budget - whole * tokens").alias("rest")), "budgets"))

    # the broken epoch of a leaf: the order of its rows, and the bucket of each row in it
    last = given.where(F.col("whole") < epochs).withColumnRenamed("leaf", "of").withColumnRenamed("whole", "epoch")
    order = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"), F.col("_key")))
    place = F.conv(F.substring("order", 1, HASH_DIGITS), 16, 10).cast("bigint")
    part = slim.join(last, F.col("leaf").eqNullSafe(F.col("of"))).withColumn("order", order)
    part = part.withColumn("bucket", F.floor(place * F.col("buckets") / 16**HASH_DIGITS))
    part = part.select("_key", "_tokens", "leaf", "epoch", "rest", "order", "bucket")
    sums = part.groupBy("leaf", "bucket").agg(F.sum("_tokens").alias("size"))
    earlier = Window.partitionBy("leaf").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    sums = sums.withColumnRenamed("leaf", "of").withColumnRenamed("bucket", "at")
    part = part.join(sums, (F.col("bucket") == F.col("at")) & F.col("leaf").eqNullSafe(F.col("of")))
    inside = F.col("before") + F.col("size") <= F.col("rest")
    running = F.sum("_tokens").over(Window.partitionBy("leaf", "bucket").orderBy("order", "_key"))
    cut = part.where(~inside & (F.col("before") <= F.col("rest"))).withColumn("upto", F.col("before") + running).where("upto <= rest")
    prefix = part.where(inside).select("_key", "leaf", "epoch").union(cut.select("_key", "leaf", "epoch")).distinct()

    every = rows.withColumn("_leaf", F.struct(*names))
    out = [*[F.col(f"`{c}`") for c in docs.columns], F.col("_tokens").alias("mix_tokens"), F.col("_epoch").cast("int").alias("mix_epoch")]
    full = given.where("whole > 0").select(F.col("leaf").alias("_of"), F.explode(F.sequence(F.lit(0), F.least("whole", F.lit(epochs)) - 1)).alias("_epoch"))
    chosen = prefix.select(F.col("_key").alias("_of_key"), F.col("leaf").alias("_of"), F.col("epoch").alias("_epoch"))
    in_full = every.join(_bounded(full), F.col("_leaf").eqNullSafe(F.col("_of"))).select(*out)
    return in_full.union(every.join(chosen, (F.col("_key") == F.col("_of_key")) & F.col("_leaf").eqNullSafe(F.col("_of"))).select(*out))


def _bounded(leaves: DataFrame, rows: int = 10_000) -> DataFrame:
    """A table of leaves, marked to be broadcast if it is counted to be small."""
    return F.broadcast(leaves) if leaves.limit(rows + 1).count() <= rows else leaves
