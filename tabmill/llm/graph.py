"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import broadcast_up_to
from ..sources.workspace import materialize


def _roots(edges: DataFrame) -> tuple[DataFrame, int]:
    """(id, top) for every id in `edges`, and their number: each hangs on its smallest neighbour, if that is smaller, and `top` is the end of the way down."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    tops = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("top"))
    tops = materialize(tops, "tops")
    n = tops.count()
    moved = True
    while moved:  # three steps at once, until the third leads nowhere
        sized = broadcast_up_to(tops, n)
        second, third = (sized.select(F.col("id").alias(x), F.col("top").alias(y)) for x, y in (("top", "second"), ("second", "third")))
        steps = tops.join(second, "top").join(third, "second").select("id", F.col("third").alias("top"), (F.col("second") > F.col("third")).alias("moved"))
        steps = materialize(steps, "tops")
        moved = steps.where("moved").count() > 0
        tops = steps.select("id", "top")
    return tops, n


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in `links` (a, b).

    Every node hangs on its smallest neighbour; the trees that this makes become the nodes of a smaller graph, and so on
    until no link is left. A tree with nothing hung on it hangs on another in the next round, so the rounds grow with the
    logarithm of the nodes, and the steps down in a round with that of its depth. Each is written to the shared folder.
    Hubs are never gathered: only their minimum is aggregated, and joins on them can be split. No links give an empty table.
    Every level is counted, and only small ones can be broadcast, that which is returned too.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges, "edges")
    levels, left = [_roots(edges)], edges.count()
    while True:
        tops, n = levels[-1]
        tops = broadcast_up_to(tops, max(n, left))
        for x in "ab":
            edges = edges.join(tops.select(F.col("id").alias(x), F.col("top").alias(f"top_{x}")), x)
        edges = edges.where("top_a <> top_b").select(F.greatest("top_a", "top_b").alias("a"), F.least("top_a", "top_b").alias("b"))
        edges = materialize(edges.distinct(), "edges")
        left = edges.count()
        if not left:
            break
        levels.append(_roots(edges))
    found, n = levels.pop()
    while levels:
        found = broadcast_up_to(found, n).select(F.col("id").alias("top"), F.col("top").alias("lower"))
        above, n = levels.pop()
        found = above.join(found, "top", "left").select("id", F.coalesce("lower", "top").alias("top"))
    return broadcast_up_to(found, n).withColumnRenamed("top", "component")
