"""Exact top-k inner products by aggregation of sorted lists without random access.

Candidates are dealt into shards, and a shard by id into runs, each longer than the one before. A run keeps, for each
component, its vectors sorted by that component, and reads such lists in step for all queries of a block: from the largest
for positive weights, from the smallest for negative ones. What has been read of a vector gives a lower bound of its score
(unread components at their least), and with what the lists can still hold an upper bound. The bounds of many queries are
one product of their weights and the prefixes read so far. A query stops reading when few vectors can still reach its bar,
ties included: one more than the k-th score of the earlier runs, whose ids are smaller, or else the k-th lower bound. The
exact scores of those left are then summed up from their own components. The shards' results, k per query, are merged.

Vectors are whole numbers, so scores are exact; they have to fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD = 8000  # candidates read by one task at a time
BLOCK = 2000  # queries answered by one task at a time
RUN, LONGEST = 256, 2048  # candidates of a shard's first run, and of its longest ones
STEP = 16  # entries read of each list between two looks at the bounds, an eighth of the list at least
BATCH, PAIRS = 256, 1 << 14  # queries whose bounds, pairs whose scores are computed at once


class Lists:
    """The sorted lists of a run of vectors (rows of whole numbers), read by score."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.order = np.argsort(self.vectors, axis=0, kind="stable")  # by component, smallest first
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)

    def _read(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """After each step: entries read of each list, those entries by vector, which are unread, the last read, the least.

        Each component has two lists, from the largest and from the smallest.
        """
        order = np.concatenate([self.order[::-1], self.order], axis=1)
        # in floating point: sums of whole numbers below 2^53 stay exact
        value = np.concatenate([self.sorted[::-1], self.sorted], axis=1).astype(np.float64)
        known, unread, lists = np.zeros(value.shape), np.ones(value.shape, bool), np.arange(value.shape[1])
        n = len(value)
        step = max(STEP, n // 8)
        for at in range(0, n, step):
            rows = order[at : at + step]
            known[rows, lists] = value[at : at + step]
            unread[rows, lists] = False
            stop = min(n, at + step)
            yield stop, known, unread, value[stop - 1], value[-1]

    def contenders(self, queries: np.ndarray, k: int, bars: np.ndarray, without: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Queries, vectors (rows of either) and exact scores of pairs, among them each query's k best that reach its bar.

        A bar of -inf is none yet. Also how many entries of each list every query read. `without` has an id for each query
        that is no candidate of it.
        """
        n, dims = self.vectors.shape
        weights = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(np.float64)
        most = np.abs(queries.astype(np.float64)) @ np.abs(self.vectors.astype(np.float64)).max(axis=0, initial=0)
        slack = np.where(most < 2.0**53, 0, most * (16 * dims + 32) * 2.0**-53)  # such sums are rounded
        first, behind = (np.zeros(len(queries), int) if without is None else np.searchsorted(self.ids, without, side) for side in ("left", "right"))

        def bounds(of: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
            out = weights[of] @ prefixes.T
            for i in np.flatnonzero(first[of] < behind[of]):
                out[i, first[of[i]] : behind[of[i]]] = -np.inf
            return out

        left, depth, pairs = np.arange(len(queries)), np.zeros(len(queries), np.int64), [(np.zeros(0, int),) * 2]
        for stop, known, unread, frontier, least in self._read():
            new = bars == -np.inf
            # while vectors that were never seen can come halfway to the bar, a look at all bounds hardly pays
            ripe = left[new[left] | (weights[left] @ frontier < bars[left] - np.abs(bars[left]) / 2) | (stop == n)]
            highest = np.where(unread, frontier, known) if len(ripe) else None
            lowest = np.where(unread, least, known) if new[ripe].any() else None
            for of in (ripe[i : i + BATCH] for i in range(0, len(ripe), BATCH)):
                upper, bar = bounds(of, highest), bars[of]
                rise = np.flatnonzero(new[of] | (stop == n))
                if k <= n and len(rise):
                    lower = upper[rise] if stop == n else bounds(of[rise], lowest)
                    bar[rise] = np.maximum(bar[rise], np.partition(lower, n - k, axis=1)[:, n - k])
                can = upper >= np.maximum(bar - slack[of], np.finfo(float).min)[:, None]
                settled = (np.count_nonzero(can, axis=1) <= max(4 * k, n // 16)) | (stop == n)
                depth[of[settled]] = stop
                query, row = np.nonzero(can[settled])
                pairs.append((of[settled][query], row))
            left = left[depth[left] == 0]
            if not len(left):
                break
        query, row = (np.concatenate(x) for x in zip(*pairs))
        parts = (slice(i, i + PAIRS) for i in range(0, len(query), PAIRS))
        scores = [np.einsum("ij,ij->i", queries[query[x]], self.vectors[row[x]]) for x in parts]
        return query, row, np.concatenate([np.zeros(0, np.int64), *scores]), depth

    def top(self, query: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k vectors with the highest inner products, ties to smaller ids."""
        _, row, scores, _ = self.contenders(query[None, :], k, np.full(1, -np.inf), None if without is None else np.array([without]))
        chosen = np.lexsort((self.ids[row], -scores))[:k]
        return self.ids[row][chosen], scores[chosen]


def search(ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Rows of `queries`, ids and scores of their k best `vectors`, best first, and the share of list entries that was read."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    none = np.iinfo(np.int64).min
    best, kth = [np.zeros(0, np.int64)] * 3, np.full(len(queries), none)
    at, size, read = 0, RUN, 0
    while at < len(ids):
        lists = Lists(ids[at : at + size], vectors[at : at + size])
        query, row, score, depth = lists.contenders(queries, k, np.where(kth == none, -np.inf, kth + 1.0), without)
        enough = score > kth[query]  # of equal scores, those of earlier runs have the smaller ids
        query, found, score = (np.concatenate(x) for x in zip(best, (query[enough], lists.ids[row[enough]], score[enough])))
        order = np.lexsort((found, -score, query))
        query, found, score = query[order], found[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        best = [x[rank < k] for x in (query, found, score)]
        kth[query[rank == k - 1]] = score[rank == k - 1]
        at, size, read = at + size, min(2 * size, LONGEST), read + int(depth.sum())
    return *best, read / max(1, len(ids) * len(queries))


def _matrix(table: pa.Table) -> np.ndarray:
    return table.column("vector").combine_chunks().flatten().to_numpy().astype(np.int64, copy=False).reshape(table.num_rows, -1)


def _search(k: int):
    def run(queries, shard):
        found = [np.zeros(0, np.int64)] * 3
        if shard.num_rows and queries.num_rows:
            asked = queries.column("id").to_numpy()
            query, ids, scores, _ = search(shard.column("id").to_numpy(), _matrix(shard), _matrix(queries), k, asked)
            found = [asked[query], ids, scores]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), found)})

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the k rows of `candidates` with the highest scores.

    Both have an `id` and a `vector` of whole numbers; rows with a null in either take no part, and only vectors of one
    length are compared. A query's own id is no candidate. Equal scores go to the smaller id, fewer candidates give fewer
    rows, empty tables none. Ids should be unique: repeated rows are taken as one.
    """
    fit = lambda df: df.where("id is not null and vector is not null").select("id", "vector", F.size("vector").alias("dims"))
    candidates, queries = fit(candidates), fit(queries)
    count = lambda df, size: -(-(df.count() or 1) // size)
    shards, blocks = count(candidates, shard), count(queries, block)  # repeated rows included
    candidates, queries = candidates.distinct(), queries.distinct()
    part = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    c = candidates.withColumns({"s": part(1, shards)}).withColumn("b", copies(blocks))
    q = queries.withColumns({"b": part(2, blocks)}).withColumn("s", copies(shards))
    keys = ["dims", "s", "b"]
    found = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def whole(vector: Column, factor: int = 1024) -> Column:
    """floor(factor * x) of each component; null if the vector is, or holds a null or a value that is not finite."""
    real = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(F.coalesce(real, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("bigint")))
