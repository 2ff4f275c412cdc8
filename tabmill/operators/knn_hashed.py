"""Approximate k-nearest-neighbours regression by locality-sensitive hash tables.

Each table cuts space by random projections (Gaussian for Euclidean, Cauchy for Manhattan distances) into buckets; a query is
compared with the train rows that share a bucket with it in any table, which meet by a shuffle on the bucket. Near rows share
a bucket with a chance that is known from their distance, and this sets the number of tables.

Widths, projections and tables are chosen from an audit: the true neighbours of a bounded number of train rows, found in one
pass over all rows. The tables are then asked for the same rows, and doubled until enough of their true neighbours come back.
A query that finds fewer than k rows is answered by the exact search, so every query gets k.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.skew import lookup_join
from ..sources.workspace import materialize
from .knn import BLOCK_ROWS, Predicting, _distances, _vector, build_index, nearest, reduced_rows

AUDIT = 200  # train rows whose true neighbours are found
SPREAD = 4.0  # width of a projection's cells, as a multiple of the audited distance of the k-th neighbour
ROWS_PER_KEY = 64  # rows that a query should meet in one table
MAX_PROJECTIONS = 12
CELL_ROWS = 50_000  # rows of all tables in one task


@dataclass(frozen=True)
class Hashes:
    """Random projections: the same seed gives the same first tables, however many there are."""

    inputs: int
    p: int
    width: float
    projections: int
    tables: int
    seed: int = 7

    def _table(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, number])
        draw = rng.standard_cauchy if self.p == 1 else rng.standard_normal
        return draw((self.inputs, self.projections)), rng.uniform(0, self.width, self.projections)

    def prefixes(self, points: np.ndarray, number: int) -> np.ndarray:
        """Buckets (points, projections) of a table by its first projection, its first two, and so on."""
        directions, shift = self._table(number)
        with np.errstate(over="ignore", invalid="ignore"):
            cells = np.floor((points @ directions + shift) / self.width)
            cells = np.clip(np.nan_to_num(cells), -(2.0**62), 2.0**62).astype(np.int64).view(np.uint64)
            out = np.empty(cells.shape, np.uint64)
            key = np.full(len(points), (number + 1) * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
            for j in range(self.projections):
                key = (key ^ cells[:, j]) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
                out[:, j] = key
        return out.view(np.int64)

    def buckets(self, points: np.ndarray) -> np.ndarray:
        return np.stack([self.prefixes(points, t)[:, -1] for t in range(self.tables)], axis=1)


def meeting_chance(spread: float, p: int) -> float:
    """The chance that a cell `spread` times as wide as two points are apart holds both."""
    if p == 1:
        return 2 * math.atan(spread) / math.pi - math.log1p(spread**2) / (math.pi * spread)
    below = math.erf(spread / math.sqrt(2))
    return below - 2 / (math.sqrt(2 * math.pi) * spread) * (1 - math.exp(-(spread**2) / 2))


def tables_for(recall: float, chance: float, projections: int) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-min(chance**projections, 1 - 1e-12))))


def _matrix(vectors) -> np.ndarray:
    return np.stack(vectors.to_numpy())


def _search(k: int, p: int):
    """Cogrouped: for each query and bucket the k nearest train rows of that bucket; both sides hold many buckets."""

    def run(asked: pd.DataFrame, train: pd.DataFrame) -> pd.DataFrame:
        rows: list[np.ndarray] = []
        columns: list[np.ndarray] = []
        found: list[np.ndarray] = []
        if len(asked) and len(train):
            asked, train = asked.sort_values("bucket", kind="stable"), train.sort_values(["bucket", "key"], kind="stable")
            queries, points = _matrix(asked["q"]), _matrix(train["v"])
            ours, theirs = asked["bucket"].to_numpy(), train["bucket"].to_numpy()
            for bucket in np.intersect1d(ours, theirs).tolist():
                a, b = np.searchsorted(ours, bucket, "left"), np.searchsorted(ours, bucket, "right")
                c, d = np.searchsorted(theirs, bucket, "left"), np.searchsorted(theirs, bucket, "right")
                step = max(1, 2_000_000 // (d - c))
                for start in range(a, b, step):
                    dist = _distances(queries[start : min(start + step, b)], points[c:d], p)
                    # keys ascend along the columns, so a stable sort breaks ties by key
                    near = np.argsort(dist, axis=1, kind="stable")[:, :k]
                    rows.append(np.repeat(np.arange(start, start + len(dist)), near.shape[1]))
                    columns.append((c + near).ravel())
                    found.append(np.take_along_axis(dist, near, 1).ravel())
        row, column = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, columns))
        dist = np.concatenate(found) if found else np.zeros(0)
        return pd.DataFrame({"q": asked["q"].to_numpy()[row], "dist": dist, "key": train["key"].to_numpy()[column], "y": train["y"].to_numpy()[column]})

    return run


@dataclass(frozen=True)
class HashedIndex(Predicting):
    """Train rows (v, key, y) and the projections; `recall` is the share of true neighbours that the audit found."""

    features: tuple[str, ...]
    train: DataFrame
    hashes: Hashes
    k: int
    p: int
    recall: float = 0.0
    block_rows: int = BLOCK_ROWS
    compared: list[int] = field(default_factory=list, compare=False)

    def _bucketed(self, df: DataFrame, vector: str) -> DataFrame:
        hashes = self.hashes

        @F.pandas_udf("array<bigint>")
        def buckets(vectors: pd.Series) -> pd.Series:
            return pd.Series(list(hashes.buckets(_matrix(vectors))))

        return df.withColumn("bucket", F.explode(buckets(vector)))

    def candidates(self, q: DataFrame) -> DataFrame:
        """(q, rank, dist, key, y): the k nearest, or fewer, of the train rows that share a bucket with a vector of `q` (q)."""
        asked, train = self._bucketed(q, "q"), self._bucketed(self.train, "v")
        size = lambda df, name: df.groupBy("bucket").agg(F.count(F.lit(1)).alias(name))
        sizes = materialize(size(asked, "asked").join(size(train, "held"), "bucket"), "knn-buckets")
        total = sizes.agg(F.sum(F.col("asked") * F.col("held")), F.sum(F.col("asked") + F.col("held"))).first()
        self.compared.append(int(total[0] or 0))
        cells = int(total[1] or 0) // CELL_ROWS + 1
        # buckets that are too large for a task are met block by block
        blocks = lambda n: F.ceil(F.col(n) / self.block_rows).cast("int")
        hot = sizes.where((F.col("asked") > self.block_rows) | (F.col("held") > self.block_rows))
        hot = hot.select("bucket", blocks("asked").alias("q_blocks"), blocks("held").alias("t_blocks"))
        cell = F.pmod(F.xxhash64("bucket"), F.lit(cells)).alias("cell")

        def dealt(df: DataFrame, own: str, other: str, by: str, columns: list[str]) -> DataFrame:
            df = lookup_join(df.join(sizes.select("bucket"), "bucket", "left_semi"), hot, ["bucket"]).na.fill(1, ["q_blocks", "t_blocks"])
            block = F.pmod(F.xxhash64(by), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block")
            copies = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
            return df.select(cell, block, copies, "bucket", *columns)

        keys = ["cell", "q_block", "t_block"]
        left, right = dealt(asked, "q", "t", "q", ["q"]), dealt(train, "t", "q", "key", ["v", "key", "y"])
        schema = f"q array<double>, dist double, key {dict(self.train.dtypes)['key']}, y double"
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(self.k, self.p), schema)
        # a row that shares several buckets with a query is one neighbour
        rank = F.dense_rank().over(Window.partitionBy("q").orderBy("dist", "key"))
        return nearest(found.withColumn("_place", rank).where(F.col("_place") <= self.k).drop("_place").distinct(), self.k)

    def neighbours(self, queries: DataFrame) -> DataFrame:
        """(q, rank, dist, key, y) for the distinct vectors of the queries; `compared` then holds the pairs compared."""
        self.compared.clear()
        q = materialize(queries.select(_vector(self.features).alias("q")).distinct(), "knn-queries")
        near = materialize(self.candidates(q), "knn-near")
        full = near.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= self.k).select("q")
        few = materialize(q.join(full, "q", "left_anti"), "knn-few")
        if few.isEmpty():
            return near
        columns = [F.col("v")[i].alias(c) for i, c in enumerate(self.features)]
        exact = build_index(self.train.select(*columns, F.col("key").alias("_key"), F.col("y").alias("_y")), self.features, "_y", "_key", self.k, self.p)
        rest = exact.neighbours(few.select(*[F.col("q")[i].alias(c) for i, c in enumerate(self.features)]))
        self.compared.extend(exact.compared)
        return near.join(full, "q", "left_semi").unionByName(rest)


def _audited(rows: DataFrame, asked: np.ndarray, k: int, p: int) -> pd.DataFrame:
    """The k nearest rows (a, dist, key) at some distance of each audited vector, from one pass over all rows."""

    def run(batches):
        for batch in batches:
            points, keys = _matrix(batch["v"]), batch["key"].to_numpy()
            order = np.argsort(keys, kind="stable")
            points, keys = points[order], keys[order]
            for a in range(0, len(asked), 50):
                dist = _distances(asked[a : a + 50], points, p)
                dist[dist == 0] = np.inf
                near = np.argsort(dist, axis=1, kind="stable")[:, :k]
                out = pd.DataFrame({"a": np.repeat(np.arange(a, a + len(near)), near.shape[1]), "dist": np.take_along_axis(dist, near, 1).ravel(), "key": keys[near.ravel()]})
                yield out[np.isfinite(out["dist"])]

    part = rows.select("v", "key").mapInPandas(run, f"a int, dist double, key {dict(rows.dtypes)['key']}")
    rank = F.row_number().over(Window.partitionBy("a").orderBy("dist", "key"))
    return part.withColumn("rank", rank).where(F.col("rank") <= k).toPandas()


def build_hashed_index(
    train: DataFrame, features, label: str, key: str, k: int, p: int = 2, recall: float = 0.9, audit: int = AUDIT, rows_per_key: int = ROWS_PER_KEY, max_tables: int = 64, seed: int = 7
) -> HashedIndex:
    """An index whose audited recall is `recall` or more; with a warning, what `max_tables` tables reach."""
    if p not in (1, 2):
        raise ValueError("p must be 1 or 2")
    if not 0 < recall < 1:
        raise ValueError("recall must be between 0 and 1")
    features = tuple(features)
    rows, total = reduced_rows(train, features, label, key, k)
    picked = rows.select("v").distinct().orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(audit).toPandas()["v"]
    asked = _matrix(picked)
    true = _audited(rows, asked, k, p)
    radius = true.groupby("a")["dist"].max()
    width = SPREAD * float(np.quantile(radius, 0.9)) if len(radius) else 1.0
    chance = meeting_chance(SPREAD, p)
    probe = Hashes(len(features), p, width, MAX_PROJECTIONS, 1, seed)

    @F.pandas_udf("array<bigint>")
    def prefixes(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(probe.prefixes(_matrix(vectors), 0)))

    # rows that a row meets by the first projection of a table, by the first two, ..
    met = rows.select(F.posexplode(prefixes("v"))).groupBy("pos", "col").count().groupBy("pos").agg((F.sum(F.col("count") * F.col("count")) / total).alias("met"))
    met = {r["pos"] + 1: r["met"] for r in met.collect()}
    wanted = 1 - (1 - recall) / 2
    fitting = [m for m in sorted(met) if tables_for(wanted, chance, m) <= max_tables] or [1]
    projections = next((m for m in fitting if met[m] <= rows_per_key), fitting[-1])
    hashes = Hashes(len(features), p, width, projections, min(max_tables, tables_for(wanted, chance, projections)), seed)
    index = HashedIndex(features, rows, hashes, k, p)
    vectors = rows.sparkSession.createDataFrame(list(enumerate(asked.tolist())), "a int, q array<double>")
    while len(true):
        # twice as many, since up to k rows equal the audited one
        found = replace(index, k=2 * k).candidates(vectors.select("q")).where("dist > 0").join(vectors, "q").select("a", "key").toPandas()
        reached = len(true.merge(found, on=["a", "key"])) / len(true)
        index = replace(index, recall=reached, compared=[])
        if reached >= recall:
            break
        if index.hashes.tables >= max_tables:
            warnings.warn(f"{max_tables} tables find {reached:.3f} of the true neighbours, {recall} wanted", stacklevel=2)
            break
        index = replace(index, hashes=replace(index.hashes, tables=min(max_tables, 2 * index.hashes.tables)))
    return index


def save_hashed_index(index: HashedIndex, path: str) -> dict:
    """Write the train rows; the few numbers that make up the projections are returned as plain values."""
    index.train.write.mode("overwrite").parquet(path)
    return {"features": list(index.features), "hashes": asdict(index.hashes), "k": index.k, "p": index.p, "recall": index.recall, "block_rows": index.block_rows}


def load_hashed_index(spark: SparkSession, path: str, card: dict) -> HashedIndex:
    return HashedIndex(tuple(card["features"]), spark.read.parquet(path), Hashes(**card["hashes"]), card["k"], card["p"], card["recall"], card["block_rows"])
