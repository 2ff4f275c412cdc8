"""Exact k-nearest-neighbours regression over tables of any size.

Train rows are cut into leaves of a k-d tree that is drawn from a bounded sample; the number of leaves goes with the rows. A
query first searches its own leaf. The distance of its k-th neighbour there bounds the other leaves that can hold a nearer
one; these are found by descending the boxes of the tree and searched in rounds, nearest first, and every round narrows the
bound for the next. Equal vectors are reduced to the k rows that can ever be chosen, and leaves that are still large are
searched in chunks, so no task sees more than a bounded block of either side.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import lookup_join
from ..sources.workspace import materialize

LEAF_ROWS = 4_096
MAX_LEAVES = 1 << 17  # the tree and its boxes are broadcast: about 50 + 32 bytes per input for each leaf
BLOCK_ROWS = 16_384
SAMPLE_PER_LEAF = 24
SAMPLE_ROWS = 1 << 19  # at most so many rows come to the driver, two per leaf at least
FIRST_ROUND, GROWTH = 8, 8  # leaves besides its own that a query visits in the first round, and how many times more in the next


def _vector(features) -> F.Column:
    parts = []
    for c in features:
        x = F.col(c).cast("double")
        bad = x.isNull() | F.isnan(x)
        parts.append(F.when(bad, F.raise_error(F.lit(f"{c} has missing values"))).otherwise(x + F.lit(0.0)))
    return F.array(*parts)


@dataclass(frozen=True)
class Tree:
    """Split nodes (dimension, threshold, children; leaves as -1 - number)."""

    dimension: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        if not len(self.dimension):
            return node
        active = np.arange(len(points))
        while len(active):
            at = node[active]
            goes_left = points[active, self.dimension[at]] <= self.threshold[at]
            node[active] = np.where(goes_left, self.left[at], self.right[at])
            active = active[node[active] >= 0]
        return -1 - node


@dataclass(frozen=True)
class Boxes:
    """The bounding boxes of all split nodes and leaves of a tree, by which leaves are found that a ball meets."""

    tree: Tree
    node_low: np.ndarray
    node_high: np.ndarray
    low: np.ndarray
    high: np.ndarray
    p: int

    def _reach(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distances from points to the boxes of nodes (leaves as -1 - number)."""
        inner = at >= 0
        low, high = np.empty_like(points), np.empty_like(points)
        low[inner], high[inner] = self.node_low[at[inner]], self.node_high[at[inner]]
        low[~inner], high[~inner] = self.low[-1 - at[~inner]], self.high[-1 - at[~inner]]
        gap = np.maximum(np.maximum(low - points, points - high), 0)
        return gap.sum(axis=1) if self.p == 1 else np.sqrt((gap * gap).sum(axis=1))

    def within(self, points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, leaf, distance) of all leaves whose boxes are within the radius of a point, by point and distance."""
        # allow for rounding: a leaf searched in vain costs time, a leaf missed costs the answer
        bound = radius * (1 + 1e-9) + 1e-300
        row = np.arange(len(points))
        at = np.zeros(len(points), dtype=np.int64) if len(self.tree.dimension) else np.full(len(points), -1)
        found: list[tuple] = []
        while len(row):
            reach = self._reach(points[row], at)
            near = reach <= bound[row]
            row, at, reach = row[near], at[near], reach[near]
            leaf = at < 0
            found.append((row[leaf], -1 - at[leaf], reach[leaf]))
            row, at = row[~leaf], at[~leaf]
            row, at = np.concatenate([row, row]), np.concatenate([self.tree.left[at], self.tree.right[at]])
        rows, leaves, reach = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((leaves, reach, rows))
        return rows[order], leaves[order], reach[order]


def boxed(tree: Tree, low: np.ndarray, high: np.ndarray, p: int) -> Boxes:
    """The boxes of split nodes are those of their children together; children come after their parent."""
    node_low, node_high = (np.empty((len(tree.dimension), low.shape[1])) for _ in range(2))
    for at in range(len(tree.dimension) - 1, -1, -1):
        children = (int(tree.left[at]), int(tree.right[at]))
        node_low[at] = np.minimum(*[node_low[c] if c >= 0 else low[-1 - c] for c in children])
        node_high[at] = np.maximum(*[node_high[c] if c >= 0 else high[-1 - c] for c in children])
    return Boxes(tree, node_low, node_high, low, high, p)


def plant(sample: np.ndarray, leaves: int) -> Tree:
    """Cut the sample at medians of its widest dimension until there are enough leaves."""
    nodes: list[list] = []
    counter = 0

    def grow(points: np.ndarray, share: int) -> int:
        nonlocal counter
        spread = points.max(axis=0) - points.min(axis=0) if len(points) else np.zeros(sample.shape[1])
        d = int(np.argmax(spread))
        if share <= 1 or len(points) < 2 or spread[d] == 0:
            counter += 1
            return -counter
        values = np.sort(points[:, d])
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:
            cut = values[values < cut][-1]
        at = len(nodes)
        nodes.append([d, cut, 0, 0])
        lower = points[:, d] <= cut
        nodes[at][2] = grow(points[lower], share // 2)
        nodes[at][3] = grow(points[~lower], share - share // 2)
        return at

    grow(sample, leaves)
    table = list(zip(*nodes)) if nodes else [(), (), (), ()]
    return Tree(
        np.array(table[0], dtype=np.int64),
        np.array(table[1], dtype=float),
        np.array(table[2], dtype=np.int64),
        np.array(table[3], dtype=np.int64),
    )


def _distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        gap = np.abs(a[:, d, None] - b[None, :, d])
        total += gap if p == 1 else gap * gap
    return total if p == 1 else np.sqrt(total)


def _search_block(k: int, p: int):
    """Cogrouped: the k nearest of one block of train rows for each query of one block."""

    def search(queries: pd.DataFrame, train: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(train):
            return pd.DataFrame({"q": [], "dist": [], "key": [], "y": []})
        train = train.sort_values("key", kind="stable")
        keys, ys = train["key"].to_numpy(), train["y"].to_numpy()
        points = np.stack(train["v"].to_numpy())
        asked = np.stack(queries["q"].to_numpy())
        step = max(1, 4_000_000 // len(points))
        take = min(k, len(points))
        rows, columns, found = [], [], []
        for start in range(0, len(asked), step):
            dist = _distances(asked[start : start + step], points, p)
            # keys ascend along the columns, so a stable sort breaks ties by key
            if take < len(points):
                kth = np.partition(dist, take - 1, axis=1)[:, take - 1]
            else:
                kth = np.full(len(dist), np.inf)
            for i, row in enumerate(dist):
                near = np.flatnonzero(row <= kth[i])
                near = near[np.argsort(row[near], kind="stable")][:take]
                rows.extend([start + i] * len(near))
                columns.extend(near)
                found.extend(row[near])
        vectors = queries["q"].to_numpy()
        return pd.DataFrame({"q": vectors[rows], "dist": found, "key": keys[columns], "y": ys[columns]})

    return search


def nearest(answers: DataFrame, k: int) -> DataFrame:
    """(q, rank, dist, key, y): of all answers (q, dist, key, y) the k nearest of each query, ties to the smaller key."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy("dist", "key"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("q", "rank", "dist", "key", "y")


class Predicting:
    """Predictions from the neighbours that an index finds."""

    features: tuple[str, ...]
    k: int

    def neighbours(self, queries: DataFrame) -> DataFrame:
        raise NotImplementedError

    def predict(self, queries: DataFrame, settings: dict[str, tuple[int, str]]) -> DataFrame:
        """Add a prediction per setting {column: (k, 'uniform' or 'distance')}; one search serves all."""
        for name, (k, weights) in settings.items():
            if not 1 <= k <= self.k:
                raise ValueError(f"{name}: k must be between 1 and {self.k}")
            if weights not in ("uniform", "distance"):
                raise ValueError(f"unknown weights {weights!r}")
        aggregates = []
        for name, (k, weights) in settings.items():
            near = F.col("rank") <= k
            if weights == "uniform":
                aggregates.append(F.avg(F.when(near, F.col("y"))).alias(name))
                continue
            same = near & (F.col("dist") == 0)
            exact = F.avg(F.when(same, F.col("y")))
            w = F.when(near & (F.col("dist") > 0), 1 / F.col("dist"))
            aggregates.append(F.coalesce(exact, F.sum(w * F.col("y")) / F.sum(w)).alias(name))
        answers = materialize(self.neighbours(queries).groupBy("q").agg(*aggregates), "knn-answers")
        return lookup_join(queries.withColumn("q", _vector(self.features)), answers, ["q"]).drop("q")


@dataclass(frozen=True)
class KnnIndex(Predicting):
    """Leaves of train rows (v, key, y, leaf), the tree, and the bounding boxes of the leaves."""

    features: tuple[str, ...]
    train: DataFrame
    tree: Tree
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    k: int
    p: int
    block_rows: int = BLOCK_ROWS
    compared: list[int] = field(default_factory=list, compare=False)

    def _nearest(self, asked: DataFrame) -> DataFrame:
        """Nearest k per query among the train rows of the leaves in `asked` (q, leaf)."""
        blocks = lambda n: F.greatest(F.ceil(F.col(n) / self.block_rows), F.lit(1)).cast("int")
        wanted = asked.groupBy("leaf").agg(F.count(F.lit(1)).alias("_asked"))
        held = self.train.groupBy("leaf").agg(F.count(F.lit(1)).alias("_held"))
        plan = materialize(wanted.join(held, "leaf"), "knn-plan")
        pairs = plan.agg(F.sum(F.col("_asked") * F.col("_held"))).first()[0] or 0
        self.compared.append(int(pairs))
        # one row per leaf, and the number of leaves is bounded
        plan = F.broadcast(plan.select("leaf", blocks("_held").alias("train_blocks"), blocks("_asked").alias("query_blocks")))
        left = (
            asked.join(plan, "leaf")
            .withColumn("query_block", F.pmod(F.xxhash64("q"), F.col("query_blocks")).cast("int"))
            .withColumn("train_block", F.explode(F.sequence(F.lit(0), F.col("train_blocks") - 1)))
            .select("leaf", "train_block", "query_block", "q")
        )
        right = (
            self.train.join(plan, "leaf")
            .withColumn("train_block", F.pmod(F.xxhash64("key"), F.col("train_blocks")).cast("int"))
            .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
            .select("leaf", "train_block", "query_block", "v", "key", "y")
        )
        names = ["leaf", "train_block", "query_block"]
        key_type = self.train.schema["key"].dataType.simpleString()
        return (
            left.groupBy(*names)
            .cogroup(right.groupBy(*names))
            .applyInPandas(_search_block(self.k, self.p), f"q array<double>, dist double, key {key_type}, y double")
        )

    def neighbours(self, queries: DataFrame) -> DataFrame:
        """(q, rank, dist, key, y) for the distinct vectors of the queries; ties go to the smaller key.

        `compared` then holds how many pairs of vectors each round compared.
        """
        self.compared.clear()
        q = queries.select(_vector(self.features).alias("q")).distinct()
        if len(self.rows) == 1:
            return nearest(self._nearest(q.withColumn("leaf", F.lit(0))), self.k)
        tree, boxes = self.tree, boxed(self.tree, self.low, self.high, self.p)

        @F.pandas_udf("int")
        def home(vectors: pd.Series) -> pd.Series:
            return pd.Series(tree.leaf_of(np.stack(vectors.to_numpy())).astype("int32"))

        def following(first: int, many: int):
            """Of the leaves that the radius meets, nearest first, the own one left out, `many` from the place `first` on."""

            @F.pandas_udf("array<int>")
            def leaves(vectors: pd.Series, own: pd.Series, radius: pd.Series) -> pd.Series:
                points, bound, mine = np.stack(vectors.to_numpy()), radius.to_numpy(), own.to_numpy()
                out = []
                for start in range(0, len(points), 1_024):
                    row, leaf, _ = boxes.within(points[start : start + 1_024], bound[start : start + 1_024])
                    other = leaf != mine[start + row]
                    row, leaf = row[other], leaf[other]
                    edges = np.searchsorted(row, np.arange(len(points[start : start + 1_024]) + 1))
                    out += [leaf[a:b][first : first + many].astype("int32") for a, b in zip(edges, edges[1:])]
                return pd.Series(out)

            return leaves

        at_home = materialize(q.withColumn("leaf", home("q")), "knn-queries")
        near = materialize(nearest(self._nearest(at_home), self.k), "knn-near")
        first, many = 0, FIRST_ROUND
        while first < len(self.rows) - 1:
            bounds = near.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("far"))
            radius = F.when(F.col("n") >= self.k, F.col("far")).otherwise(F.lit(math.inf))
            others = following(first, many)("q", "leaf", radius)
            further = materialize(at_home.join(bounds, "q", "left").select("q", F.explode(others).alias("leaf")), "knn-further")
            if further.isEmpty():
                break
            near = materialize(nearest(near.drop("rank").unionByName(self._nearest(further)), self.k), "knn-near")
            first, many = first + many, many * GROWTH
        return near


def reduced_rows(train: DataFrame, features, label: str, key: str, k: int) -> tuple[DataFrame, int]:
    """Train rows as (v, key, y), of equal vectors only the k smallest keys, and their number."""
    rows = train.select(_vector(features).alias("v"), F.col(key).alias("key"), F.col(label).cast("double").alias("y"))
    # the rank filter is applied before the shuffle as well, so frequent vectors shrink at the source
    first = Window.partitionBy("v").orderBy("key")
    reduced = rows.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k).drop("_r")
    reduced = materialize(reduced, "knn-train")
    total = reduced.count()
    if total < k:
        raise ValueError(f"{k} neighbours wanted, only {total} train rows")
    return reduced, total


def build_index(
    train: DataFrame,
    features,
    label: str,
    key: str,
    k: int,
    p: int = 2,
    leaf_rows: int = LEAF_ROWS,
    max_leaves: int = MAX_LEAVES,
    block_rows: int = BLOCK_ROWS,
) -> KnnIndex:
    """Reduce equal vectors to their k smallest keys and cut the rest into leaves."""
    if p not in (1, 2):
        raise ValueError("p must be 1 or 2")
    features = tuple(features)
    reduced, total = reduced_rows(train, features, label, key, k)
    leaves = min(max_leaves, max(1, math.ceil(total / leaf_rows)))
    if leaves == 1:
        edge = np.zeros((1, len(features)))
        tree = plant(edge, 1)
        return KnnIndex(features, reduced.withColumn("leaf", F.lit(0)), tree, edge, edge, np.array([total]), k, p, block_rows)
    wanted = min(leaves * SAMPLE_PER_LEAF, max(SAMPLE_ROWS, 2 * leaves))
    # rows are different vectors but for k of each, so a keyed hash draws them evenly, and alike on every run
    share = 1.1 * wanted / total
    drawn = reduced if share >= 0.9 else reduced.where(F.xxhash64("v", F.lit(11)) < int((2 * share - 1) * 2**63))
    sample = drawn.select("v").limit(2 * wanted).toPandas()["v"]
    tree = plant(np.stack(sample.to_numpy()).astype(float) if len(sample) else np.zeros((1, len(features))), leaves)

    @F.pandas_udf("int")
    def leaf(vectors: pd.Series) -> pd.Series:
        return pd.Series(tree.leaf_of(np.stack(vectors.to_numpy())).astype("int32"))

    placed = materialize(reduced.withColumn("leaf", leaf("v")), "knn-leaves")
    boxes = placed.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(F.col("v")[i]).alias(f"lo{i}") for i in range(len(features))],
        *[F.max(F.col("v")[i]).alias(f"hi{i}") for i in range(len(features))],
    ).collect()
    count = max(len(tree.dimension) + 1, 1)
    low = np.full((count, len(features)), np.inf)
    high = np.full((count, len(features)), -np.inf)
    sizes = np.zeros(count, dtype=np.int64)
    for r in boxes:
        sizes[r["leaf"]] = r["n"]
        low[r["leaf"]] = [r[f"lo{i}"] for i in range(len(features))]
        high[r["leaf"]] = [r[f"hi{i}"] for i in range(len(features))]
    return KnnIndex(features, placed, tree, low, high, sizes, k, p, block_rows)


def save_index(index: KnnIndex, path: str) -> dict:
    """Write the train rows; what else the index is made of, bounded by its leaves, is returned as plain values."""
    index.train.write.mode("overwrite").parquet(path)
    whole = lambda o: {f.name: np.asarray(getattr(o, f.name)).tolist() for f in fields(o)}
    shape = {n: np.asarray(getattr(index, n)).tolist() for n in ("low", "high", "rows")}
    return {"features": list(index.features), "tree": whole(index.tree), "k": index.k, "p": index.p, "block_rows": index.block_rows, **shape}


def load_index(spark, path: str, card: dict) -> KnnIndex:
    tree = Tree(**{n: np.array(v) for n, v in card["tree"].items()})
    low, high = np.array(card["low"], dtype=float), np.array(card["high"], dtype=float)
    train = spark.read.parquet(path)
    return KnnIndex(tuple(card["features"]), train, tree, low, high, np.array(card["rows"]), card["k"], card["p"], card["block_rows"])
