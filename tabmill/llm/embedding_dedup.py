"""Near-duplicate vectors by hierarchical navigable small-world graphs.

Equal vectors of a label are one vector with a count. The others are dealt into shards of bounded size per label, and each
shard becomes a graph: a base layer of all vectors and sparser layers above it, in which a vector is tied to near ones that
differ in direction. Every shard is searched by the vectors of every shard of its label (each pair of shards once, which
serves both sides): a beam descends the layers to the nearest vectors, and from those that are similar enough the search
spreads along the base layer until no further similar one is found. Some queries are compared with the whole shard as an
audit; unless nearly all their links were found, the beam is doubled and the shard searched again. Links are decided by
cosines in double precision, counted per vector, and reduced to one representative per task before components are formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize
from .graph import components

SHARD = 3000  # vectors per graph
DEGREE = 16  # ties per vector in the upper layers; twice as many in the base layer
BEAM = 32
BLOCK = 256  # queries that descend in step
AUDIT, RECALL = 64, 0.999  # audited queries per pair of shards, and the share of their links to be found
SLACK = 0.02  # the search spreads over vectors this much less similar as well


class Graph:
    """A navigable small-world graph over unit vectors."""

    def __init__(self, unit: np.ndarray, layers: list[np.ndarray] | None = None, nodes: list[np.ndarray] | None = None):
        self.unit = unit
        self.near = unit.astype(np.float32)
        self.layers, self.nodes = layers or [], nodes or []
        if not layers:
            self._build()

    def _build(self) -> None:
        n = len(self.unit)
        rng = np.random.default_rng(5)
        level = np.floor(-np.log(rng.random(n)) / np.log(DEGREE)).astype(np.int64) if n else np.zeros(0, np.int64)
        order = np.argsort(-level, kind="stable")  # the upper layers first, so that they guide the rest
        top = int(level.max()) if n else 0
        self.nodes = [order[: int((level >= i).sum())] for i in range(top + 1)]
        self.layers = [np.full((n, DEGREE * (2 if i == 0 else 1)), -1, np.int32) for i in range(top + 1)]
        at = 0
        while at < n:
            stop = min(n, at + max(1, min(BLOCK, at)))
            while stop > at + 1 and level[order[stop - 1]] != level[order[at]]:
                stop -= 1
            batch = order[at:stop]
            for i in range(int(level[batch[0]]), -1, -1):
                found = self._descend(self.near[batch], 2 * BEAM, i, order[0])[0] if at else np.full((len(batch), 0), -1)
                self._tie(i, batch, found)
            at = stop
        if n:
            self._connect()

    def _connect(self) -> None:
        """One more place per vector in the base layer, through which those that nothing leads to are reached."""
        base = self.layers[0]
        n = len(base)
        reached = np.zeros(n + 1, bool)
        reached[-1] = True
        spare = np.full(n, -1, np.int32)

        def spread(edge):
            while len(edge):
                reached[edge] = True
                edge = np.unique(base[edge])
                edge = edge[~reached[edge]]

        spread(self.nodes[-1][:1])
        for u in range(n):
            if not reached[u]:
                known = [x for x in base[u] if x >= 0 and reached[x]]
                at = known[0] if known else self.nodes[-1][0]
                while spare[at] >= 0:
                    at = spare[at]
                spare[at] = u
                spread(np.array([u]))
        self.layers[0] = np.hstack([base, spare[:, None]])

    def _tie(self, layer: int, batch: np.ndarray, found: np.ndarray) -> None:
        """Tie a batch to what it found and to one another, and those back to it."""
        width = self.layers[layer].shape[1]
        among = np.broadcast_to(batch, (len(batch), len(batch))).copy()
        np.fill_diagonal(among, -1)
        if among.shape[1] > BEAM:
            sims = np.where(among < 0, -2, self.near[batch] @ self.near[batch].T)
            among = np.take_along_axis(among, np.argpartition(-sims, BEAM, axis=1)[:, :BEAM], 1)
        kept = self._choose(batch, np.hstack([found, among]), width)
        self.layers[layer][batch] = kept
        a, b = np.repeat(batch, width), kept.ravel()
        a, b = a[b >= 0], b[b >= 0]
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        nodes, first, count = np.unique(b, return_index=True, return_counts=True)
        if not len(nodes):
            return
        place = np.arange(len(b)) - np.repeat(first, count)
        for start in range(0, int(count.max()), width):  # many may tie to one at once
            some = (place >= start) & (place < start + width)
            own = np.unique(b[some])
            back = np.full((len(own), width), -1)
            back[np.searchsorted(own, b[some]), place[some] - start] = a[some]
            for at in range(0, len(own), BLOCK):
                o = own[at : at + BLOCK]
                both = np.hstack([self.layers[layer][o], back[at : at + BLOCK]])
                self.layers[layer][o] = self._choose(o, both, width)

    def _choose(self, of: np.ndarray, candidates: np.ndarray, width: int) -> np.ndarray:
        """Up to `width` candidates of each vector, nearest first, that are nearer to it than to one already chosen.

        Free places go to the nearest of the others.
        """
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        candidates[candidates == of[:, None]] = -1
        sims = np.where(candidates < 0, -2, np.einsum("nd,ncd->nc", self.near[of], self.near[candidates]))
        order = np.argsort(-sims, axis=1, kind="stable")
        candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
        held = self.near[candidates]
        mutual = held @ held.transpose(0, 2, 1)
        good = np.zeros(candidates.shape, bool)
        for j in range(candidates.shape[1]):
            nearer = (np.where(good, mutual[:, j], -2) > sims[:, j, None]).any(1)
            good[:, j] = (candidates[:, j] >= 0) & ~nearer & (good.sum(1) < width)
        rank = np.argsort(np.where(good, 0, np.where(candidates >= 0, 1, 2)), axis=1, kind="stable")
        out = np.take_along_axis(candidates, rank, 1)[:, :width]
        if out.shape[1] < width:
            out = np.hstack([out, np.full((len(out), width - out.shape[1]), -1)])
        return out

    def _descend(self, queries: np.ndarray, beam: int, layer: int, entry: int | None = None):
        """The `beam` nearest vectors of a layer and their cosines, from the top layer down."""
        start = np.full((len(queries), 1), self.nodes[-1][0] if entry is None else entry)
        for i in range(len(self.layers) - 1, layer, -1):
            start = self._search(queries, start, 1, i)[0]
        if entry is None and beam > 1:  # all of the base layer can be reached from the first entry
            first = self.nodes[-1][0]
            start = np.hstack([start, np.where(start == first, -1, first)])
        return self._search(queries, start, beam, layer)

    def _search(self, queries: np.ndarray, start: np.ndarray, beam: int, layer: int):
        ties = self.layers[layer]
        n = len(queries)
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, len(self.near) + 1), bool)  # the last column takes what is no vector
        seen[:, -1] = True
        ids = np.full((n, beam), -1)
        sims = np.full((n, beam), -2, np.float32)
        ids[:, : start.shape[1]] = start
        sims[:, : start.shape[1]] = np.where(start < 0, -2, np.einsum("nd,ncd->nc", queries, self.near[start]))
        seen[rows, start] = True
        done = np.zeros((n, beam), bool)
        while True:
            open_ = np.where(done | (ids < 0), -2, sims)
            best = np.argmax(open_, axis=1)
            active = np.flatnonzero(open_[np.arange(n), best] > -2)
            if not len(active):
                return ids, sims
            best = best[active]
            done[active, best] = True
            new = ties[ids[active, best]]
            fresh = ~seen[active[:, None], new]
            seen[active[:, None], new] = True
            new = np.where(fresh, new, -1)
            score = np.where(fresh, np.einsum("nd,ncd->nc", queries[active], self.near[new]), -2)
            every = np.hstack([sims[active], score])
            chosen = np.argpartition(-every, beam - 1, axis=1)[:, :beam] if every.shape[1] > beam else np.argsort(-every, axis=1)[:, :beam]
            sims[active] = np.take_along_axis(every, chosen, 1)
            ids[active] = np.take_along_axis(np.hstack([ids[active], new]), chosen, 1)
            done[active] = np.take_along_axis(np.hstack([done[active], np.zeros_like(fresh)]), chosen, 1)

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, vector) of cosine `least` or more that the search finds."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, len(queries), BLOCK):
            part = queries[a : a + BLOCK]
            ids, sims = self._descend(part.astype(np.float32), min(beam, len(self.near)), 0)
            for q in np.flatnonzero((sims >= least - SLACK).any(1)):
                found = ids[q][sims[q] >= least - SLACK]
                seen = np.zeros(len(self.near) + 1, bool)
                seen[-1] = True
                seen[ids[q]] = True
                edge = found
                while len(edge):
                    edge = np.unique(self.layers[0][edge])
                    edge = edge[~seen[edge]]
                    seen[edge] = True
                    edge = edge[self.near[edge] @ part[q].astype(np.float32) >= least - SLACK]
                    found = np.concatenate([found, edge])
                good = found[self.unit[found] @ part[q] >= least]
                out.append((np.full(len(good), a + q), good))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in out]), np.concatenate([v for _, v in out])

    def audited(self, queries: np.ndarray, least: float, same: bool, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, float]:
        """Pairs found by a beam wide enough for the audit, and the recall it showed."""
        picked = np.unique(np.linspace(0, len(queries) - 1, min(AUDIT, len(queries))).astype(np.int64))
        q, v = np.nonzero(queries[picked] @ self.unit.T >= least)
        true = {(int(picked[i]), int(j)) for i, j in zip(q, v) if not same or picked[i] != j}
        while True:
            a, b = self.within(queries, least, beam)
            if same:  # what either side of a pair found
                a, b = np.concatenate([a, b]), np.concatenate([b, a])
                pairs = np.unique(a[a != b] * len(self.unit) + b[a != b])
                a, b = pairs // len(self.unit), pairs % len(self.unit)
            checked = np.isin(a, picked)
            recall = len(true & set(zip(a[checked].tolist(), b[checked].tolist()))) / len(true) if true else 1.0
            if recall >= RECALL or beam >= len(self.unit):
                return a, b, recall
            beam *= 2


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _index(table):
    """A shard's vectors and the layers of their graph."""
    table = table.sort_by("id")
    vectors = np.array(table.column("vector").to_pylist(), np.float64).reshape(table.num_rows, -1)
    graph = Graph(_unit(vectors))
    head = {c: table.column(c)[:1] for c in ("label", "dims", "shard")}
    blobs = {
        "ids": [table.column("id").to_numpy().tobytes()], "counts": [table.column("count").to_numpy().tobytes()],
        "unit": [graph.unit.tobytes()], "layers": [[x.tobytes() for x in graph.layers]], "nodes": [[x.tobytes() for x in graph.nodes]],
    }
    kinds = {"layers": pa.list_(pa.binary()), "nodes": pa.list_(pa.binary())}
    return pa.table(head | {k: pa.array(v, kinds.get(k, pa.binary())) for k, v in blobs.items()})


def _searched(least: float, beam: int):
    """For each pair of shards: its linked vectors, how many links each has there, and whom it hangs together with."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, counts = (np.frombuffer(row[c], np.int64) for c in ("ids", "counts"))
                mine, times = (np.frombuffer(row[f"q_{c}"], np.int64) for c in ("ids", "counts"))
                unit = np.frombuffer(row["unit"], np.float64).reshape(len(ids), -1)
                layers = [np.frombuffer(x, np.int32).reshape(len(ids), -1) for x in row["layers"]]
                graph = Graph(unit, layers, [np.frombuffer(x, np.int64) for x in row["nodes"]])
                same = row["shard"] == row["q_shard"]
                a, b, recall = graph.audited(np.frombuffer(row["q_unit"], np.float64).reshape(len(mine), -1), least, same, beam)
                top: dict[int, int] = {}

                def root(i):
                    while top.setdefault(i, i) != i:
                        top[i] = i = top[top[i]]
                    return i

                links: dict[int, int] = {}
                for x, y, m, n in zip(mine[a].tolist(), ids[b].tolist(), times[a].tolist(), counts[b].tolist()):
                    links[x] = links.get(x, 0) + n
                    if not same:  # pairs within a shard come in both directions
                        links[y] = links.get(y, 0) + m
                    rx, ry = root(x), root(y)
                    top[max(rx, ry)] = min(rx, ry)
                found = list(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), pa.array([links[i] for i in found], pa.int64()), pa.array([root(i) for i in found], pa.int64()), pa.array([recall] * len(found), pa.float64())],
                    ["id", "links", "low", "recall"],
                )

    return run


def near_duplicates(rows: DataFrame, least: float = 0.98, shard: int = SHARD, beam: int = BEAM) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `rows` (vec_id, embedding, label; others are ignored).

    Vectors of equal labels and lengths are linked at a cosine of `least`; the search starts with `beam`. Null labels, ids and vectors, zero and empty
    vectors and those with null or non-finite components are linked with nothing; a row without an id has no component and
    is kept. Rows of one id count as often as they come. An empty table gives an empty result.
    """
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), "label")
    real = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    valid = rows.where(F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & real & some, F.lit(False)))
    equal = ["label", "vector"]
    groups = valid.groupBy(*equal).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("count")).withColumn("dims", F.size("vector"))
    groups = materialize(groups, "vectors")
    sizes = groups.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / shard).cast("bigint").alias("shards"))
    dealt = groups.join(sizes, ["label", "dims"]).withColumn("shard", F.pmod(F.xxhash64("id", F.lit(3)), F.col("shards")))
    kind = dict(rows.dtypes)["label"]
    schema = f"label {kind}, dims int, shard bigint, ids binary, counts binary, unit binary, layers array<binary>, nodes array<binary>"
    graphs = dealt.select("label", "dims", "shard", "id", "count", "vector").groupBy("label", "dims", "shard").applyInArrow(_index, schema)
    graphs = materialize(graphs, "graphs")
    queries = graphs.select("label", "dims", *[F.col(c).alias(f"q_{c}") for c in ("shard", "ids", "counts", "unit")])
    pairs = graphs.join(queries, ["label", "dims"]).where("q_shard <= shard").drop("label", "dims")
    pairs = pairs.repartition(F.col("shard"), F.col("q_shard"), F.xxhash64("ids"))
    found = materialize(pairs.mapInArrow(_searched(least, beam), "id bigint, links bigint, low bigint, recall double"), "found")

    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    copies = valid.join(groups.select(*equal, "id", "count"), equal).select("vec_id", "id", "count")
    together = found.select(F.col("id").alias("a"), F.col("low").alias("b")).union(copies.select("vec_id", "id").where("vec_id <> id"))
    component = components(together).withColumnRenamed("id", "vec_id")
    linked = copies.join(counted, "id", "left").groupBy("vec_id").agg(F.max(F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("n_links"))
    out = rows.select("vec_id").join(linked, "vec_id", "left").join(component, "vec_id", "left")
    own = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), own.alias("component_id"),
        F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
