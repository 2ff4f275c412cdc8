"""Hard negatives by Four-Russians scoring: inner products from subset-sum tables.

Vectors are whole numbers in two's complement. A candidate is stored as bit planes: for each bit, lowest first, one byte
per group of eight dimensions, which holds that bit of the eight components. For every anchor and group, a table gives the
sum of the anchor's components over each of the 256 subsets of the group. A plane's bytes index these tables; the looked-up
sums of a plane are added, shifted by the place of the bit (the sign bit's are taken off) and add up to the exact score.

Anchors are queries against all rows, in blocks: blocks of anchors meet shards of candidates, each pair of them one group.
The best positives come from shards of the anchor's own label. They bound the scores of its negatives, of which every shard
hands on its best few per anchor and positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import lookup_join
from ..sources.workspace import materialize

SHARD = 8192  # candidates in one group
BLOCK = 1024  # anchors in one group
ROWS, COLUMNS = 1024, 256  # candidates and anchors whose scores are in memory at once
GROUP = 8


def pack(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes (n, planes, groups) of whole numbers (n, dims), and how many planes each row needs."""
    n, dims = vectors.shape
    wide = np.zeros((n, -(-dims // GROUP) * GROUP), np.int64)
    wide[:, :dims] = vectors
    folded = np.bitwise_or.reduce(wide ^ (wide >> 63), axis=1) if dims else np.zeros(n, np.int64)
    need = np.array([int(x).bit_length() + 1 for x in folded.tolist()], np.int64)
    planes = np.arange(int(need.max(initial=1)))
    bits = ((wide[:, None, :] >> planes[:, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little"), need


def unpack(planes: np.ndarray) -> np.ndarray:
    """The whole numbers (n, 8 * groups) of bit planes (n, planes, groups)."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weight = np.left_shift(np.int64(1), np.arange(planes.shape[1]))
    weight[-1] = -weight[-1]
    return np.tensordot(bits, weight, ([1], [0]))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables (groups, 256, anchors): the sum of an anchor's components (anchors, 8 * groups) over each subset of a group."""
    n, dims = anchors.shape
    parts = np.ascontiguousarray(anchors.reshape(n, dims // GROUP, GROUP).transpose(1, 2, 0))
    tables = np.zeros((dims // GROUP, 1 << GROUP, n), anchors.dtype)
    for i in range(GROUP):
        tables[:, 1 << i : 2 << i] = tables[:, : 1 << i] + parts[:, i, None]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products (candidates, anchors) of bit planes (candidates, planes, groups) with the anchors of the tables."""
    n, bits, groups = planes.shape
    total = np.zeros((n, tables.shape[2]), tables.dtype)
    for k in range(bits):
        looked = np.zeros_like(total)
        for g in range(groups):
            looked += tables[g].take(planes[:, k, g], axis=0)
        if k == bits - 1:
            total -= looked << k
        else:
            total += looked << k
    return total


def _packed(batches):
    for batch in batches:
        vectors, keep = batch.column("vector"), [batch.column(c) for c in ("id", "label")]
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        flat, first = vectors.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)]
        out: list = [None] * batch.num_rows
        bits = np.ones(batch.num_rows, np.int64)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            planes, need = pack(flat[(first[rows][:, None] + np.arange(size))].reshape(len(rows), size))
            bits[rows] = need
            for row, plane, k in zip(rows.tolist(), planes, need.tolist()):
                out[row] = plane[:k].tobytes()
        yield pa.RecordBatch.from_arrays([*keep, pa.array(sizes), pa.array(bits), pa.array(out, pa.binary())], ["id", "label", "dims", "bits", "planes"])


def _planes(table: pa.Table, dims: int) -> np.ndarray:
    """The bit planes of a table's rows, rows of fewer bits with their sign repeated."""
    groups = -(-dims // GROUP)
    bits = table.column("bits").to_numpy()
    out = np.zeros((table.num_rows, int(bits.max(initial=1)), groups), np.uint8)
    rows = table.column("planes").to_pylist()
    for k in np.unique(bits).tolist():
        some = np.flatnonzero(bits == k)
        held = np.frombuffer(b"".join(rows[i] for i in some.tolist()), np.uint8).reshape(len(some), k, groups)
        out[some, :k] = held
        out[some, k:] = held[:, -1:]
    return out


def _kind(anchors: np.ndarray, bits: int) -> type:
    """32 bits if no sum on the way to a score needs more."""
    most = int(np.abs(anchors).max(initial=0)) * max(anchors.shape[1], 1)
    return np.int32 if most.bit_length() + bits < 31 else np.int64


def _blocks(anchors: pa.Table, candidates: pa.Table):
    """Bounded parts of the scores: numbers of the anchors and candidates (both ordered by id), and their scores (anchors, candidates)."""
    dims = anchors.column("dims")[0].as_py()
    left, right = unpack(_planes(anchors, dims)), _planes(candidates, dims)
    kind = _kind(left, right.shape[1])
    for a in range(0, len(left), COLUMNS):
        tables = subset_sums(left[a : a + COLUMNS].astype(kind))
        parts = [scores(tables, right[c : c + ROWS]) for c in range(0, len(right), ROWS)]
        yield np.arange(a, min(a + COLUMNS, len(left))), np.ascontiguousarray(np.concatenate(parts).T)


def _table(columns: dict[str, list]) -> pa.Table:
    return pa.table({k: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for k, v in columns.items()})


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k highest scores, highest first, equal ones by number."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
        return some[np.argsort(-score[some].astype(np.int64), kind="stable")[:k]]
    return np.argsort(-score.astype(np.int64), kind="stable")


def _positives(k: int):
    def run(anchors, candidates):
        out: dict[str, list] = {"anchor_id": [], "positive_id": [], "score": []}
        if anchors.num_rows and candidates.num_rows:
            anchors, candidates = anchors.sort_by("id"), candidates.sort_by("id")
            ids, own = candidates.column("id").to_numpy(), anchors.column("id").to_numpy()
            for numbers, block in _blocks(anchors, candidates):
                for i, score in zip(numbers.tolist(), block):
                    best = _best(score, k + 1)
                    best = best[ids[best] != own[i]][:k]
                    out["anchor_id"].append(np.full(len(best), own[i]))
                    out["positive_id"].append(ids[best])
                    out["score"].append(score[best].astype(np.int64))
        return _table(out)

    return run


def _negatives(k: int):
    def run(anchors, candidates):
        out: dict[str, list] = {"anchor_id": [], "positive_id": [], "negative_id": [], "positive_score": [], "negative_score": []}
        if anchors.num_rows and candidates.num_rows:
            anchors, candidates = anchors.sort_by("id"), candidates.sort_by("id")
            ids, labels = candidates.column("id").to_numpy(), candidates.column("label").to_numpy()
            own, label, bounds = anchors.column("id").to_numpy(), anchors.column("label").to_numpy(), anchors.column("bounds").to_pylist()
            for numbers, block in _blocks(anchors, candidates):
                for i, score in zip(numbers.tolist(), block):
                    other = np.flatnonzero(labels != label[i])
                    score = score[other]
                    for b in bounds[i]:
                        inside = np.flatnonzero((score >= b["low"]) & (score <= b["high"]))
                        best = inside[_best(score[inside], k)]
                        out["anchor_id"].append(np.full(len(best), own[i]))
                        out["positive_id"].append(np.full(len(best), b["id"]))
                        out["negative_id"].append(ids[other[best]])
                        out["positive_score"].append(np.full(len(best), b["score"]))
                        out["negative_score"].append(score[best].astype(np.int64))
        return _table(out)

    return run


def _met(anchors: DataFrame, candidates: DataFrame, by: list[str], shard: int, block: int):
    """Both sides dealt so that every block of anchors meets every shard of candidates that shares `by`, in one group each."""
    sizes = candidates.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / shard).cast("bigint").alias("shards"))
    queries = anchors.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / block).cast("bigint").alias("blocks"))
    sizes = sizes.join(queries, by)
    part = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n))
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    c = lookup_join(candidates, sizes, by, "inner").withColumn("s", part(1, "shards")).withColumn("b", copies("blocks")).drop("shards", "blocks")
    q = lookup_join(anchors, sizes, by, "inner").withColumn("b", part(2, "blocks")).withColumn("s", copies("shards")).drop("shards", "blocks")
    q = q.select(*[F.col(x).alias(x) for x in q.columns])  # both sides may come from one table
    return q.groupBy(*by, "s", "b").cogroup(c.groupBy(*by, "s", "b"))


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of `rows` (id, label, vector of whole numbers).

    A row's score is its inner product with the anchor; higher scores come first, equal ones by the smaller id. The rows for
    which `anchor` holds are anchors; the positives of one are the first rows of its label besides itself. For each, the
    first rows of other labels follow whose score is `low` to `high` hundredths of the positive's, both included. Fewer
    rows give fewer results, empty tables none. Rows with a null in any column take no part, and only vectors of one length
    are compared. An id counts once: of several rows the one with the smallest label and vector. Scores are 64 bits wide.
    """
    rows = rows.where("id is not null and label is not null and vector is not null")
    kept = rows.select(F.col("id").cast("bigint"), F.col("label").cast("bigint"), F.col("vector").cast("array<bigint>"))
    packed = kept.mapInArrow(_packed, "id bigint, label bigint, dims bigint, bits bigint, planes binary")
    fields = ("label", "dims", "bits", "planes")
    once = packed.groupBy("id").agg(F.min(F.struct(*fields)).alias("r")).select("id", *[F.col(f"r.{f}").alias(f) for f in fields])
    packed = materialize(once, "bit-planes")
    anchors = packed.where(anchor)

    near = _met(anchors, packed, ["dims", "label"], shard, block).applyInArrow(_positives(positives), "anchor_id bigint, positive_id bigint, score bigint")
    best = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id"))
    near = near.withColumn("at", best).where(F.col("at") <= positives)
    score = F.col("score")
    # 64-bit whole numbers: floor(high * score / 100) and ceil(low * score / 100) by decimals, which do not overflow
    wide = score.cast("decimal(20,0)")
    near = near.select(
        "anchor_id", F.col("positive_id").alias("id"), score,
        F.ceil(wide * low / F.lit(100).cast("decimal(3,0)")).cast("bigint").alias("low"),
        F.floor(wide * high / F.lit(100).cast("decimal(3,0)")).cast("bigint").alias("high"),
    ).where("low <= high")
    near = near.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct(F.col("id"), "score", "low", "high"))).alias("bounds"))
    wanted = materialize(anchors.join(near, "id"), "anchors")

    found = _met(wanted, packed, ["dims"], shard, block).applyInArrow(
        _negatives(negatives), "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    out = found.select("anchor_id", "positive_id", rank.alias("rank"), "negative_id", "positive_score", "negative_score")
    return out.where(F.col("rank") <= negatives)
