"""Hard negatives against plain inner products."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabmill.llm import hard_negatives as hard
from tabmill.llm import top_k

SCHEMA = "id bigint, label int, vector array<bigint>"


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 19), st.integers(1, 40), st.sampled_from([1, 5, 300, 1 << 20, 1 << 40]), st.integers(0, 1000))
def test_scores_are_exact(dims, n, most, seed):
    rng = np.random.default_rng(seed)
    a, c = rng.integers(-most, most + 1, (7, dims)), rng.integers(-most, most + 1, (n, dims))
    planes, need = hard.pack(c)
    padded = np.zeros((7, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = a
    kind = hard._kind(padded, planes.shape[1])
    assert (hard.unpack(planes)[:, :dims] == c).all() and planes.shape[1] == need.max()
    with np.errstate(over="ignore"):
        assert (hard.scores(hard.subset_sums(padded.astype(kind)), planes) == c @ a.T).all()


def brute(rows, positives=5, negatives=10, low=30, high=90):
    good = [(i, y, v) for i, y, v in rows if i is not None and y is not None and v is not None]
    seen = {}
    for i, y, v in good:  # smallest label, then shortest
        if i not in seen or (y, len(v)) < (seen[i][0], len(seen[i][1])):
            seen[i] = (y, v)
    out = []
    for a, (y, v) in seen.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, (z, w) in seen.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == y][:positives]:
            fit = [x for x in scored if x[2] != y and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out)


def vectors(n=700, dims=11, seed=5):
    rng = np.random.default_rng(seed)
    # one label and one vector hold a third of the rows; scores tie
    rows = [(i, 0 if i % 3 == 0 else int(rng.integers(0, 4)), [1] * dims if i % 3 == 1 else rng.integers(-3, 6, dims).tolist()) for i in range(n)]
    rows += [(900 + i, i % 3, rng.integers(0, 9, 5).tolist()) for i in range(30)]  # another length
    rows += [(None, 1, [1] * dims), (2000, None, [1] * dims), (2100, 1, None), (2200, 1, []), (2300, 0, []), (2400, 7, [1 << 30] * dims), (2401, 7, [1 << 28] * dims), (2402, 8, [1 << 27] * dims)]
    return rows + rows[:50] + [(0, 9, [5] * dims)]


@pytest.mark.parametrize("shard,block", [(hard.SHARD, hard.BLOCK), (40, 2)])
def test_mined_rows_equal_brute_force(spark, shard, block):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"s": F.lit(1), "dims": F.lit("x"), "bounds": F.lit(None)})
    got = hard.mine(df, F.col("id") % 100 == 0, shard=shard, block=block)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_large_and_small_blocks_in_memory(spark, monkeypatch):
    rows = vectors(seed=8)
    monkeypatch.setattr(hard, "ROWS", 7)
    monkeypatch.setattr(hard, "COLUMNS", 2)
    kept = sorted((i, y, v) for i, y, v in rows[:400] if y is not None and len(v) == 11)
    planes, _ = hard.pack(np.array([v for _, _, v in kept]))
    import pyarrow as pa

    blobs = [p.tobytes() for p in planes]
    table = pa.table({"id": [i for i, _, _ in kept], "dims": [11] * len(kept), "bits": [planes.shape[1]] * len(kept), "planes": blobs})
    found = np.vstack([b for _, b in hard._blocks(table, table)])
    matrix = np.array([v for _, _, v in kept])
    assert (found == matrix @ matrix.T).all()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard.mine(empty, F.col("id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [1, 2])], SCHEMA)
    assert hard.mine(one, F.col("id") % 100 == 0).count() == 0
    assert hard.mine(spark.createDataFrame(vectors(40), SCHEMA), F.col("id") % 100 == 99).count() == 0


def test_rows_with_odd_components_take_no_part(spark):
    odd = [None, [1.0, None], [float("nan"), 1.0], [1.0, float("inf")]]
    rows = [(i, 0, [0.5, 0.25]) for i in range(3)] + [(100 + i, 0, v) for i, v in enumerate(odd)] + [(7, 1, [0.25, 0.25])]
    df = spark.createDataFrame(rows, "id bigint, label int, embedding array<float>").withColumn("vector", top_k.whole(F.col("embedding"), 256))
    got = sorted(map(tuple, hard.mine(df, F.col("id") % 100 == 0).collect()))
    assert got == [(0, 1, 1, 7, 20480, 12288), (0, 2, 1, 7, 20480, 12288)]
