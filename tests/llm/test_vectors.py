import math
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabmill.llm import embedding_dedup, top_k

ODD = [[], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, None, [1.0, None] + [1.0] * 6, [1e-30] * 8, [1.0] * 3]


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.normal(size=8)
            for _ in range(rng.integers(1, 14)):
                base = base + rng.normal(scale=0.07, size=8)  # chains
                rows.append((base.tolist(), label))
    rows += [(rows[0][0], 0)] * 5 + [(v, 0) for v in ODD]
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


def brute(rows, least=0.98):
    unit = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            w = np.array(v) / np.abs(v).max()
            unit[i] = (label, len(v), w / np.sqrt((w**2).sum()))
    links = {i: {j for j in unit if j != i and unit[i][:2] == unit[j][:2] and unit[i][2] @ unit[j][2] >= least} for i in unit}
    out = []
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            todo += (new := links.get(todo.pop(), set()) - seen)
            seen |= new
        out.append((i, len(links.get(i, ())), min(seen), min(seen) == i))
    return out


# a beam wider than a shard, for full recall
@pytest.mark.parametrize("shard", [3000, 25])
def test_links_equal_brute_force(spark, shard):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("id", F.lit(0)).withColumn("count", F.lit("x"))
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df, shard=shard, beam=256).collect()))
    assert got == brute(rows)


def test_recall_of_a_large_graph():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16))
    unit = embedding_dedup._unit(np.repeat(centres, 40, axis=0) + rng.normal(scale=0.12, size=(2400, 16)))
    a, b, recall = embedding_dedup.Graph(unit).audited(unit, 0.98, True)
    true = unit @ unit.T >= 0.98
    np.fill_diagonal(true, False)
    assert true.sum() > 2000 and recall >= 0.99
    assert true[a, b].all() and len(a) >= 0.97 * true.sum()


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0
    lone = spark.createDataFrame([(None, [1.0], 1), (3, [2.0], 1), (4, [3.0], 1)], "vec_id bigint, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(lone).collect()}
    assert got == {None: (0, None, True), 3: (1, 3, True), 4: (1, 3, False)}


def test_lists_equal_brute_force():
    rng = np.random.default_rng(1)
    for n, dims, spread in ((500, 8, 50), (300, 3, 2), (7, 4, 9), (40, 1, 3), (900, 16, 1000)):
        ids = rng.permutation(10 * n)[:n]
        x = rng.integers(-spread, spread + 1, (n, dims))
        x[::3] = x[0]  # many ties
        lists = top_k.Lists(ids, x)
        for _ in range(10):
            q, without = rng.integers(-spread, spread + 1, dims), int(ids[rng.integers(n)])
            want = sorted((-int(s), int(i)) for i, s in zip(ids, x @ q) if i != without)[:10]
            got_ids, got = lists.top(q, 10, without)
            assert [(-int(s), int(i)) for i, s in zip(got_ids, got)] == want


def _brute(ids, x, queries, k, without):
    exact = x.astype(object)
    for row, (q, own) in enumerate(zip(queries.astype(object), without)):
        yield from ((row, i, -s) for s, i in sorted((-int(s), int(i)) for i, s in zip(ids, exact @ q) if i != own)[:k])


def test_search_over_runs_equals_brute_force(monkeypatch):
    monkeypatch.setattr(top_k, "RUN", 20)
    monkeypatch.setattr(top_k, "LONGEST", 100)
    monkeypatch.setattr(top_k, "BATCH", 7)
    monkeypatch.setattr(top_k, "PAIRS", 11)
    rng = np.random.default_rng(2)
    # many ties; few candidates; no component; sums that floating point rounds, with scores that differ by one
    for n, dims, spread, copies in ((700, 6, 3, 3), (700, 12, 500, 1), (9, 4, 5, 1), (90, 0, 1, 1), (500, 3, 10**9, 1), (500, 3, 10**9, 2)):
        ids, x = rng.permutation(5 * n)[:n], rng.integers(-spread, spread + 1, (n, dims))
        ids[1:3], x[::copies] = ids[0], x[0] if copies > 1 else x
        if spread == 10**9:
            x += rng.integers(-1, 2, x.shape)
        queries, without = x[:40], np.where(np.arange(n) % 4, ids, -1)[:40]
        query, found, score, read = top_k.search(ids, x, queries, 10, without)
        assert list(zip(query.tolist(), found.tolist(), score.tolist())) == list(_brute(ids, x, queries, 10, without))
        assert 0 <= read <= 1


def test_lists_are_left_early():
    rng = np.random.default_rng(3)
    x = rng.integers(-900, 900, (40, 32))[rng.integers(0, 40, 6000)] + rng.integers(-60, 61, (6000, 32))
    ids = rng.permutation(6000)
    query, found, score, read = top_k.search(ids, x, x[:60], 10, ids[:60])
    assert list(zip(query.tolist(), found.tolist(), score.tolist())) == list(_brute(ids, x, x[:60], 10, ids[:60]))
    assert read < 0.5


def test_a_block_of_queries_costs_less_than_each_alone():
    rng = np.random.default_rng(4)
    x = rng.integers(-500, 500, (1000, 64))
    table = lambda rows: pa.table({"id": pa.array(rows), "vector": pa.array(x[rows].tolist(), pa.list_(pa.int64()))})
    shard, block, lists = table(np.arange(1000)), table(np.arange(400)), top_k.Lists(np.arange(1000), x)

    def seconds(work):
        start = time.process_time()
        work()
        return time.process_time() - start

    together = min(seconds(lambda: top_k._search(10)(block, shard)) for _ in range(3))
    assert together < seconds(lambda: [lists.top(x[i], 10, i) for i in range(400)]) / 3


def test_top_k_over_shards_and_odd_rows(spark):
    rows = [(i, [i % 7 - 3, i * 5 % 11 - 5, i % 3]) for i in range(90)] + [(200, None), (None, [1, 2, 3]), (201, [1, 2]), (202, [])]
    df = spark.createDataFrame(rows, "id bigint, vector array<bigint>").withColumn("dims", F.lit("x"))
    got = sorted(map(tuple, top_k.top_k(df, df.where("id % 10 = 0 or id > 199"), 4, shard=20, block=3).collect()))
    full = {i: v for i, v in rows if i is not None and v is not None}
    want = []
    for q in [i for i in full if i % 10 == 0 or i > 199]:
        scores = sorted((-sum(a * b for a, b in zip(full[q], full[c])), c) for c in full if c != q and len(full[c]) == len(full[q]))
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:4])]
    assert got == sorted(want)
    assert top_k.top_k(df.limit(0), df).count() == 0


def test_whole_components(spark):
    df = spark.createDataFrame([([0.5, -0.0001],), ([float("nan")],), ([None],), (None,), ([],), ([float("-inf")],)], "v array<float>")
    assert [r[0] for r in df.select(top_k.whole(F.col("v"))).collect()] == [[512, -1], None, None, None, [], None]
