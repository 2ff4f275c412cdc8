import hashlib
import re
import warnings
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tabmill.llm import mixing, registry


def fill(budget, children):
    """Water-filling of {name: (cap, weight)}, to the token."""
    given, order = {}, sorted((n for n in children if children[n][1]), key=lambda n: (Fraction(children[n][0], children[n][1]), n))
    left, weight = budget, sum(children[n][1] for n in order)
    for i, n in enumerate(order):
        cap, w = children[n]
        if cap * weight > left * w:
            for m in order[i:]:
                given[m] = min(children[m][0], left * children[m][1] // weight)
            spare = budget - sum(given.values())
            for m in [m for m in order[i:] if given[m] < children[m][0]][:spare]:
                given[m] += 1
            break
        given[n] = cap
        left, weight = left - cap, weight - w
    return {n: given.get(n, 0) for n in children}


def brute(rows, budget, epochs, weights, seed, levels):
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    tokens = defaultdict(int)
    for r in rows:
        tokens[tuple(r[i] for i in levels)] += size(r[1])
    given = {(): budget}
    for depth in range(1, len(levels) + 1):
        for parent in {k[: depth - 1] for k in tokens}:
            caps = defaultdict(int)
            for leaf, n in tokens.items():
                if leaf[: depth - 1] == parent:
                    caps[leaf[:depth]] += n * epochs
            given |= fill(given[parent], {c: (n, weights.get(c, 1)) for c, n in caps.items()})
    out = []
    for leaf, n in tokens.items():
        own = [r for r in rows if tuple(r[i] for i in levels) == leaf]
        whole = min(epochs, given[leaf] // n if n else epochs)
        out += [(r[0], e) for e in range(whole) for r in own]
        if whole < epochs:
            rest, run = given[leaf] - whole * n, 0
            key = lambda r: "" if r[0] is None else str(r[0])
            for r in sorted(own, key=lambda r: hashlib.md5(f"{seed}-{whole}-{key(r)}".encode()).hexdigest()):
                run += size(r[1])
                if run <= rest:
                    out.append((r[0], whole))
    return sorted(out)


@pytest.mark.parametrize("budget,epochs", [(0, 1), (500, 1), (900, 3), (2500, 3), (10**6, 2)])
def test_equals_brute_force(spark, monkeypatch, budget, epochs):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rows = [(i, "w " * (i * 7 % 13), f"d{i % 2}", f"l{i % 3}", f"s{i % 5 if i % 4 else 0}") for i in range(150)]
    weights = {("d0",): 3, ("d1", "l0"): 5, ("d0", "l1", "s0"): 0}
    df = spark.createDataFrame(rows, "doc_id bigint, text string, d string, lang string, source string")
    levels = {c: F.col(c) for c in ("d", "lang", "source")}
    got = mixing.select(df, levels, budget, epochs, weights, 5).select("doc_id", "mix_epoch").collect()
    assert sorted(map(tuple, got)) == brute(rows, budget, epochs, weights, 5, (2, 3, 4))


def test_shortage_goes_to_siblings_before_others(spark):
    leaves = spark.createDataFrame([("a", "x", 10, 1), ("a", "y", 1000, 1), ("b", "x", 1000, 1), ("b", "y", 5, 1)], "d string, s string, tokens bigint, rows bigint")
    got = {(r["d"], r["s"]): r["budget"] for r in mixing.budgets(leaves, ["d", "s"], 200, 1, {("a",): 3}).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 140, ("b", "x"): 45, ("b", "y"): 5}


def test_odd_rows(spark):
    rows = [(1, "a b", None, 1), (None, "a b c", "x", 2), (2, None, "x", 3), (3, "", None, 4), (4, "a", "x", 5), (4, "a", "x", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, leaf int")
    every = mixing.select(df, {"source": F.col("source")}, 1.0)
    assert sorted(map(str, every.select("doc_id", "leaf").collect())) == sorted(map(str, df.select("doc_id", "leaf").collect()))
    assert every.columns == [*df.columns, "mix_tokens", "mix_epoch"]
    assert mixing.select(df.limit(0), {"source": F.col("source")}, 0.5).count() == 0
    assert mixing.select(df, {"source": F.col("source")}, 0).where("mix_tokens > 0").count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b", "x")], "doc_id bigint, text string, source string")
    plan = mixing.select(df, {"source": F.col("source")}, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_weights_that_meet_no_row_are_named(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    levels = {"domain": F.expr(registry.DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    with pytest.warns(UserWarning) as told:
        mixing.select(docs, levels, 0.5, 2, {("d0",): 3, ("d1",): 2, ("d0", "en"): 5, ("d1", "de"): 4, ("d0", "en", "src0"): 2}, 17)
    assert [str(t.message) for t in told if "no row" in str(t.message)] == ["weights of paths that no row has: [('d0',), ('d0', 'en'), ('d0', 'en', 'src0')]"]
    odd = spark.createDataFrame([(1, "a b", None), (2, "c", "x")], "doc_id bigint, text string, source string")
    with pytest.warns(UserWarning, match=re.escape("[('y',), ('x', 'x'), ()]")):
        mixing.select(odd, {"source": F.col("source")}, 0.5, 1, {("y",): 2, ("x",): 3, ("x", "x"): 4, (): 5})
    # weights on all three levels that do meet a leaf: nothing is named, and each of them changes what is taken
    levels = {"domain": F.expr(registry.DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    rows = [(r["doc_id"], r["text"], f"d{len(r['source']) % 3}", r["lang"], r["source"]) for r in docs.collect()]
    budget = sum(len(re.findall("[^\x20\x09-\x0d]+", r[1] or "")) for r in rows) // 4
    weights = {("d1",): 3, ("d2", "en"): 5, ("d1", "en", "src0"): 7, ("d2", "en", "src10"): 9}
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="weights of paths")
        got = mixing.select(docs, levels, budget, 2, weights, 3).select("doc_id", "mix_epoch").collect()
        assert mixing.select(docs.limit(0), levels, budget, 2, weights, 3).count() == 0
    want = brute(rows, budget, 2, weights, 3, (2, 3, 4))
    assert sorted(map(tuple, got)) == want
    assert all(brute(rows, budget, 2, {k: w for k, w in weights.items() if k != p}, 3, (2, 3, 4)) != want for p in weights)


def test_every_weight_of_the_query_meets_a_row(spark):
    assert {len(path) for path in registry.MIX_WEIGHTS} == {1, 2, 3}
    for sf in ("sf0.001", "sf0.01"):
        with warnings.catch_warnings():
            warnings.filterwarnings("error", message="weights of paths")
            registry.op10_mixing(spark, f"/root/testdata/{sf}")
