"""Merkle manifests against plain hashlib."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tabmill.llm import merkle, registry

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The one node that is left, and for each leaf the siblings left and right, level by level."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for p, i in zip(paths, at):
            p.append(("".join(runs[i // 8][: i % 8]), "".join(runs[i // 8][i % 8 + 1 :])))
        nodes, at = [sha("".join(r)) for r in runs], [i // 8 for i in at]
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    done = {}
    for lang, some in groups.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[1], r[2], r[3], r[4])))
        done[lang] = tree([leaf(*r[:4], r[4]) for r in some])
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = tree([done[x][0] for x in order])
    out = []
    for lang, top in zip(order, tops):
        subroot, paths = done[lang]
        for r, path in zip(groups[lang], paths):
            path = path + top
            altered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = r[4] if r[4] is None or not altered else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            node = leaf(*r[:4], text)
            for a, b in path:
                node = sha(a + node + b)
            out.append((r[0], leaf(*r), subroot, root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def documents(n=700):
    rows = [(i * 7 % 1009, f"src{i % 5}", "en" if i % 3 else ["de", None, "", "é", "z", "Z"][i // 3 % 6], i, "Text Ä " * (i % 4)) for i in range(n)]
    return rows + [(5000, None, "one", None, None), (None, None, None, None, None), (None, "s", "en", 1, "A"), (1, "src", "en", 0, "x" * 300_000)] + rows[:9] + rows[:9]


def registered(spark, monkeypatch, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).withColumns({"tree": F.lit(1), "pos": F.lit("x"), "node": F.lit(0), "by": F.lit(2)})
    monkeypatch.setattr(registry, "_table", lambda *_: df)
    return sorted(map(tuple, registry.op13_merkle_manifest(spark, "").collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65, 700])
def test_proofs_equal_hashlib(spark, monkeypatch, n):
    rows = documents()[:n] if n < 700 else documents()
    assert registered(spark, monkeypatch, rows) == (brute(rows) if rows else [])


def test_deep_tree_and_other_stored_levels(spark):
    df = spark.range(4200).withColumn("v", F.col("id") * 3)
    want, paths = tree([leaf(i, 3 * i) for i in range(4200)])
    for every in (1, 2, 3, 4):
        manifest = merkle.build(df, F.lit("all"), "id", merkle.digest(F.col("id"), F.col("v")), every=every, id=F.col("id"))
        assert manifest.levels == tuple(range(0, 5 + every, every))[: -(-5 // every) + 1]
        assert manifest.root().first()[0] == want == manifest.subroots().first()["subroot"]
        out = merkle.proofs(manifest).select("id", "path", merkle.folded(F.col("node"), F.col("path")).alias("back")).collect()
        assert len(out) == 4200 and {r["back"] for r in out} == {want}
        assert all([(s["l"], s["r"]) for s in r["path"]] == paths[r["id"]] for r in out if r["id"] % 97 == 0)


def test_many_trees(spark):
    df = spark.range(900).withColumn("t", F.col("id") % 300)
    manifest = merkle.build(df, F.col("t"), "id", merkle.digest(F.col("id")))
    proven = merkle.proofs(manifest)
    assert proven.count() == 900 and proven.where(merkle.folded(F.col("node"), F.col("path")) != F.col("root")).count() == 0
    tops = [tree([leaf(i) for i in range(t, 900, 300)])[0] for t in sorted(range(300), key=str)]
    assert manifest.root().first()[0] == tree(tops)[0]


def test_a_changed_row_does_not_verify(spark):
    df = spark.range(100).withColumn("t", F.lit("x"))
    manifest = merkle.build(df, F.col("t"), "id", merkle.digest(F.col("id")), id=F.col("id"))
    wrong = merkle.digest(F.col("id") + 1)
    assert merkle.proofs(manifest).where(merkle.folded(wrong, F.col("path")) == F.col("root")).count() == 0
