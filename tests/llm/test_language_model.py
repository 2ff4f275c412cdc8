import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tabmill.llm import language_model as lm


def words_of(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x20\x09-\x0d]+", lowered)


def brute(rows):
    """The same model from dictionaries of words."""
    train = [r for r in rows if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 != 2]
    uni, pairs = Counter(), Counter()
    for _, t in train:
        seq = [*words_of(t), "</s>"]
        uni.update(seq)
        pairs.update(zip(["<s>", *seq], seq))
    before, after, total = Counter(b for _, b in pairs), defaultdict(Counter), Counter()
    for (a, _), n in pairs.items():
        after[a][min(n, 3)] += 1
        total[a] += n
    d = lm.discounts([sum(n == i for n in pairs.values()) for i in (1, 2, 3, 4)])
    d0 = lm.discounts([sum(n == i for n in before.values()) for i in (1, 2, 3, 4)])
    size, n_pairs, n_all = len(uni), len(pairs), sum(uni.values())
    mass = sum(d0[i - 1] * sum(min(n, 3) == i for n in before.values()) for i in (1, 2, 3)) / n_pairs
    cut = lambda n, by: max(n - (by[min(n, 3) - 1] if n else 0), 0)
    out = []
    for doc, t in rows:
        seq = [*words_of(t), "</s>"]
        score = base = 0.0
        for a, b in zip(["<s>", *seq], seq):
            lower = cut(before[b], d0) / n_pairs + mass / (size + 1)
            p = lower
            if total[a]:
                p = cut(pairs[a, b], d) / total[a] + sum(d[i - 1] * after[a][i] for i in (1, 2, 3)) / total[a] * lower
            score += math.log10(p)
            base += math.log10((uni[b] + 1) / (n_all + size + 1))
        out.append((doc, len(seq), sum(uni[b] > 0 for b in seq), n_all, base, score))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lm.held_out_scores(df).collect()
    got = sorted((tuple(r)[:1] + tuple(r)[2:] for r in found), key=str)
    for a, b in zip(got, sorted(brute(rows), key=str), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)
    return found


def test_equals_dictionaries_of_words(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = check(spark, [tuple(r) for r in docs])
    held = [r for r in found if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_several_ranges_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "RANGE_BYTES", 300)
    rows = [(i, f"The the the a{i % 5} B{i % 3} the c{i}") for i in range(60)]
    rows += [(3, None), (4, ""), (5, " \t\n"), (6, "é É  x"), (None, "the a1 b1"), (7, "w " * 5000), (7, "w " * 5000)]
    check(spark, rows)


def test_probabilities_add_up_to_one(spark):
    import numpy as np

    texts = spark.createDataFrame([("a b a c",), ("a b b",), ("c a b",), ("d",)], "text string")
    model = lm.fit(texts)
    every = np.arange(-1, model.words)
    end = model.numbers(np.array([lm.END]))[0]  # the only token that nothing follows
    for before in set(range(model.words)) - {end}:
        p = [10 ** model.log10(np.array([before, w]), np.array([0, 2]))[1] for w in every]
        assert sum(p) == pytest.approx(1)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.held_out_scores(empty).count() == 0
    odd = spark.createDataFrame([(1, "a b", 5, 0.5, "x"), (9, "a", 6, 0.5, "y")], "doc_id bigint, text string, n_tokens int, score double, part string")
    assert sorted(lm.held_out_scores(odd).columns) == sorted(["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    assert lm.held_out_scores(odd).count() == 2


def test_needs_a_path_that_workers_map():
    with pytest.raises(ValueError):
        lm._local("hdfs://host/folder")
