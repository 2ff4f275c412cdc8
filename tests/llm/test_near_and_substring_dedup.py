import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from tabmill.llm import near_dedup, substring_dedup


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def corpus(seed=3):
    """Clusters of near copies, chains of them, exact copies, shared passages and odd rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = [None, "", " \n", "one", "one two", "ONE  two", "one two three four", "one two three four five", "x " * 3000]
    line = [word() for _ in range(30)]
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(5, 160))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy[5:5] = line
            texts.append(" ".join(copy))
            base = copy if rng.random() < 0.4 else base
        texts += [texts[-1]] * rng.randrange(3)
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute_components(rows, size, threshold=80):
    lowered = {i: words_of((t or "").translate({c: c + 32 for c in range(65, 91)})) for i, t in rows}
    sets = {i: {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set() for i, w in lowered.items()}
    component = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(component[a], component[b])
            changed |= component[a] != low or component[b] != low
            component[a] = component[b] = low
    return sorted((i, len(sets[i]), component[i], component[i] == i) for i in sets)


def brute_removed(rows, size):
    owner = {}
    for i, t in sorted(rows):
        w = words_of(t)
        for j in range(len(w) - size + 1):
            owner.setdefault(tuple(w[j : j + size]), i)
    out = []
    for i, t in rows:
        w, gone = words_of(t), set()
        for j in range(len(w) - size + 1):
            if owner[tuple(w[j : j + size])] < i:
                gone |= set(range(j, j + size))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("size,short", [(4, 16), (5, 1)])
def test_components_equal_brute_force(spark, monkeypatch, size, short):
    monkeypatch.setattr(near_dedup, "SHORT", short)  # 1: all open lists in blocks
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    monkeypatch.setattr(near_dedup, "SHARD", 10)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in near_dedup.near_duplicates(df, size).collect())
    assert got == brute_components(rows, size)


def test_near_copies_of_odd_rows(spark):
    rows = [(1, "a b c d e f", 1, "x"), (1, "a b c d e f", 1, "x"), (None, "a b c d e f", 2, "y"), (3, "A B c d E f", None, None), (4, None, 0, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int, mark string")
    got = sorted(map(tuple, near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (3, 2, 1, False), (4, 0, 4, True)], key=str)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("short", [16, 1])
def test_documents_of_several_texts_equal_brute_force(spark, monkeypatch, short):
    """A document is linked by any of its texts."""
    monkeypatch.setattr(near_dedup, "SHORT", short)
    monkeypatch.setattr(near_dedup, "SHARD", 10)
    rng = random.Random(4)
    rows = [(i if rng.random() < 0.6 else rng.randrange(40), t) for i, t in corpus(11)]
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows += [(900, a), (900, b), (901, a + " tail"), (902, b + " tail"), (903, b + " c " + a), (904, a), (904, "alone in this text")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(df).collect()))
    alone = list(enumerate(t for _, t in rows))
    top = {i: i for i, _ in rows}
    changed = True
    while changed:  # join documents by the components of their texts
        changed = False
        for (j, _, c, _), (i, _) in zip(brute_components(alone, 5), rows):
            low = min(top[i], top[rows[c][0]])
            changed |= (top[i], top[rows[c][0]]) != (low, low)
            top[i] = top[rows[c][0]] = low
    want = sorted((i, n, top[i], top[i] == i) for (_, n, _, _), (i, _) in zip(brute_components(alone, 5), rows))
    assert got == want and top[901] == top[902] == 900


def test_settings_that_the_filters_do_not_fit(spark):
    df = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    for wrong in ({"threshold": 79}, {"threshold": 101}, {"k": 20}):
        with pytest.raises(ValueError):
            near_dedup.near_duplicates(df, **wrong)


@pytest.mark.parametrize("size", [13, 4])
def test_removed_words_equal_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 3000)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 2000)
    rows = corpus(7)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = substring_dedup.remove_repeated_passages(df, size).collect()
    assert sorted((r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in got) == brute_removed(rows, size)


def test_removal_of_odd_rows(spark):
    line = " ".join(f"w{i}" for i in range(13))
    rows = [(5, f"é {line} ü", 1), (2, line.replace(" ", "\t"), 2), (None, line, 3), (2, line, 4), (7, line.upper(), 5), (-3, None, 6), (8, f"{line} {line}", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, shard int")
    got = sorted(map(tuple, substring_dedup.remove_repeated_passages(df).select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str)
    want = [(5, 15, 13, "é ü"), (2, 13, 0, line), (None, 13, 0, line), (2, 13, 0, line), (7, 13, 0, line.upper()), (-3, 0, 0, ""), (8, 26, 26, "")]
    assert got == sorted(want, key=str)
    assert substring_dedup.remove_repeated_passages(df.limit(0)).count() == 0


@pytest.mark.parametrize("buckets", [1, 5, 255, 70_000, 2**24, 2**25])
def test_windows_alike_in_40_bits_keep_their_own_owners(monkeypatch, buckets):
    high = {b"a": 0, b"b": buckets if buckets < 2**24 else 1, b"c": 2**24 - 1}
    text = pa.array(["a", "b", "c", "b", "c"])
    hashes = np.array([high[t.encode()] * 2**40 + 7 for t in text.to_pylist()], np.uint64)
    monkeypatch.setattr(substring_dedup.Words, "shingles", lambda self, size: (hashes.copy(), np.arange(5)))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4, 5], pa.int64()), text], ["doc_id", "text"])
    table = pa.Table.from_batches(substring_dedup._windows(1, buckets)(iter([batch])))
    found = set()
    for number in set(table.column("bucket").to_pylist()):
        part = table.filter(pa.compute.equal(table.column("bucket"), number))
        for blob in substring_dedup._owners(1, substring_dedup._width(buckets))(part).column("owners").to_pylist():
            found |= set(np.frombuffer(blob, np.int64).tolist())
    assert found == {2, 3}
