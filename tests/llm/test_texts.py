import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabmill.llm import graph, licenses, packing, registry, toxicity
from tabmill.llm.hashing import Words, from_planes, planes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x1c\x85é\U0001f600", max_size=30)), max_size=8)


@settings(max_examples=200, database=None, deadline=None)
@given(texts, st.booleans())
def test_words_are_those_of_the_bytes(rows, lower):
    words = Words(pa.array([None, *rows, "tail"], pa.string()).slice(1, len(rows)), lower)
    fold = lambda b: b.lower() if lower else b  # noqa: E731  bytes.lower only changes A-Z
    expected = [fold((r or "").encode()).split() for r in rows]
    assert words.count.tolist() == [len(e) for e in expected]
    flat = [w for e in expected for w in e]
    by_hash: dict = {}
    for w, h in zip(flat, words.hash.tolist(), strict=True):
        assert by_hash.setdefault(h, w) == w
    assert len(by_hash) == len(set(flat))
    hashes, at = words.shingles(2)
    rows_of = words.rows()
    assert len(hashes) == sum(max(0, len(e) - 1) for e in expected) and all(rows_of[at] == rows_of[at + 1])


def test_long_words_and_planes():
    long = "x" * (3 << 20)
    words = Words(pa.array([f"{long} a {long}", "a"], pa.string()))
    assert words.hash[0] == words.hash[2] and words.hash[1] == words.hash[3] != words.hash[0]
    values = np.array([1, 2**40, 2**63], np.uint64)
    assert from_planes(planes(values), np.uint64).tolist() == values.tolist()


def test_components(spark):
    pairs = [(i + 1, i) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    found = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == dict.fromkeys(range(41), 0) | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_take_few_tasks(spark):
    """A small graph takes few tasks, however many partitions there are."""
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    pairs = [(10 * i + j, 10 * i) for i in range(300) for j in range(1, 8)] + [(10 * i + 7, 10 * i + 12) for i in range(0, 300, 3)]
    links = spark.createDataFrame(pairs, "a bigint, b bigint").coalesce(1)
    tracker = spark.sparkContext.statusTracker()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("components", "")
        found = graph.components(links).collect()
        jobs = [tracker.getJobInfo(i) for i in tracker.getJobIdsForGroup("components")]
        tasks = sum(s.numCompletedTasks for s in map(tracker.getStageInfo, {k for j in jobs for k in j.stageIds}) if s)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == 2400
    assert {(r["id"], r["component"]) for r in found if r["id"] < 30} == {(10 * i + j, 20 if i == 2 else 0) for i in range(3) for j in range(8)}
    assert tasks < 800, tasks


ODD = ["á ́b", " x y ", "x\x1cy\x85z", "<|endoftext|> a<|startoftext|>", "it's we'RE '  s", "가 ᆨ", "İI ﬁ", "", "é" * 300 + " x", "Σς ΑΣ", "ª º µ ÿ Ÿ ǅ"]


@settings(max_examples=300, database=None, deadline=None)
@given(st.text(alphabet="ab '’s!1 \t\ńé<|>\xad\xa0Σςİǅªµ", max_size=40))
def test_encoding_equals_the_tokenizer(text):
    encoder = packing._encoder(TOKENIZER)
    for t in (text, *ODD):
        assert encoder.encode(t) == np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=200, database=None, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_decreasing_equals_search_over_all_bins(lengths):
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms[rooms.index(min(fits))] -= n
        else:
            rooms.append(20 - n)
    bins, offsets = packing.best_fit_decreasing(np.array(lengths, np.int64), 20)
    used: dict = {}
    for n, b, o in sorted(zip(lengths, bins.tolist(), offsets.tolist()), key=lambda x: x[1:]):
        assert used.get(b, 0) == o
        used[b] = o + n
    assert sorted(20 - u for u in used.values()) == sorted(rooms)


@pytest.mark.parametrize("shard", [8000, 40])
def test_packing(spark, sf, shard):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10**6, None), (None, ""), (10**6 + 1, "a " * 9000), (10**6 + 1, "a " * 9000)], docs.schema))
    rows = packing.pack(packing.tokenize(docs, TOKENIZER), shard_pieces=shard).collect()
    encoder = packing._encoder(TOKENIZER)
    want = []
    for r in docs.collect():
        ids = [*encoder.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for piece, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a : a + 4096], "<u4").tobytes()
            want.append((r["doc_id"], piece, a, len(part) // 4, zlib.crc32(part), part))
    assert sorted([tuple(r)[:6] for r in rows], key=str) == sorted(want, key=str)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert len(sequences) <= least * 1.05 + 2


def test_packing_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(packing.tokenize(empty, TOKENIZER).drop("ids")).count() == 0


def test_gradients_equal_differences():
    net = toxicity.Network(3)
    inputs = toxicity.Inputs(pa.array(["a bb ccc dd", "x a", "", "bb bb x ccc a"]))
    windows, text = inputs.windows()
    labels, weight = np.array([1, 0, 1, 0], np.float32), np.ones(4, np.float32)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}

    def loss():
        x = net.features(inputs)[0]
        z = net.forward(net.feeds(x), windows)
        return float(np.mean(np.log1p(np.exp(-np.where(labels == 1, z, -z)))))

    found = net.gradients(inputs, windows, labels, weight)
    rng = np.random.default_rng(0)
    for name in ("inf", "inb", "bf", "uf", "ub", "att", "out", "bias"):
        flat = net.w[name].reshape(-1)
        for i in rng.choice(flat.size, min(4, flat.size), replace=False):
            kept, step = flat[i], 1e-2
            flat[i] = kept + step
            up = loss()
            flat[i] = kept - step
            down = loss()
            flat[i] = kept
            assert found[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_windows_cover_every_word():
    inputs = toxicity.Inputs(pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 47, 48, 49, 88, 89, 500)]))
    windows, text = inputs.windows()
    for row, n in enumerate(inputs.count):
        assert set(windows[text == row].ravel().tolist()) - {-1} == set(inputs.word[inputs.first[row] : inputs.first[row + 1]].tolist())


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = registry.op1_toxicity(spark, sf).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    true = sum(p and y for p, y in held)
    assert true / max(1, sum(y for _, y in held)) >= 0.9 and true / max(1, sum(p for p, _ in held)) >= 0.9


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, f"fine words here {i}" if i % 2 else f"nasty{i % 7} vile words", "x") for i in range(60)] + [(None, None, "y"), (61, "", "z"), (61, "", "z")], "doc_id bigint, text string, toxic string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(50)] + [(None, 1), (3, None), (999, 0), (4, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model, ["doc_id", "text"]).collect()
    assert len(out) == 63
    assert all((r["toxicity"] >= 0.5) == r["text"].startswith("nasty") for r in out if r["text"])
    assert toxicity.fit(docs, labels.limit(0)) == 0.0 and toxicity.fit(docs, labels.where("toxic = 1")) == 1.0
    assert toxicity.score(docs.limit(0), 0.0, ["doc_id"]).count() == 0


def test_license_scan(spark):
    notice = licenses.TEMPLATES["GPL-header"]
    words = notice.split()
    rows = [
        (1, "pad " * 37 + notice + " tail" * 50, 1), (2, "pad " * 11 + " ".join(w for i, w in enumerate(words) if i != 12), 2), (3, " ".join(words[:15]), 3),
        (4, None, 4), (5, "", 5), (6, "RELEASED under the mit license", 6), (6, "RELEASED under the mit license", 6), (None, "x released under the MIT License. " * 3, 7), (8, "a " * 20000, 8),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, h int")
    got = {(r["doc_id"], r["template_id"]): (r["containment"], r["first_word"], r["n_windows"]) for r in licenses.scan(df, licenses.builtin_templates(spark)).collect()}
    assert set(got) == {(1, "GPL-header"), (2, "GPL-header"), (6, "MIT"), (None, "MIT")}
    assert got[1, "GPL-header"][0] == 1 and 0.8 <= got[2, "GPL-header"][0] < 1 and got[6, "MIT"] == (1, 0, 1)
    assert licenses.scan(df.limit(0), licenses.builtin_templates(spark)).count() == 0
    assert licenses.scan(df, licenses.builtin_templates(spark).limit(0)).count() == 0
    plan = licenses.scan(df, licenses.builtin_templates(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_license_lines(spark):
    rows = [
        (1, "some text. All rights reserved."), (2, "ALL rights\nreserved all rights reserved"), (3, "All rights are reserved."), (4, "all rights"), (5, None), (6, ""),
        (None, "all-rights-reserved"), (7, "Overall rights reserved"), (8, "Released under the MIT License. All rights reserved."), (9, licenses.TEMPLATES["rights-reserved"]), (9, "All rights reserved."),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = licenses.scan(df, licenses.builtin_templates(spark, short=True))
    got = {(r["doc_id"], r["template_id"]): (r["containment"], r["first_word"], r["n_windows"]) for r in found.collect()}
    short, once = "rights-reserved-short", lambda at: (1, at, 1)
    assert got == {(1, short): once(2), (2, short): (1, 0, 2), (None, short): once(0), (8, short): once(5), (8, "MIT"): once(0), (9, short): once(0), (9, "rights-reserved"): got[9, "rights-reserved"]}
    lone = spark.createDataFrame([("one", "Reserved!"), ("four", "some text all rights"), ("none", "..."), (None, "all rights"), ("null", None)], "template_id string, template string")
    got = {(r["doc_id"], r["template_id"], r["n_windows"]) for r in licenses.scan(df, lone).collect()}
    assert got == {(1, "one", 1), (2, "one", 2), (3, "one", 1), (None, "one", 1), (7, "one", 1), (8, "one", 1), (9, "one", 1), (1, "four", 1)}
    assert licenses.scan(df.limit(0), lone).count() == 0


def test_every_short_license_line_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    want = {r["doc_id"] for r in docs.where("text rlike '(?i)(^|[^\\\\p{L}\\\\p{N}])all[^\\\\p{L}\\\\p{N}]+rights[^\\\\p{L}\\\\p{N}]+reserved($|[^\\\\p{L}\\\\p{N}])'").collect()}
    found = licenses.scan(docs, licenses.builtin_templates(spark, short=True)).where("template_id = 'rights-reserved-short'")
    assert len(want) == 66 and {r["doc_id"] for r in found.collect()} == want


def test_toxic_words_are_found_at_every_place_and_next_to_signs():
    rng = np.random.default_rng(6)
    plain = [f"w{i}" for i in range(400)]
    texts, labels = [], []
    for i in range(600):
        words = rng.choice(plain, 60).tolist()
        if i % 3 == 0:
            words[rng.integers(0, 60)] = ["vileness", "##vileword", "vilely!!", "VILEST,"][i % 4]
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    net = toxicity.train(texts, labels, 1 / 3)
    clean = rng.choice(plain, 150).tolist()
    placed = [" ".join([*clean[:i], "***vileness...", *clean[i:]]) for i in range(150)]
    assert (net.scores(pa.array(placed)) >= 0.5).all() and net.scores(pa.array([" ".join(clean)]))[0] < 0.5
    # an own text's rates come from other folds, so a word of one text says nothing
    assert all(p >= 0 for p in net.scores(pa.array([None, "", "   ", "!!! ###", "x" * 100_000])))


def test_the_sample_is_bounded_by_bytes(spark):
    docs = spark.createDataFrame([(i, ("bad " if i % 2 else "good ") * (5 if i else 50_000)) for i in range(400)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, sample_bytes=2_000)
    scores = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert all((s >= 0.5) == (i % 2 == 1) for i, s in scores.items())
    assert toxicity.fit(docs, labels, sample_bytes=1) == 0.0


def test_learning_and_scoring_take_bounded_memory():
    rng = np.random.default_rng(4)
    vocabulary = [f"{i:x}word{i * 7919 % 99991}" for i in range(60_000)]
    texts = [" ".join(rng.choice(vocabulary, 4_000)) for _ in range(40)]
    size, net, labels = sum(map(len, texts)), toxicity.Network(), np.arange(len(texts)) % 2
    batch = pa.RecordBatch.from_pydict({"text": texts * 3})
    model = type("Broadcast", (), {"value": net})
    peaks = []
    for work in (lambda: toxicity._Part(texts, labels), lambda: [b.num_rows for b in toxicity._scored(model, [])(iter([batch]))]):
        tracemalloc.start()
        work()
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert max(peaks) < 64 * size, [p / size for p in peaks]


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_blocks_of_words_do_not_change_their_inputs(block, monkeypatch):
    texts = ["a bb (ccc) dd...", None, "", "!! bb x" + "y" * 40 + " ccc a", "é, bb !! A"]
    labels = np.array([1, 0, 1, 0, 1])
    whole, x = toxicity._Part(texts, labels), toxicity.Network(5).features(toxicity.Inputs(pa.array(texts)))[0]
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", block)
    part = toxicity._Part(texts, labels)
    for name in ("row", "gram", "gram_first", "sizes", "word"):
        assert np.array_equal(getattr(part.inputs, name), getattr(whole.inputs, name))
    assert np.array_equal(toxicity.Network(5).features(part.inputs)[0], x)
    # in how many texts each row occurs, text by text
    words, grams = np.zeros_like(whole.counts[0]), np.zeros_like(whole.counts[1])
    for text, label in zip(texts, labels):
        own = toxicity.Inputs(pa.array([text], pa.string()))
        words[label, np.unique(own.row)] += 1
        grams[label, np.unique(own.gram)] += 1
    assert np.array_equal(part.counts[0], words) and np.array_equal(part.counts[1], grams)
