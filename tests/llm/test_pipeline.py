"""The pipeline stage by stage against plain Python, and the registered queries against their SQL."""

import os
import sys


import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import check
import corpus_pipeline as pipeline
import test_mixing
import test_near_and_substring_dedup as dedup
import test_personal_data as personal

import __spark_entry__ as entry
from tabmill.llm import registry, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NAMES = ("op2_substring_dedup", "op3_near_dedup", "op4_license_scan", "op8_exact_top_k", "op10_mixing", "op11_chat_format", "op12_hard_negatives", "op13_merkle_manifest")


@pytest.fixture(scope="module")
def con(sf):
    return check.duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    found = [tuple(r) for r in df.collect()]
    assert check.compare(df.columns, found, *check.oracle_frame(con, entry.oracle_sql()[name])) is None


def test_registration():
    ours = set(registry.QUERIES) | {"pipeline"}
    assert ours <= set(entry.queries()) and set(registry.ORACLE) == set(NAMES)
    assert sorted(int(n.split("_")[0][2:]) for n in registry.QUERIES) == list(range(1, 14))


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}

    clean = pipeline.drop_toxic(spark, docs, sf).cache()
    assert clean.columns == COLUMNS
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    kept = {r["doc_id"] for r in clean.collect()}
    assert kept == {i for i, s in scores.items() if s < pipeline.TOXIC}
    assert len([i for i in kept if labels.get(i) == 0]) >= 0.95 * sum(y == 0 for y in labels.values())

    unique = pipeline.drop_near_copies(spark, clean, sf).cache()
    found = unique.collect()
    want = dedup.brute_components([(i, rows[i]["text"]) for i in sorted(kept)], 5)
    assert unique.columns == COLUMNS and sorted(r["doc_id"] for r in found) == [w[0] for w in want if w[3]]

    masked = pipeline.mask_personal_data(spark, unique, sf).cache()
    assert masked.columns == COLUMNS
    for r in masked.collect():
        before, after = rows[r["doc_id"]]["text"], r["text"]
        assert r["n_chars"] == len(after)
        assert not any(before[a:b] in after for _, a, b in personal.brute(before))
        assert personal.brute(before) or "[" in after or after == before

    mixed = pipeline.mix_sources(spark, masked, sf).cache()
    assert mixed.columns == COLUMNS
    lines = [(r["doc_id"], r["text"], f"d{len(r['source']) % 3}", r["lang"], r["source"]) for r in masked.collect()]
    budget = int(pipeline.MIX_SHARE * sum(len(dedup.words_of(x[1])) for x in lines))
    want = test_mixing.brute(lines, budget, 1, registry.MIX_WEIGHTS, registry.MIX_SEED, (2, 3, 4))
    assert sorted(r["doc_id"] for r in mixed.collect()) == [i for i, _ in want]

    packed = pipeline.pack_sequences(spark, mixed, sf).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in want}
    assert max(r["offset"] + r["length"] for r in packed) <= 4096


def test_stages_of_odd_and_empty_tables(spark, sf):
    rows = [(1, "a b c d e f", "en", "src1", 11), (1, "a b c d e f", "en", "src1", 11), (None, "x@y.org", None, None, None), (2, None, "de", "", 0), (3, "", None, "src2", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES[1:4]:
            out = stage(spark, table, sf)
            assert out.columns == COLUMNS and out.count() <= table.count()
        assert pipeline.STAGES[4][1](spark, table, sf).count() == table.count()


