import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabmill.llm import personal_data as pd_

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def check(spark, texts):
    rows = pd_.report(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest(), (texts[r["doc_id"]], want, r)
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(w[0] == k for w in want) for k in PLAIN]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))
    return rows


ODD = [
    None, "", " ", "a@b.c_d@e.f", "a@b.c.@d.e", "x@y", "a@b..c d@e.f.", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.02.3.255", "é😀 a@b.co 4111 1111 1111 1111",
    "4111-1111-1111-1111 2", "41111111111111112", "+1 (656) 555-6510 +1", "+12", "++1234567890-", "+1234567 .", "+1.2.3.4 1.2.3.4", "a@b.c" * 50,
    "0 " * 3000, "7" * 40000, "a" * 40000 + "@b.c", "x@" + "a." * 800 + "b", "name(at)host.com", "call (212) 555-0100 now", "a@b.c\na@b.c\x01",
]


def test_base_spans_of_odd_texts(spark):
    check(spark, ODD)


def test_base_spans_of_random_texts(spark):
    pool: list[str] = []

    @settings(max_examples=400, database=None, deadline=None)
    @given(st.text(alphabet="ab1@._%+- ()0259é\U0001f600", max_size=40))
    def gather(text):
        pool.append(text)

    gather()
    check(spark, pool)


def test_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    rows = check(spark, [r["text"] for r in docs])
    assert sum(r["n_email"] + r["n_phone"] for r in rows) > 0


def test_votes_tell_real_from_unreal():
    yes, no = (1, 1, 1, 1), (-1, -1, 0, -1)
    patterns = [(yes, 0, 50.0), ((1, 1, 0, 1), 0, 40.0), (no, 0, 60.0), ((-1, -1, -1, 1), 0, 30.0), ((0, 1, 1, 1), 0, 4.0)]
    belief = pd_.estimate(patterns)
    assert belief[yes, 0] > 0.9 and belief[no, 0] < 0.1 and belief[(0, 1, 1, 1), 0] > 0.5
    weight = pd_.classifier(patterns, belief)
    assert weight["gazetteer1"] > weight["gazetteer-1"]
    assert pd_.estimate([]) == {} and pd_.classifier([], {})["one"] < 0


def test_loose_spans_are_added_and_masked(spark):
    texts = [f"contact us: user{i}@mail{i}.com or call +1 212 555 01{i:02d}" for i in range(40)] + ["mail jo (at) home.org today", "v1.2.3.4444 is out"]
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id bigint, text string, base string, spans int")
    rows = {r["doc_id"]: r for r in pd_.report(df).collect()}
    assert rows[40]["spans"] == "email:5:21" and rows[40]["n_email"] == 0
    assert rows[41]["spans"] == ""


def test_masks(spark):
    df = spark.createDataFrame([(1, "to a@b.co, é +49 30 1234567!", "de"), (1, None, "de"), (2, "", None), (None, "1.1.1.1", "x")], "doc_id bigint, text string, lang string")
    got = sorted([tuple(r) for r in pd_.masked(df).collect()], key=str)
    assert got == sorted([(1, "to [email], é [phone]!", "de"), (1, None, "de"), (2, "", None), (None, "[ip]", "x")], key=str)


def test_empty_table(spark):
    assert pd_.report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("kind", pd_.KINDS)
def test_no_python_in_the_plan(spark, kind):
    plan = pd_.candidates(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
