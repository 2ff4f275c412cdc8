"""Chat formatting against its source, turn by turn."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabmill.llm import chat

SIGNS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[OUT]", "[ROLE]", "[/ROLE]", "[\\INST]", "<\\\\/s>", "[", "<", "\\", "]", " ", "\n", "é", "a"]
texts = st.lists(st.sampled_from(SIGNS), max_size=8).map("".join)
roles = st.one_of(st.sampled_from(["system", "user", "assistant", "tool", ""]), texts)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=5), st.booleans())
def test_every_conversation_comes_back(turns, begins):
    formatted, spans = chat.format_turns(turns, begins)
    back = chat.parse(formatted, begins)
    assert [t[:2] for t in back] == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@settings(max_examples=400, deadline=None)
@given(texts)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat.CONTROL.search(chat.escape(text))


def test_only_conflicting_turns_are_escaped():
    formatted, _ = chat.format_turns([("user", "[INSTR] a \\ b"), ("assistant", "</s>[\\INST]"), ("tool]", "x")])
    assert formatted == "<s>[INST] [INSTR] a \\ b [/INST][OUT] <\\/s>[\\\\INST] </s>[ROLE]tool][/ROLE] x </s>"


@pytest.mark.parametrize("text", ["", "x", "<s>x", "<s>[INST] a", "<s>[INST] a [/INST", "<s>[INST]a [/INST]", "<s>[INST] [/INST]", "<s>[OUT] a [/INST]", "<s> [INST] a [/INST]", "<s>[/INST] a [/INST]", "<s>[ROLE]x a </s>", "<s>[INST] a [/INST] "])
def test_what_does_not_follow_the_grammar(text):
    assert chat.parse(text) is None


def brute(rows):
    """rows: (conv_id, turn, role, text)."""
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    groups = {}
    for conv, *turn in sorted(rows, key=key):
        groups.setdefault(conv, []).append((turn[1] or "", turn[2] or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for conv, turns in groups.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        size = len(chat.format_turns(turns)[0])
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), size))
    return sorted(out, key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def odd():
    rng = random.Random(3)
    rows = [(i % 40, i // 40, rng.choice(["user", "assistant", "system", "tool", None]), "".join(rng.choices(SIGNS, k=rng.randint(0, 9)))) for i in range(400)]
    rows += [(None, None, None, None), (None, 1, "user", "x"), (1, None, "user", None), (1, 0, "user", "twice"), (1, 0, "user", "twice")]
    rows += [(99, i, "assistant" if i % 2 else "user", f"{i} " + "long </s> text " * 3000) for i in range(30)]
    return rows


@pytest.mark.parametrize("piece", [chat.PIECE, 1, 50_000])
def test_digests_equal_the_source(spark, piece):
    rows = odd()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("piece", F.lit(1)).withColumn("formatted", F.lit("x"))
    pieces = chat.format_conversations(df, piece)
    assert sorted(map(tuple, chat.read_back(pieces, in_order=True).collect()), key=str) == brute(rows)
    if piece > 1:
        assert sorted(map(tuple, chat.read_back(pieces.repartition(5)).collect()), key=str) == brute(rows)


def test_long_conversations_are_cut(spark):
    pieces = chat.format_conversations(spark.createDataFrame(odd(), SCHEMA), 50_000).where("conv_id = 99").collect()
    assert [p["piece"] for p in sorted(pieces)] == list(range(len(pieces))) and len(pieces) > 10
    assert all(len(p["formatted"]) < 50_000 + 100_000 for p in pieces)


def test_empty_table(spark):
    none = chat.format_conversations(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and chat.read_back(none, in_order=True).count() == 0
