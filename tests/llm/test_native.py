"""Chat formatting and quality rules, against plain code and SQL."""

import hashlib
import re

import compare
import pytest
from conftest import SMALL, plan
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat, rules
from tidemark.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_conversations(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        found.setdefault(conv, []).append((role or "", text or ""))
    return {
        conv: (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)),
               len("".join(t for r, t in turns if r == "assistant")),
               sha("".join(t for r, t in turns if r == "assistant")))
        for conv, turns in found.items()
    }


def test_conversations_read_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    odd = "\\### Assistant: </turn> ok"
    want = plain_conversations([*rows, (-7, 0, "user", odd), (-7, 1, "assistant", odd)])
    frame = QUERIES["op5_chat_format"](spark, SMALL)
    assert not re.search("Python|Pandas|Arrow", plan(frame))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect()}
    assert got == want


MARKS = st.lists(
    st.sampled_from([*"<|\\>\n té", "<|end|>\n", "<|text|>", "<|role|>"]), max_size=12
).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4),
                          st.sampled_from(["user", "assistant", "<|end|>", None]),
                          MARKS | st.none()), min_size=1, max_size=25))
def test_any_text_reads_back(spark, rows):
    frame = spark.createDataFrame(
        [(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, key string"
    )
    out = chat.format_turns(frame).select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), "n_blocks",
    )
    got = {}
    for r in out.collect():
        got[r.conv_id] = (len(r.turns), sha("".join(f"{t.role}\n{t.text}\n" for t in r.turns)),
                          len(r.loss), sha(r.loss))
        blocks = 1 + sum(a.role != b.role for a, b in zip(r.turns, r.turns[1:]))
        assert r.n_blocks == blocks
    assert got == plain_conversations(rows)


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.format_turns(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, "user", "a"), (None, 1, "assistant", "b" * 100_000), (None, 1, "assistant", "c")]
    row = chat.format_turns(spark.createDataFrame(rows, schema)).first()
    assert row.n_blocks == 2 and row.formatted.startswith("<|role|>user<|text|>a<|end|>\n")
    assert [row.formatted[s.start : s.end] for s in row.loss_spans] == ["b" * 100_000, "c"]


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(covered))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é#", "\n", "\t", "\x0b", "x y", "\n\n"]), max_size=40)
                .map(" ".join) | st.none(), min_size=1, max_size=20))
def test_measures(spark, texts):
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, m int")
    got = {r.doc_id: tuple(r)[1:7] for r in rules.judge(frame).collect()}
    assert got == {i: plain_measures(t) for i, t in enumerate(texts)}


def test_quality_query_matches_sql(spark):
    frame = QUERIES["op9_quality_cascade"](spark, SMALL)
    assert not re.search("Python|Pandas|Arrow", plan(frame))
    database = compare.database(SMALL)
    assert compare.difference(frame, database, ORACLES["op9_quality_cascade"]) is None


def test_order_follows_rejection_per_cost(spark):
    rows = spark.range(1000).select(F.col("id").alias("n"))
    never = rules.Rule("never", F.col("n") < 0)
    often = rules.Rule("often", F.col("n") >= 10)
    assert [r.name for r in rules.ordered(rows, [never, often])] == ["often", "never"]
    names = rows.select(rules.first_rejection([often, never]).alias("by")).groupBy("by").count().collect()
    assert {r.by: r["count"] for r in names} == {"often": 990, None: 10}


def test_the_cascade_gives_the_verdicts_of_all_rules(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = {r.doc_id: r.kept for r in rules.judge(documents).collect()}
    frame = rules.judge(documents, with_measures=False)
    assert frame.columns == ["doc_id", "rejected_by", "kept"]
    assert not re.search("Python|Pandas|Arrow", plan(frame))
    assert {r.doc_id: r.kept for r in frame.collect()} == whole
    assert len(set(whole.values())) == 2


def test_a_dear_rule_of_equal_selectivity_comes_last(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    frame = spark.range(300).select(F.concat(F.lit(text), F.col("id")).alias("text"))
    dear = rules.Rule("dear", F.col("n_repeat_words") >= 0)
    cheap = rules.Rule("cheap", F.length("text") > 0)
    assert [r.name for r in rules.ordered(frame, [dear, cheap])] == ["cheap", "dear"]


def test_the_sample_is_cut_ahead_of_the_measures(spark):
    frame = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    sample = rules.sampled(frame, "doc_id", "text", 500)
    assert sample.count() == 500 and sample.columns == ["text"]
    assert rules.sampled(frame.limit(7), "doc_id", "text", 500).count() == 7
    same = frame.select(F.lit(1).alias("doc_id"), F.lit("x").alias("text"))
    assert rules.sampled(same, "doc_id", "text", 500).count() in (0, 500)


@pytest.mark.parametrize("n", [0, 1])
def test_odd_quality_rows(spark, n):
    rows = [(None, None), (1, ""), (1, ""), (2, "w " * 30_000), (3, " ".join(f"w{i}" for i in range(60)))]
    frame = spark.createDataFrame(rows[: 5 * n], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.kept) for r in rules.judge(frame).collect()}
    assert got == ({None: (0, False), 1: (0, False), 2: (30_000, False), 3: (60, True)} if n else {})
