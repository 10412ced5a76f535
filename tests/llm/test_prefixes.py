"""Token counts at every prefix against the library."""

import pyarrow as pa
import pytest
import sentencepiece
from conftest import SMALL
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import prefixes
from tidemark.llm.queries import QUERIES

ODD = st.text(st.sampled_from(list(" ▁ab'stheinr  \n\t\r01\x00é中日本語ы\U0001f600<s>/")), max_size=40)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=prefixes.default_model())


@pytest.fixture(scope="module")
def memory():
    return prefixes.Prefixes(prefixes.Vocabulary.load(prefixes.default_model()))


@settings(max_examples=300, deadline=None)
@example(["<s> </s> <unk> <0x0A>", " " * 40, "▁▁ a", None, ""])
@given(st.lists(ODD | st.text(max_size=30) | st.text("ethainos ", max_size=80), max_size=4))
def test_every_prefix_has_the_tokens_of_the_library(memory, library, texts):
    texts = [t and t.encode("utf-8", "ignore").decode() for t in texts]
    counts, offsets = memory.batch(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        text = text or ""
        want = [len(library.encode(text[:n])) for n in range(len(text) + 1)]
        assert counts[offsets[i] : offsets[i + 1]].tolist() == want
        for limit in (0, 1, 3, 10**9):
            longest = max(n for n, c in enumerate(want) if c <= limit)
            got = prefixes.longest_within(counts, offsets, limit)
            assert got[i] == longest


def test_long_stretches_without_a_border(memory, library):
    for text in ("a" * 3000, "the" * 1500, "▁" * 2000, "internationalization" * 100):
        counts, _ = memory.batch(pa.array([text]))
        for n in (len(text), len(text) - 1, len(text) // 2):
            assert counts[n] == len(library.encode(text[:n]))


def test_query_on_whole_table(spark, library):
    rows = QUERIES["op13_prefix_token_counts"](spark, SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        n = len(library.encode(text))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 4096)
        assert len(library.encode(text[: row.cut_chars])) <= 4096
        assert row.over_limit == (row.cut_chars < len(text))


def test_odd_rows_and_questions(spark, library):
    texts = [(1, None), (1, None), (None, "x y"), (2, ""), (3, "aé b" * 2000), (4, "the cat sat on the mat")]
    frame = spark.createDataFrame([(*t, 7) for t in texts], "doc_id long, text string, n_tokens int")
    model = prefixes.default_model()
    got = prefixes.count(frame, model, limit=5, keep_prefixes=True)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars", "prefix_tokens"]
    asked = got.select(
        "doc_id", "n_tokens", "cut_chars",
        prefixes.tokens_at(F.col("prefix_tokens"), 7).alias("seven"),
        prefixes.longest_prefix(F.col("prefix_tokens"), 3).alias("three"),
    )
    by_id = {}
    for row in asked.collect():
        by_id.setdefault(row.doc_id, []).append(tuple(row)[1:])
    assert by_id[1] == [(0, 0, None, 0)] * 2 and by_id[2] == [(0, 0, None, 0)]
    text = dict(texts)[4]
    seven, whole = len(library.encode(text[:7])), len(library.encode(text))
    three = max(n for n in range(len(text) + 1) if len(library.encode(text[:n])) <= 3)
    five = max(n for n in range(len(text) + 1) if len(library.encode(text[:n])) <= 5)
    assert by_id[4] == [(whole, five, seven, three)]
    assert by_id[3][0][0] == len(library.encode("aé b" * 2000))
    assert prefixes.count(frame.limit(0), model).count() == 0
    assert prefixes.count(frame.where("doc_id = 2"), model).first().n_bytes == 0
