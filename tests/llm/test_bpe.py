"""Splitting and encoding against the public libraries."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import example, given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe, pretokens
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATTERN = regex.compile(public_tokenizers.PATTERN)
ODD = st.text(st.sampled_from(list("ab'strvelmd  \n\t\r1²é中　\xa0_.!-\U0001f600")), max_size=40)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def known(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )


def split(text):
    column = pa.array([text, "", text], pa.string())
    codes, distinct, counts = pretokens.pieces(column)
    words = [distinct[i].as_py().decode() for i in codes]
    assert counts[1] == 0 and counts[0] == counts[2]
    return words[: counts[0]], words[counts[0] :]


def test_neighbouring_texts_share_no_piece(spark, known):
    texts = ["it'", "s ok", "m'", "m'", "'", "ll"]
    column = pa.array(texts, pa.string())
    codes, distinct, counts = pretokens.pieces(column)
    words = [distinct[i].as_py().decode() for i in codes]
    assert words == [p for t in texts for p in PATTERN.findall(t)]
    assert counts.tolist() == [len(PATTERN.findall(t)) for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in bpe.encode(frame, bpe.default_vocabulary()).collect()}
    for i, text in enumerate(texts):
        assert got[i].ids == known.encode_ordinary(text) and bytes(got[i].decoded).decode() == text


@settings(max_examples=400, deadline=None)
@example("m'")
@given(ODD | st.text(max_size=30))
def test_pieces_are_those_of_the_pattern(text):
    text = text.encode("utf-8", "ignore").decode()
    want = PATTERN.findall(text)
    assert split(text) == (want, want)


@settings(max_examples=150, deadline=None)
@given(st.lists(ODD | st.text("abcdehiorst", max_size=90) | st.text("a", max_size=200), max_size=4))
def test_ids_are_those_of_the_library(vocabulary, known, texts):
    memory = pretokens.PieceIds(vocabulary.encode_pieces)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, counts = memory.batch(pa.array(texts, pa.string()))
    want = [known.encode_ordinary(t) for t in texts]
    assert ids.tolist() == [i for one in want for i in one]
    assert counts.tolist() == [len(one) for one in want]
    assert vocabulary.decode(ids).tobytes() == "".join(texts).encode()


@pytest.mark.parametrize("leaf", [1, 2, 5, 16])
def test_any_leaf_length_gives_the_same_ids(vocabulary, known, leaf):
    random = np.random.default_rng(7)
    words = ["".join(random.choice(list("aehinorst"), n)) for n in random.integers(1, 300, 40)]
    words += ["a" * n for n in (1, 7, 33, 257)] + ["ab" * 90]
    got = vocabulary.encode_pieces([w.encode() for w in words], leaf)
    assert got == [known.encode_ordinary(w) for w in words]


def test_one_row_encoder_agrees(vocabulary, known):
    for text in ("antidisestablishmentarianism" * 5, "a" * 100, "中" * 40):
        assert vocabulary.encode_one(text.encode()) == known.encode_ordinary(text)


def test_query_on_whole_table(spark, known):
    rows = QUERIES["op10_byte_bpe"](spark, SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = np.array(known.encode_ordinary(texts[row.doc_id]), "<u4")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None, 5), (1, None, 5), (None, "x y", 6), (2, "", 7), (3, "a" * 50_000, 8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = {(r.doc_id, bytes(r.decoded)): r.n_tokens
           for r in bpe.encode(frame, bpe.default_vocabulary()).collect()}
    assert got[1, b""] == 0 and got[2, b""] == 0 and got[None, b"x y"] == 2
    assert (3, b"a" * 50_000) in got
    empty = bpe.encode(frame.limit(0), bpe.default_vocabulary())
    assert empty.columns == ["doc_id", "n_tokens", "ids", "decoded"] and empty.count() == 0
