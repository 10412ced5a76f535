"""Packing against the tokenizer library and the rules of a packing."""

import gc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm import texts as tx
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_tokenizer())


def check(rows, texts, tokenizer, length):
    """Every id lies in one piece; sequences are gapless and not too long. Returns the fill."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for piece in sorted(by_doc[doc], key=lambda r: r.start):
            assert (piece.start, piece.doc_tokens) == (at, len(ids)) and piece.length > 0
            assert piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda r: r.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= length
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(r.length for r in rows) / (length * max(1, len(by_sequence)))


def test_query_packs_the_whole_table(spark, tokenizer):
    rows = QUERIES["op4_nnls_packing"](spark, SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert check(rows, texts, tokenizer, 2048) > 0.97


def test_odd_rows(spark, tokenizer):
    texts = {1: "", 2: "<|endoftext|> it's", 3: "word " * 3000, 4: "a b c", 5: "a b c", 6: "\n\n x"}
    data = [(i, t or None, "n") for i, t in texts.items()]
    frame = spark.createDataFrame(data, "doc_id long, text string, length string")
    rows = packing.pack(frame, packing.default_tokenizer(), length=16, lane_rows=2).collect()
    check(rows, texts, tokenizer, 16)
    none = packing.pack(frame.limit(0), packing.default_tokenizer())
    assert none.count() == 0 and none.columns[0] == "doc_id"
    twice = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string")
    assert packing.pack(twice, packing.default_tokenizer()).count() == 2


def test_ids_follow_the_library_across_neighbours_and_specials(tokenizer):
    texts = ["it'", "s ok", "'", "t", None, "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x'l", "l"]
    ids, counts = packing.Ids(packing.default_tokenizer()).batch(pa.array(texts, pa.string()))
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert want[5] == [64, 220, 50256, 275]


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_piece_once(seed):
    random = np.random.default_rng(seed)
    counts = np.zeros(129, np.int64)
    lengths = random.integers(1, 129, random.integers(1, 60))
    counts[lengths] = random.integers(1, 2000, len(lengths))
    left = counts.copy()
    for pieces, times in packing.plan(counts):
        assert sum(pieces) <= 128 and times > 0
        for piece in pieces:
            left[piece] -= times
    assert not left.any()


def test_plan_of_matching_lengths_wastes_nothing():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 25, 75, 50]] = 1000, 1000, 700, 700, 500
    used = packing.plan(counts)
    assert sum(n for _, n in used) == 1950


def test_least_squares_matches_a_small_exact_case():
    counts = np.zeros(11, np.int64)
    counts[[4, 6, 5]] = 10, 10, 8
    rows = packing.fillings(counts)
    amount = packing.solve(rows, counts)
    found = {tuple(r): a for r, a in zip(rows.tolist(), amount)}
    assert found[6, 4, 0] == pytest.approx(10, abs=0.2)
    assert found[5, 5, 0] == pytest.approx(8, abs=4.1)


def test_a_worker_drops_what_a_former_operator_kept():
    rows = pa.record_batch({"id": pa.array([1], pa.int64()), "text": ["some words"]})

    def held():
        gc.collect()
        return sum(isinstance(o, packing.Ids) for o in gc.get_objects())

    for _ in range(2):  # kept from task to task
        list(packing.cut_batches(iter([rows]), packing.default_tokenizer(), 2048, 1))
    assert held() == 1
    list(tx.slices(iter([rows])))
    assert held() == 0
