"""Context-tree weighting against a plain recursive tree."""

import math
import zlib
from collections import defaultdict
from itertools import pairwise

import numpy as np
import pytest

from tidemark.llm import ctw
from tidemark.llm.queries import QUERIES
from tidemark.llm.registry import remainder_is_zero

SMALL = "/root/testdata/sf0.001"


class PlainTree:
    """One dictionary of counts per context and decision."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.children = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for text in texts:
            for context, byte in self.symbols(text):
                for node, bit in self.decisions(byte):
                    for d in range(depth + 1):
                        self.counts[context[:d], node][bit] += 1
                        if d:
                            self.children[context[: d - 1], node].add(context[:d])
        self.memory = {}

    def symbols(self, text):
        data = b"\xff" * self.depth + text + b"\xff"
        for i in range(self.depth, len(data)):
            yield data[i - self.depth : i][::-1], data[i]

    @staticmethod
    def decisions(byte):
        node = 1
        for level in range(7, -1, -1):
            bit = byte >> level & 1
            yield node, bit
            node = node * 2 + bit

    def kt(self, a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(self, context, node):
        if (context, node) not in self.memory:
            own = self.kt(*self.counts[context, node])
            if len(context) == self.depth:
                self.memory[context, node] = own
            else:
                below = sum(self.weighted(c, node) for c in self.children[context, node])
                self.memory[context, node] = math.log(0.5) + np.logaddexp(own, below)
        return self.memory[context, node]

    def one(self, context, node, d=0):
        here = context[:d]
        if (here, node) not in self.counts:
            return 0.5
        zeros, ones = self.counts[here, node]
        own = (ones + 0.5) / (zeros + ones + 1)
        if d == self.depth:
            return own
        weight = math.exp(math.log(0.5) + self.kt(zeros, ones) - self.weighted(here, node))
        return weight * own + (1 - weight) * self.one(context, node, d + 1)

    def score(self, text):
        total = 0.0
        for context, byte in self.symbols(text):
            for node, bit in self.decisions(byte):
                p = self.one(context, node)
                total += math.log10(p if bit else 1 - p)
        return total


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 3, 10.5, 1e6, 1e12])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("depth,block", [(2, 60), (4, 1 << 20), (5, 100)])
def test_scores_are_those_of_a_plain_tree(spark, depth, block):
    texts = ["abracadabra", "abra cadabra", "", None, "the cat the hat é", "zzzz", "the cat the hat é"]
    frame = spark.createDataFrame(
        [(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, block string"
    )
    got = {r.doc_id: r for r in ctw.score(
        frame, frame.doc_id % 3 == 2, depth=depth, block_bytes=block, together=2
    ).collect()}
    plain = [(t or "").encode() for t in texts]
    tree = PlainTree([t for i, t in enumerate(plain) if i % 3 != 2], depth)
    assert len(got) == len(texts)
    for i, text in enumerate(plain):
        assert got[i].score == pytest.approx(tree.score(text), rel=1e-6), i  # 32-bit parts
        assert got[i].held_out == (i % 3 == 2)


def test_chances_of_all_bytes_sum_to_one(spark):
    random = np.random.default_rng(3)
    data = random.integers(97, 103, 3000).astype(np.uint8)
    grams, _ = ctw._grams(np.concatenate([np.full(3, 255, np.uint8), data]), np.array([0, 3003]), 3)
    keys, counts = np.unique(grams, return_counts=True)
    context = keys[17] & ~np.uint64(255)
    every = np.union1d(keys, context + np.arange(256, dtype=np.uint64))
    all_counts = np.zeros(len(every), np.int64)
    all_counts[np.searchsorted(every, keys)] = counts
    nodes = np.arange(256, 65536)
    tree = ctw.Subtree(every, all_counts, 3)
    total = np.zeros((3, 65536))
    for level in range(8):
        ids, zeros, ones, weighted, _ = tree.nodes[2, level]
        for line, value in enumerate((zeros, ones, weighted)):
            total[line] += np.bincount(ctw._drop_byte(ids).astype(int), value, 65536)
    nodes = np.flatnonzero(total[0] + total[1])
    top = ctw.Top(nodes, *(t[nodes] for t in total))
    scores = ctw.gram_scores(every, all_counts, 3, top)
    here = (every & ~np.uint64(255)) == context
    assert (10 ** scores[here]).sum() == pytest.approx(1)


def test_query_base_columns(spark):
    got = {r.doc_id: r for r in QUERIES["op1_ctw_score"](spark, SMALL).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(texts)
    lower = bytes(range(256)).lower()

    def tokens(text):
        data = text.encode().translate(bytes(range(65)) + lower[65:91] + bytes(range(91, 256)))
        for white in b"\t\n\v\f\r":
            data = data.replace(bytes([white]), b" ")
        return [w for w in data.split(b" ") if w] + [b""]

    counts = defaultdict(int)
    for i, text in texts.items():
        if zlib.crc32(str(i).encode()) % 10:
            for token in tokens(text):
                counts[token] += 1
    total, distinct = sum(counts.values()), len(counts)
    scores = bases = 0.0
    for i, text in texts.items():
        row, words = got[i], tokens(text)
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        assert row.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert row.n_tokens == len(words) and row.train_tokens == total
        assert row.n_known == sum(w in counts for w in words)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score < 0


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ctw.score(empty, remainder_is_zero("doc_id", 10)).count() == 0
    rows = [(None, "x"), (None, None), (7, "same"), (7, "same"), (8, "long " * 30_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = ctw.score(frame, remainder_is_zero("doc_id", 10)).collect()
    assert len(got) == 5 and sum(r.doc_id == 7 for r in got) == 2
    assert all(a.score == b.score for a, b in pairwise([r for r in got if r.doc_id == 7]))
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert [r.bits_per_byte for r in got if r.n_bytes == 0] == [None]
    untrained = ctw.score(frame, frame.doc_id != 0).where("doc_id = 7").first()
    assert untrained.train_tokens == 3  # the two rows without an id
