"""Periodic runs against a search over all periods."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periods
from tidemark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every maximal stretch per period, the smallest period of each."""
    found = {}
    n = len(words)
    for period in range(1, n // 3 + 1):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end + period - start
            if end > start and length >= max(24, 3 * period):
                found.setdefault((start, length), period)
            start = end + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def runs_of(texts):
    """(start, length, period) of lists of small numbers, through one call."""
    sizes = np.array([len(t) for t in texts], np.int64)
    code = np.array([w for t in texts for w in t], np.int64)
    rows, bounds = periods.runs(code, sizes)
    return [[tuple(r) for r in rows[a:b].tolist()] for a, b in zip(bounds, bounds[1:])]


def planted(random, size, kinds):
    """Random words with stretches of one period, some within others."""
    words = random.integers(0, kinds, size).tolist()
    for _ in range(random.integers(1, 5)):
        start = int(random.integers(0, size))
        length = int(random.integers(1, size - start + 1))
        period = int(random.integers(1, max(2, length // 3 + 1)))
        for i in range(start + period, start + length):
            words[i] = words[i - period]
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), min_size=1, max_size=4))
def test_short_texts(texts):
    assert runs_of(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("seed", range(40))
def test_planted_stretches(seed):
    random = np.random.default_rng(seed)
    texts = [planted(random, int(random.integers(1, 1500)), int(random.choice([1, 2, 3, 50, 10_000])))
             for _ in range(3)]
    assert runs_of(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("inner", [1, 2, 7, 31, 70])
def test_runs_within_the_period_of_a_run(inner):
    """Long periods that hold short runs, so that most grams are periodic themselves."""
    random = np.random.default_rng(inner)
    for period in (64, 65, 127, 128, 129, 200, 243, 500):
        block = [int(w) for w in np.resize(random.integers(0, 3, inner), period - 1)] + [9]
        words = [7, 8] + (block * 4)[: 3 * period + 5] + [5, 6]
        assert runs_of([words]) == [plain_runs(words)]


def test_words_of_fibonacci_and_every_period_have_a_scale():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert runs_of([b]) == [plain_runs(b)]
    for most in (64, 100, 1000, 100_000):
        spans = periods.scales(most)
        for period in range(periods.FIRST_PERIOD, most + 1, 1 if most < 5000 else 37):
            assert any(s // 2 <= period <= s - g // 4 for s, g in spans)
        for span, gram in spans:
            assert span % 2 == 0 and 24 <= gram <= span // 4 and 4 * (gram // 4) <= gram


def changed(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_on_whole_table(spark):
    rows = QUERIES["op11_periodic_runs"](spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts) and sum(r.n_runs > 0 for r in rows) > 10
    for row in rows:
        words = changed(row.doc_id, texts[row.doc_id])
        want = plain_runs(words)
        dropped = {i for s, n, p in want for i in range(s + p, s + n)}
        left = " ".join(w for i, w in enumerate(words) if i not in dropped)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in want)
        assert row.n_runs == len(want)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
        got = (row.start, row.length, row.period, row.exponent_milli)
        if not want:
            assert got == (None,) * 4
            continue
        top = max(n / p for _, n, p in want)
        s, n, p = min(r for r in want if r[1] / r[2] == top)
        assert got == (s, n, p, 1000 * n // p)


def test_odd_rows(spark):
    texts = [(1, None), (1, None), (None, "a " * 30), (2, ""), (3, " \n\t"), (4, "x\ty\n" * 200_000),
             (5, "one two three"), (6, "é ü " * 12 + "end")]
    frame = spark.createDataFrame([(*t, 7) for t in texts], "doc_id long, text string, runs int").coalesce(1)
    got = {}
    for r in periods.find(frame).collect():
        got.setdefault(r.doc_id, []).append(([tuple(x) for x in r.runs], r.n_words, r.collapsed))
    assert got[1] == [([], 0, "")] * 2 and got[2] == got[3] == [([], 0, "")]
    assert got[None] == [([(0, 30, 1)], 30, "a")]
    assert got[4] == [([(0, 400_000, 2)], 400_000, "x y")]
    assert got[5] == [([], 3, "one two three")]
    assert got[6] == [([(0, 24, 2)], 25, "é ü end")]
    assert periods.find(frame.limit(0)).count() == 0
