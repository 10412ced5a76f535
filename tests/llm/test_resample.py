"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import resample
from tidemark.llm.queries import QUERIES

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    raw = (text or "").encode()
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in raw))
    return words, words + [a + b" " + b for a, b in zip(words, words[1:])]


def plain(documents, target, buckets=10_000, percent=25, least=20):
    """{position: (n_features, weight, score, rank)} of a list of (id, text)."""
    every = [plain_features(t) for _, t in documents]
    corpus = Counter(zlib.crc32(f) % buckets for _, fs in every for f in fs)
    wanted = Counter(zlib.crc32(f) % buckets for t in target for f in plain_features(t)[1])
    s_all, t_all = sum(corpus.values()), sum(wanted.values())

    def gain(b):
        ratio = (wanted[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets))
        return math.floor(1000 * math.log(ratio))

    out, may = {}, []
    for i, ((key, _), (words, features)) in enumerate(zip(documents, every)):
        weight = sum(gain(zlib.crc32(f) % buckets) for f in features) // len(features) if features else 0
        name = f"7:{'' if key is None else key}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(features), weight, score, None]
        if len(words) >= least:
            may.append(i)
    may.sort(key=lambda i: (-out[i][2], documents[i][0] is not None, documents[i][0]))
    for place, i in enumerate(may[: percent * len(may) // 100], 1):
        out[i][3] = place
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aAbé1 -~\n") | st.none() | st.text(max_size=20), max_size=5),
       st.lists(st.sampled_from([b"a", b"b", b"ab", b"1", "é".encode()]), unique=True), st.integers(0, 3))
def test_buckets_of_features(texts, head, paired):
    texts = [t and t.encode("utf-8", "ignore").decode() for t in texts]
    made = resample.make_head(head, 97, paired)
    bucket, doc, counts = resample.feature_buckets(pa.array(texts, pa.string()), made, 97)
    for i, text in enumerate(texts):
        words, features = plain_features(text)
        assert counts[i] == len(words)
        assert sorted(bucket[doc == i].tolist()) == sorted(zlib.crc32(f) % 97 for f in features)


def test_query_on_whole_table(spark):
    rows = QUERIES["op12_importance_resampling"](spark, SMALL).collect()
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = plain(documents, target)
    by_id = {documents[i][0]: tuple(v) for i, v in want.items()}
    assert len(rows) == len(by_id)
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in rows} == by_id
    assert sum(v[3] is not None for v in by_id.values()) > 20


@pytest.mark.parametrize("head", [0, 3, 500])
def test_any_head_gives_the_same_rows(spark, head):
    random = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(60)])
    documents = [(i % 70, " ".join(random.choice(words, random.integers(0, 60)))) for i in range(90)]
    documents += [(500, "one and the same " * 10)] * 30 + [(None, "x " * 30)] * 3 + [(501, None), (502, "")]
    target = [" ".join(random.choice(words[:9], 30)) for _ in range(5)]
    frame = spark.createDataFrame([(*d, "a") for d in documents], "doc_id long, text string, score string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(frame.repartition(7), goal, buckets=101, percent=60, head_words=head, sample_rows=9)
    want = plain(documents, target, 101, 60)
    key = lambda r: tuple((x is not None, x) for x in r)
    rows = sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got.collect()), key=key)
    assert rows == sorted(((documents[i][0], *v[:3]) for i, v in want.items()), key=key)
    drawn = [(r["rank"], r.doc_id, r.score) for r in got.collect() if r["rank"]]
    assert sorted(drawn) == sorted((v[3], documents[i][0], v[2]) for i, v in want.items() if v[3])


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, "word " * 30), (2, None)], "doc_id long, text string")
    got = resample.resample(frame.limit(0), frame)
    assert got.count() == 0 and got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    want = plain([(1, "word " * 30), (2, None)], [], percent=100)
    rows = resample.resample(frame, frame.limit(0), percent=100).collect()
    assert sorted((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows) == [
        (1, *want[0]), (2, *want[1])]
    smallint = frame.select(frame.doc_id.cast("smallint").alias("doc_id"), "text")
    assert resample.resample(smallint, frame).count() == 2
