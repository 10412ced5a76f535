"""Search, classifier and personal data against plain code."""

import re
import time
from itertools import product

import compare
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bm25, crf, nbsvm
from tidemark.llm.queries import ORACLES, QUERIES


def test_search_query_matches_sql(spark):
    frame = QUERIES["op2_block_max_search"](spark, SMALL)
    assert compare.difference(frame, compare.database(SMALL), ORACLES["op2_block_max_search"]) is None


def test_documents_as_queries(spark):
    frame = QUERIES["op2_document_search"](spark, SMALL)
    assert compare.difference(frame, compare.database(SMALL), ORACLES["op2_document_search"]) is None
    asked = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 20 = 0 AND length(trim(text)) > 0")
    assert frame.select("query_id").distinct().count() == asked.count() >= 10


def test_odd_searches(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "A  b c"), (5, "z " * 9000)]
    documents = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, rank int")
    queries = spark.createDataFrame([(1, "b a"), (2, None), (3, "q"), (4, "Z")], "item_id long, text string")
    got = [(r.item_id, r.doc_id, r["rank"]) for r in bm25.search(documents, queries, block=1).collect()]
    assert sorted(got, key=repr) == [(1, 3, 1), (1, 3, 2), (1, None, 3), (4, 5, 1)]
    assert bm25.search(documents.limit(0), queries).count() == 0


def some_texts(count):
    rng = np.random.default_rng(3)
    words = [f"w{int(i)}" for i in range(90)]
    return [" ".join(rng.choice(words, rng.integers(1, 90))) for _ in range(count)]


def test_parts_and_passes_change_no_row(spark):
    texts = some_texts(300)
    rows = [(i % 290, t) for i, t in enumerate(texts)] + [(None, texts[20]), (400, None), (401, texts[40])]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = [(i, t) for i, t in rows if i is None or i % 20 == 0] + [(20, texts[3]), (None, "w1 w2")]
    queries = spark.createDataFrame(asked, "item_id long, text string")
    once = bm25.search(documents, queries, k=3).collect()
    many = bm25.search(documents, queries, k=3, shard_bytes=100, query_bytes=3000).collect()
    assert len(once) == 3 * len({i for i, t in asked if t}) > 40
    assert sorted(map(tuple, many), key=repr) == sorted(map(tuple, once), key=repr)


def test_terms_are_counted_once_for_all_passes(spark, tmp_path):
    texts, seen = some_texts(40), str(tmp_path / "seen")

    def scan(batches):
        with open(seen, "a") as file:
            file.write("x")
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([texts[i] for i in batch["id"].to_pylist()])], names=["doc_id", "text"])

    documents = spark.range(0, 40, numPartitions=1).mapInArrow(scan, "doc_id long, text string")
    queries = spark.createDataFrame(list(enumerate(texts[:12])), "item_id long, text string")
    size = sum(len(t) + 64 for t in texts[:12])
    assert bm25.search(documents, queries, query_bytes=-(-size // 3)).count() == 120
    with open(seen) as file:
        assert len(file.read()) == 1 + 3  # twice a pass before


def test_only_documents_that_reach_a_known_score_leave_a_shard():
    texts = some_texts(60)
    rows = pa.record_batch({"id": pa.array(range(60), pa.int64()), "text": texts})

    class Shared:
        value = bm25.Queries(pa.array([0, 1], pa.int64()), pa.array([texts[0], "w3 w4 w5"]))

    def found(least):
        count = np.ones(len(Shared.value.terms))
        out = bm25.search_batches(iter([rows]), Shared, count, 600, 30_000, 5, 8, 1000, np.array(least))
        return sorted((r["query"], -r["score"], r["id"]) for batch in out for r in batch.to_pylist())

    every = found([0.0, 0.0])
    fifth = [-[r for r in every if r[0] == q][4][1] for q in (0, 1)]
    assert found(fifth) == [r for r in every if -r[1] >= fifth[r[0]]]
    assert len(every) > len(found(fifth)) >= 10


def test_short_queries_take_their_best_blocks_together(monkeypatch):
    texts = some_texts(400)
    asked = [" ".join(t.split()[: 1 + i % 6]) for i, t in enumerate(texts[:150])] + ["nowhere", ""]
    queries = bm25.Queries(pa.array(range(len(asked)), pa.int64()), pa.array(asked))
    postings, lengths = bm25.term_postings(pa.array(texts), queries.terms)
    weight = np.linspace(0.5, 3, len(queries.terms))
    shard = bm25.Shard(postings, lengths, weight, lengths.mean(), 8)
    every = np.arange(len(asked))
    scored, block_scores = [], shard.block_scores

    def counting(first, term, count, row, pivot):
        scored.append(len(row))
        return block_scores(first, term, count, row, pivot)

    monkeypatch.setattr(shard, "block_scores", counting)
    floor = np.zeros(len(asked))
    got = shard.top(queries, every, 5, floor)
    score = np.round(shard.scores(queries, every), bm25.DECIMALS)
    want = [(q, -score[q, d], d) for q in every for d in np.lexsort((np.arange(400), -score[q]))[:5] if score[q, d]]
    assert [(q, -x, d) for q, x, d in zip(*got)] == want
    assert len(scored) <= 20 and sum(scored) < 0.7 * len(asked) * shard.blocks  # a call per query before
    again = shard.top(queries, every, 5, floor.copy())
    assert [x.tolist() for x in again] == [x.tolist() for x in got]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    for kind, pattern, good in ((1, IP, crf.good_ip), (2, crf.CARD, crf.good_card), (3, crf.PHONE, crf.good_phone)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if good(m.group())]
    return sorted(found)


PARTS = ["a.b@c.de", "é@x.y", "1.2.3.4", "300.1.1.1", "4351449841005842", "+1 (462) 555-0193", "4", "-",
         " ", ".", "@", "+", "(", "0", "x"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_runs_hold_all_matches(text):
    assert crf.base_spans(text) == plain_spans(text)


@settings(max_examples=500, deadline=None)
@given(st.text("a1.@-", max_size=24))
def test_spans_of_dense_texts(text):
    assert crf.base_spans(text) == plain_spans(text)


def test_very_long_runs_take_time_in_proportion(spark):
    long = 1_000_000
    texts = {"x " + "0" * 5000 + "1.1.1.1 y": 1, "@" + "a" * long: 0, "1" * long: 0, "a@" * long: 0,
             "a" * long + "@b.c": 1, "1.1.1.1 " * 50_000: 50_000, "a@b.c " * 50_000: 50_000}
    for text, spans in texts.items():
        begin = time.process_time()
        assert len(crf.base_spans(text)) == spans
        assert time.process_time() - begin < 10
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    field = crf.fit(crf.labelled_windows(frame.where("doc_id = 0")))
    got = {r.doc_id: sum(s.base for s in r.spans) for r in crf.find(frame, field).collect()}
    assert list(got[i] for i in range(len(texts))) == list(texts.values())


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), max_size=8), st.integers(0, 30), st.integers(1, 9))
def test_taken_stretches(spans, start, size):
    spans = [(a, 0, a + n) for a, n in spans]
    plain = any(a < start + size and b > start for a, _, b in spans)
    assert crf.Taken(spans).meets(start, start + size) == plain


def test_viterbi_and_slope_against_every_way():
    random = np.random.default_rng(3)
    rows = random.integers(0, 9, (4, crf.GROUPS))
    field = crf.Field(random.normal(size=(crf.GROUPS, crf.SHAPES + 1, crf.TAGS)),
                      random.normal(size=(crf.TAGS, crf.TAGS)), random.normal(size=crf.TAGS))
    score = sum(field.weights[g][rows[:, g]] for g in range(crf.GROUPS))

    def of(tags):
        steps = sum(field.moves[a, b] for a, b in zip(tags, tags[1:]))
        return field.begin[tags[0]] + score[range(4), tags].sum() + steps

    ways = list(product(range(crf.TAGS), repeat=4))
    assert tuple(crf.viterbi(score[None], np.array([4]), field)[0]) == max(ways, key=of)
    # one step of AdaGrad goes along the sign of (seen - expected) from weights of nothing
    tags = np.array([0, 2, 2, 0])
    trained = crf.train([rows], [tags], steps=1, rate=1.0, decay=0.0)
    seen = np.zeros((crf.TAGS, crf.TAGS))
    for a, b in zip(tags, tags[1:]):
        seen[a, b] += 1
    gap = seen - 3 / crf.TAGS**2
    assert np.allclose(trained.moves, np.sign(gap), atol=1e-3)


def test_personal_data(spark):
    rows = [(1, "mail é a.b@c.de, ip 1.2.3.4"), (2, None), (None, ""), (2, "nothing here")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, spans int")
    field = crf.fit(crf.labelled_windows(frame))
    got = sorted(((r.doc_id or -1), [(s.kind, s.start, s.end) for s in r.spans if s.base])
                 for r in crf.find(frame, field).collect())
    assert got == [(-1, []), (1, [("email", 7, 15), ("ip", 20, 27)]), (2, []), (2, [])]
    hidden = {r.text for r in crf.redact(frame, field).collect()}
    assert hidden == {"mail é [EMAIL], ip [IP]", None, "", "nothing here"}
    assert crf.find(frame.limit(0), None).count() == 0


def test_neighbouring_cards(spark):
    card, other = "4465758382889437", "7536784127813050"
    taught = [(i, f"word {i} pay {c} now") for i, c in enumerate([card, other, f"{card} {other}"] * 4)]
    assert crf.taught_spans(f"é {other} {card}") == [(2, 2, 18), (19, 2, 35)]
    rows = [(100, f"é pay {card} {other} now"), (101, f"pay {card} {card} {card} now")]
    field = crf.fit(crf.labelled_windows(spark.createDataFrame(taught, "doc_id long, text string")))
    asked = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in crf.find(asked, field).collect()}
    assert got[100] == [("card", 6, 22), ("card", 23, 39)]
    assert got[101] == [("card", 4, 20), ("card", 21, 37), ("card", 38, 54)]
    assert {r.text for r in crf.redact(asked, field).collect()} == {
        "é pay [CARD] [CARD] now", "pay [CARD] [CARD] [CARD] now"}


def test_labelled_by_hand(spark):
    for text, spans in crf.hand_made():
        assert all(crf.plausible(crf.KINDS.index(k), text[a:b]) for a, k, b in spans)
    rows = [(1, "word and word"), (2, "call us at (301) 555-7788 now"), (3, "write to andré@tête.fr now")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    field = crf.fit(crf.labelled_windows(frame.where("doc_id = 1")))
    assert {r.text for r in crf.redact(frame, field).collect()} == {
        "word and word", "call us at [PHONE] now", "write to [EMAIL] now"}


def test_classifier(spark):
    good = [(i, f"word{i} and more of the words {i * 7}", 1, "s") for i in range(60)]
    bad = [(100 + i, f"BUY!! NOW!! {i} !!", 0, "s") for i in range(20)]
    rows = [*good, *bad, (None, None, None, "s"), (500, "", None, "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int, score string")
    model = nbsvm.fit(frame, frame, frame.doc_id % 7 == 0, size=4096)
    scored = nbsvm.score(frame, model, size=4096).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    low = min(r.score for r in scored if r.quality == 1)
    assert low > max(r.score for r in scored if r.quality == 0)
    assert nbsvm.fit(frame, frame.limit(0), frame.doc_id == 0) is None
    assert re.match("double", dict(nbsvm.score(frame, None).dtypes)["score"])


TEXTS = ["the cat the cat", "BUY!! now 12", "", "é é é", "a", "the the the dog 99 ran", " \n", "x" * 300]


def test_features_of_a_batch_are_those_of_each_text():
    size = 1 << 12
    doc, feature = nbsvm.features(pa.array([*TEXTS, None]), size)
    for i, text in enumerate(TEXTS):
        alone = nbsvm.features(pa.array([text]), size)[1]
        assert feature[doc == i].tolist() == sorted(set(alone.tolist()))
    assert not (doc == len(TEXTS)).any()
    raw = "the cat the cat ".encode()
    grams = {raw[i : i + 3] for i in range(len(raw) - 2)}
    words, pairs, share = {"a"}, {"aa"}, {0}  # every word has one shape
    assert (doc == 0).sum() <= len(grams) + len(words) + len(pairs) + len(share)
    assert (doc == 0).sum() >= len(grams) - 1


def test_ratios_by_counting(spark):
    size = 1 << 12
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["ab", "CD", "12", "e!"], rng.integers(0, 12))), int(rng.integers(0, 2)))
            for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    seen = [(set(nbsvm.features(pa.array([t]), size)[1].tolist()), y) for i, t, y in rows if i % 5]
    n = [sum(y == c for _, y in seen) for c in (0, 1)]
    model = nbsvm.fit(frame, frame, frame.doc_id % 5 == 0, size=size)
    for f in set().union(*(s for s, _ in seen)) | {7}:
        share = [(sum(f in s for s, y in seen if y == c) + 1) / (n[c] + 2) for c in (0, 1)]
        assert model.ratios[f] == pytest.approx(np.log(share[1] / share[0]))


def test_dual_solution_against_a_plain_solver():
    rng = np.random.default_rng(4)
    size, n, cost = 30, 40, 0.7
    ratios = rng.normal(size=size)
    rows = [np.sort(rng.choice(size, rng.integers(1, 9), replace=False)) for _ in range(n)]
    labels = (rng.random(n) < 0.4).astype(np.int64)
    weights = nbsvm.descend(rows, labels, ratios, cost, rounds=3000)
    x = np.zeros((n, size + 1))
    for i, at in enumerate(rows):
        x[i, at] = ratios[at] / np.linalg.norm(ratios[at])
        x[i, size] = 1
    signed = x * np.where(labels == 1, 1, -1)[:, None]
    bound = cost * n / (2 * np.bincount(labels))[labels]
    gram = signed @ signed.T
    alpha, step = np.zeros(n), 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(100_000):  # projected gradients on the same dual
        alpha = np.clip(alpha + step * (1 - gram @ alpha), 0, bound)

    def loss(w):
        return w @ w / 2 + (bound * np.maximum(0, 1 - signed @ w)).sum()

    assert loss(weights) == pytest.approx(loss(alpha @ signed), rel=1e-4)
    assert np.allclose(weights, alpha @ signed, atol=2e-2)


def test_quality_of_very_long_texts(spark):
    rows = [(i, f"good word{i} and more " * 20, 1) for i in range(20)] + [(50 + i, "BUY!! " * 50, 0) for i in range(20)]
    rows += [(100, "good words and more " * 100_000, None), (101, "BUY!! " * 300_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = nbsvm.fit(frame, frame, frame.doc_id < 0, size=4096)
    got = {r.doc_id: r.score for r in nbsvm.score(frame, model, size=4096).collect()}
    assert got[100] > 0.5 > got[101]


def test_samples_are_bounded(spark, monkeypatch):
    rows = [(7, f"word{i} mail a{i}@b.de " + "and more " * 30 + f"ip 1.2.3.{i}", 1) for i in range(40)]
    rows += [(8, "BUY!! NOW!!", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    seen, fit_sample = [], nbsvm.fit_sample
    monkeypatch.setattr(nbsvm, "fit_sample", lambda t, r: (seen.append(t.num_rows), fit_sample(t, r))[1])
    assert nbsvm.fit(frame, frame, frame.doc_id < 0, size=4096, sample_rows=2) is not None
    assert seen == [2]
    by_hand = len(crf.HAND_MADE)
    assert crf.labelled_windows(frame).count() == 81 + by_hand
    assert crf.labelled_windows(frame, windows=5).count() == 5 + by_hand
