"""The Jaccard join against all pairs."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import nbsvm, shingles
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES
from tidemark.llm.workspace import Workspace

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if 0 < len(words) < n:
        return {tuple(words)}
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def plain(rows, n, percent):
    sets = [sets_of(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), key), key)
    return sorted((key, len(sets[i]), best[find(i)]) for i, (key, _) in enumerate(rows))


def corpus(seed, groups, copies):
    random = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(random.choice(vocabulary, 30))
    rows = []
    for _ in range(groups):
        base = list(random.choice(vocabulary, random.integers(1, 120)))
        for _ in range(random.integers(1, copies)):
            words = list(base)
            for _ in range(random.integers(0, 1 + len(words) // 25)):
                words[random.integers(len(words))] = "changed" + str(random.integers(1000))
            text = " ".join(words)
            rows.append(text.upper() if random.random() < 0.2 else text)
            if random.random() < 0.3:
                rows.append(text + "\n" + passage)
    return [(int(i) * 3, t) for i, t in zip(random.permutation(len(rows)), rows)]


@pytest.mark.parametrize("seed,part,cells", [(1, 2048, 1 << 18), (2, 3, 64), (3, 10, 1)])
def test_same_as_all_pairs(spark, seed, part, cells):
    rows = corpus(seed, 25, 9)
    frame = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, node int")
    got = shingles.join(frame, part_nodes=part, cells=cells, bucket_bytes=2000).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 5, 75)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(1, 40), min_size=1, max_size=30), min_size=1, max_size=90),
       st.booleans())
def test_tree_walk_connects_what_is_linked(sets, split):
    arrays = [np.array(sorted(s), np.uint64) << np.uint64(17) for s in sets]
    every = np.arange(len(sets))
    half = len(sets) // 2 if split else 0
    if split:
        links = [*shingles.linked(arrays, every[:half], every[:half], 75),
                 *shingles.linked(arrays, every[half:], every[half:], 75),
                 *shingles.linked(arrays, every[:half], every[half:], 75)]
    else:
        links = shingles.linked(arrays, every, every, 75)

    def groups(pairs):
        root = list(range(len(sets)))
        for i, j in pairs:
            old, new = root[i], root[j]
            root = [new if r == old else r for r in root]
        return sorted(sorted(i for i in every.tolist() if root[i] == r) for r in set(root))

    real = [(i, j) for i in range(len(sets)) for j in range(i)
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert all((max(p), min(p)) in set(real) for p in links)
    assert groups(links) == groups(real)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = dict(components(Workspace(spark, "test"), frame, "c").collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def test_odd_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shingles.join(empty).count() == 0
    rows = [(5, None), (6, ""), (7, " \n"), (8, "Hi there"), (9, "hi\tTHERE"), (9, "hi there"),
            (None, "hi there"), (None, None), (10, "x " * 30_000), (11, "x " * 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in shingles.join(frame).collect()), key=repr)
    assert got == sorted([(5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (9, 1, 8),
                          (None, 1, 8), (None, 0, None), (10, 1, 10), (11, 1, 10)], key=repr)


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op7_signature_tree_join"](spark, SMALL).collect())
    assert got == plain(rows, 5, 75)


def test_rounds_of_components_write_files_by_their_links(spark):
    """Not one per shuffle partition: a few thousand links are one file."""

    class Counting(Workspace):
        def keep(self, frame, name):
            kept = super().keep(frame, name)
            files.append(len(kept.inputFiles()))
            return kept

    files = []
    given = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in given}
    links = spark.range(2000).selectExpr("id AS a", "id + 1 - id % 5 AS b")
    try:
        for name, value in given.items():
            spark.conf.set(name, value)
        found = components(Counting(spark, "test"), links, "c", 2000)
        assert found.count() == 2000 and len(files) > 2 and max(files) == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_counts_of_a_task_travel_in_small_rows(spark):
    words = [f"{a} {a * 7} {a % 5}" for a in range(400)]
    rows = pa.record_batch({"label": pa.array([a % 2 for a in range(400)], pa.int32()), "text": words,
                            "id": pa.array(range(400), pa.int64())})
    found = list(nbsvm.count_batches(iter([rows]), nbsvm.FEATURES))
    found += list(shingles.sign_batches(iter([rows]), 5, shingles.CELLS, pa.int64()))
    sizes = [len(blob.as_py() or b"") for batch in found for blob in batch["counts"]]
    assert 0 < max(sizes) <= 1 << 14  # were tables of 4 and 2 MiB, all in one batch of a later task


@pytest.mark.parametrize("cells", [1, 2048, 2 * 2048 + 2])
def test_cells_of_all_tasks_are_added(spark, cells):
    def count(batches):
        for batch in batches:
            for at in batch["id"].to_pylist():
                counts = np.zeros(cells, np.int64)
                counts[[at * 997 % cells, cells - 1]] += at
                yield shingles.cell_pieces(counts)

    rows = spark.range(0, 50, numPartitions=7).mapInArrow(count, shingles.CELL_PIECE)
    want = np.zeros(cells, np.int64)
    for at in range(50):
        want[list({at * 997 % cells, cells - 1})] += at
    assert shingles.counted_cells(rows, cells).tolist() == want.tolist()
    assert not shingles.counted_cells(rows.limit(0), cells).any()


def test_a_common_passage_ties_no_families_however_full_the_cells_are(spark, monkeypatch):
    """With one cell no shingle is known to be rare, as with many documents to a cell."""
    random = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(15))
    rows = []
    for i in range(200):
        own = " ".join(f"w{x}" for x in random.integers(1 << 40, size=100))
        rows += [(2 * i, f"{own} {passage}"), (2 * i + 1, f"{own} {passage} more")]
    kept = Workspace.keep

    def counting(self, frame, name):
        table = kept(self, frame, name)
        if name == "family":
            sizes.extend(r["count"] for r in table.groupBy("root").count().collect())
        return table

    sizes = []
    monkeypatch.setattr(Workspace, "keep", counting)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = shingles.join(frame, cells=1).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 5, 75)
    assert sizes == [2] * 200  # was one family of 400, each part of which meets all others


def test_nodes_that_may_be_linked_keep_what_they_share():
    """Any two sets at the bound, in any order of their shingles, meet after every round."""
    random = np.random.default_rng(6)
    for _ in range(300):
        a, b = random.integers(1, 80, size=2)
        both = -(-3 * (a + b) // 7)
        if both > min(a, b):
            continue
        every = random.choice(1 << 20, a + b - both, replace=False).astype(np.uint64) << np.uint64(11)
        sets = [np.sort(every[:a]), np.sort(every[a - both :])]
        counts = random.integers(1, 4, size=64)
        least = [shingles.least_shared(len(x), 75) for x in sets]
        chosen = [shingles.rarest(x, counts, 75) for x in sets]
        noise = np.unique(np.concatenate(chosen))
        noise = noise[random.random(len(noise)) < 0.5]  # a third node, so that counts differ
        columns = {
            "hashes": np.concatenate([*chosen, noise]),
            "nodes": np.repeat(np.arange(3), [*map(len, chosen), len(noise)]),
            "least": np.repeat(np.array([*least, 1], np.int32), [*map(len, chosen), len(noise)]),
        }
        table = pa.Table.from_batches([shingles.by_bucket(columns["hashes"], 1, **columns)])
        assert sorted(zip(*shingles.of_bucket(table, hashes=np.uint64, nodes=np.int64, least=np.int32))) == sorted(
            zip(*columns.values()))
        for part in shingles.ROUNDS:
            table = shingles.able(shingles.meetings(table, 1), 1, part)
        pairs = shingles.touches(table)
        assert {0, 1} <= {*pairs["a"].to_pylist(), *pairs["b"].to_pylist()}


def test_places_are_marked(spark):
    bits = 1 << 17
    places = sorted({0, 7, 32767, 32768, bits - 1, *range(1000, 90_000, 977)})
    marks = shingles.marked(spark.createDataFrame([(p,) for p in places], "place long"), bits)
    assert np.flatnonzero(np.unpackbits(marks, bitorder="little")).tolist() == places
    assert not shingles.marked(spark.createDataFrame([], "place long"), 2).any()
