"""Repeated passages against a dictionary of every window."""

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import suffixes
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(rows, span):
    """rows: (id, bytes). What each row keeps, and its removed runs."""
    first = {}
    for key, data in sorted(rows):
        for i in range(len(data) - span + 1):
            first.setdefault(data[i : i + span], (key, i))
    out = []
    for key, data in rows:
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - span + 1):
            if first[data[i : i + span]] < (key, i):
                gone[i : i + span] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((key, len(data), runs, kept))
    return sorted(out)


def found(frame):
    return sorted((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in frame.collect())


def corpus(seed, n, span):
    random = np.random.default_rng(seed)
    letters = np.frombuffer(b"abcd \n\xc3\xa9", np.uint8)
    passage = ["".join(random.choice(list("abcdé "), 3 * span)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = ["".join(random.choice(list("abcdé "), random.integers(0, 2 * span)))]
        for _ in range(random.integers(0, 3)):
            chosen = passage[random.integers(4)]
            a = random.integers(0, span)
            parts.append(chosen[a : a + random.integers(span // 2, 2 * span)])
            parts.append("xy" * random.integers(0, span))
        rows.append((int(random.permutation(1000)[0]) * 50 + i, "".join(parts)))
    rows += [(9_000_001, rows[0][1]), (9_000_002, rows[0][1] + "!"), (9_000_003, "z" * 5 * span)]
    assert len(letters) == 8
    return rows


@pytest.mark.parametrize("span,gram,block,hot,shard", [
    (20, 8, 1 << 20, 10**9, 500), (20, 12, 400, 10**9, 1 << 20), (100, 40, 2000, 10**9, 3000),
    (20, 8, 700, 3, 400),
])
def test_same_as_a_dictionary_of_windows(spark, span, gram, block, hot, shard):
    rows = corpus(span + block, 60, span)
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, block int")
    got = suffixes.remove_repeats(
        frame, span=span, gram=gram, block_bytes=block, hot=hot, shard_bytes=shard
    )
    assert found(got) == plain([(i, t.encode()) for i, t in rows], span)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=10, max_size=40), min_size=1, max_size=8),
       st.integers(5, 60))
def test_intervals_are_those_of_a_dictionary(words, shard):
    span = 10
    pieces = [w.encode() for w in dict.fromkeys(words)]
    data = np.frombuffer(b"".join(pieces), np.uint8)
    segment, offset, interval = suffixes.repeated_intervals(
        data, np.array([len(p) for p in pieces]), span, shard
    )
    windows = {}
    for s, piece in enumerate(pieces):
        for o in range(len(piece) - span + 1):
            windows.setdefault(piece[o : o + span], []).append((s, o))
    want = sorted(sorted(w) for w in windows.values() if len(w) > 1)
    groups = {}
    for s, o, i in zip(segment.tolist(), offset.tolist(), interval.tolist()):
        groups.setdefault(i, []).append((s, o))
    assert sorted(sorted(g) for g in groups.values()) == want


def test_transform_of_one_shard_steps_back():
    pieces = [b"banana", b"ananas", b"ban"]
    shard = suffixes.Shard(np.frombuffer(b"".join(pieces), np.uint8), np.array([6, 6, 3]), 2)
    suffix = [pieces[s][o:] for s, o in zip(shard.segment, shard.offset)]
    assert suffix == sorted(suffix)
    back = suffixes.step_back(shard.transform)
    for row, symbol in enumerate(shard.transform):
        if symbol:
            assert suffix[back[row]] == bytes([symbol - 1]) + suffix[row]


def test_odd_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(empty).count() == 0
    long = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(5))[:300]
    rows = [(None, long), (1, None), (1, ""), (2, long), (2, long), (3, "q" * 100_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.n_bytes, len(r.kept), len(r.spans))
                 for r in suffixes.remove_repeats(frame).collect())
    assert got == [(-1, 300, 300, 0), (1, 0, 0, 0), (1, 0, 0, 0), (2, 300, 0, 1), (2, 300, 0, 1),
                   (3, 100_000, 1, 1)]


def test_query_on_whole_table(spark):
    texts = [(r.doc_id, (r.text or "").encode())
             for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = {k: (n, n - len(kept), runs, hashlib.sha256(kept).hexdigest())
            for k, n, runs, kept in plain(texts, 100)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in QUERIES["op3_bwt_dedup"](spark, SMALL).collect()}
    assert got == want


def letters(random, n):
    return "".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), n))


def test_short_stretches_that_repeat_within_themselves(spark):
    """Only such a stretch holds its anchor, which lies behind a place divisible by 128."""
    random = np.random.default_rng(5)
    rows = [(i, letters(random, int(random.integers(0, 128))) + letters(random, 3) * 45)
            for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(suffixes.remove_repeats(frame)) == plain([(i, t.encode()) for i, t in rows], 100)


def test_texts_of_one_key_by_their_starts(spark):
    """Under one key the passage nearer the front stays, whatever the texts' order."""
    passage = letters(np.random.default_rng(6), 150)
    rows = [(1, "a" * 40 + passage), (1, "b" + passage), (1, "c" * 20 + passage)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(suffixes.remove_repeats(frame))
    assert got == [(1, 151, 0, rows[1][1].encode()), (1, 170, 1, b"c" * 20), (1, 190, 1, b"a" * 40)]


def test_common_passage_sends_few_rows():
    """Windows of a hot anchor that occur once do not travel, copies of a passage as one row."""
    random = np.random.default_rng(7)
    passage, n = letters(random, 300), 200
    table = pa.table({
        "block": pa.array([0] * n, pa.int32()), "id": pa.array(range(n), pa.int64()),
        "text": [letters(random, 200) + passage + letters(random, 200) for _ in range(n)],
    })
    again = suffixes.repeated_anchors(suffixes.block_anchors(table, 100, 40, 1), 100)
    assert again["n_hot"].to_pylist()[0] > 0
    windows = suffixes.repeated_anchors(suffixes.hot_windows(table, again, 100, 40, 1), 10**9)
    windows = windows.set_column(2, "hot", pa.nulls(1, pa.binary()))
    sent = suffixes.block_segments(table, pa.concat_tables([again, windows]), 100, 40, 8)
    assert sent.num_rows <= 4 * n  # of about 320 windows in each text
    assert sent["content"].null_count < 1.5 * n


@pytest.mark.parametrize("hot", [10**9, 1])
def test_memory_of_a_block_that_repeats(hot):
    """Segments overlap, several bytes for each byte of a text; a task holds no place for each."""
    random = np.random.default_rng(8)
    whole = random.integers(97, 123, 400_000).astype(np.uint8).tobytes().decode()
    table = pa.table({
        "block": pa.array([0, 0, 0], pa.int32()), "id": pa.array([1, 2, 3], pa.int64()),
        "text": [whole, "a" + whole, whole[:200_000] + "b" + whole[200_000:]],
    })
    again = suffixes.repeated_anchors(suffixes.block_anchors(table, 100, 40, 1), hot)
    if again["n_hot"].to_pylist()[0]:
        windows = suffixes.repeated_anchors(suffixes.hot_windows(table, again, 100, 40, 1), 10**9)
        windows = windows.set_column(2, "hot", pa.nulls(1, pa.binary()))
        again = pa.concat_tables([again, windows])
        table = table.slice(0, 1).set_column(2, "text", pa.array([whole[:100_000]]))
    bytes_of_texts = sum(len(t) for t in table["text"].to_pylist())
    tracemalloc.start()
    sent = suffixes.block_segments(table, again, 100, 40, 8)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sent["content"].null_count < sent.num_rows
    assert most < (40 if hot > 1 else 500) * bytes_of_texts


def test_windows_of_one_number_are_equal():
    """Also where others have their hash."""
    data = np.frombuffer(b"abcdabcdabceabcd", np.uint8)
    starts = np.array([0, 4, 8, 12])
    other = np.array([7, 7, 7, 7], np.uint64)
    assert suffixes._window_codes(data, starts, other, 4).tolist() == [0, 0, 1, 2]
    own = suffixes.window_hashes(data, 4)[starts]
    code = suffixes._window_codes(data, starts, own, 4)
    assert code[0] == code[1] == code[3] != code[2]
