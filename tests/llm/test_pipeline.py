"""Every stage of the corpus pipeline on odd rows, and the whole against plain code."""

import random
import re
import zlib

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from tidemark.llm import crf, nbsvm, packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the stages use for columns of their own.
EXTRA = "score string, spans int, kept string, row int, id int, block int, rest string"


def prose(rng, words):
    return " ".join("".join(rng.choice("aeiounrstlmd") for _ in range(rng.randrange(2, 9))) for _ in range(words))


def documents():
    """Prose and junk, exact and near copies, a passage that several hold, personal data."""
    rng = random.Random(11)
    texts = [prose(rng, 60) for _ in range(30)]
    passage = prose(rng, 40)
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 10)}" for _ in range(4)]
    texts += [texts[0], texts[1] + " end", texts[2].upper(), "", None, "short"]
    texts += [f"{prose(rng, 20)} write to a.b@c.de or 10.0.0.1 now" for _ in range(3)]
    texts += [f"BUY!! NOW!! {i} !! $$$ <<< WIN >>> FREE !!!" for i in range(20)]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    rows = documents()
    spark.createDataFrame(rows, SHAPE).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(i, int("!!" not in (t or "")), 0) for i, t, *_ in rows if i % 3 and t]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def texts_of(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def plain_classes(rows):
    """{id: smallest id reachable by links}, over all pairs."""
    sets = {}
    for i, text in rows:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i, _ in rows}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * len(sets[a] | sets[b]):
                    low, high = sorted((root[a], root[b]))
                    root = {k: low if v == high else v for k, v in root.items()}
    return root


def plain_cut(rows, span=100):
    """Bytes of each text without what lies in a string that starts earlier as well."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - span + 1):
            part = data[at : at + span]
            if part in seen:
                gone[at : at + span] = [True] * span
            seen.add(part)
        out[i] = bytes(b for b, g in zip(data, gone) if not g), len(data)
    return out


def test_the_whole_equals_plain_code_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, folder)
        if place < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
            docs = spark.createDataFrame(docs.collect(), before.schema)
            kept[name] = texts_of(docs)
    rows = [(i, t) for i, t, *_ in documents()]

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    whole = spark.read.parquet(f"{folder}/documents.parquet")
    model = nbsvm.fit(whole, labels, labels.doc_id < 0)
    chance = {r.doc_id: r.score for r in nbsvm.score(whole, model).collect()}
    good = sorted(((i, t) for i, t in rows if chance[i] >= 0.3), key=repr)
    assert kept["quality classifier"] == good
    assert [i for i, t in good if "!!" in (t or "")] == []
    assert len(good) == len(rows) - 20

    root = plain_classes(good)
    single = [(i, t) for i, t in good if root[i] == i]
    assert kept["n-gram Jaccard join"] == sorted(single, key=repr) and len(single) == len(good) - 3

    cut = plain_cut(single)
    left = [(i, cut[i][0].decode()) for i, _ in single if cut[i][1] == 0 or cut[i][0]]
    assert [(i, t or "") for i, t in kept["suffix-array dedup"]] == sorted(left, key=repr)
    assert sum(cut[i][1] - len(cut[i][0]) for i, _ in single) > 300

    for (i, before), (j, after) in zip(kept["suffix-array dedup"], kept["PII"]):
        assert i == j
        spans = [(s, k, e, True) for s, k, e in crf.base_spans(before or "")]
        assert (after or "") == crf.redacted(before or "", spans)
    assert sum("[EMAIL] or [IP]" in (t or "") for _, t in kept["PII"]) == 3

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    pieces = docs.collect()
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in kept["PII"]}
    assert sorted(r.doc_id for r in pieces) == sorted(want)
    for r in pieces:
        ids = want[r.doc_id]
        crc = zlib.crc32(b"".join(n.to_bytes(4, "little") for n in ids))
        assert (r.start, r.length, r.doc_tokens, r.ids_crc32) == (0, len(ids), len(ids), crc)

    def shape(rows):
        return sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)

    assert shape(corpus_pipeline.run(spark, folder).collect()) == shape(pieces)


@pytest.mark.parametrize("place", range(5))
def test_stages_take_odd_rows(spark, folder, place):
    name, stage = corpus_pipeline.STAGES[place]
    rng = random.Random(5)
    same = prose(rng, 50)
    rows = [(None, None), (None, "a b"), (1, None), (1, ""), (2, same), (2, same), (3, same), (4, "x " * 30_000),
            (5, " \n\t"), (6, "é" * 40)]
    shaped = [(i, t, None, None, None, "s", 1, None, 2, 3, 4, "r") for i, t in rows]
    frame = spark.createDataFrame(shaped, f"{SHAPE}, {EXTRA}").repartition(3)
    out = stage(spark, frame, folder)
    got = out.collect()
    if name == "packing":
        assert {r.doc_id for r in got} == {None, 1, 2, 3, 4, 5, 6}
        assert sum(r.length for r in got if r.doc_id == 1) == 2
    else:
        assert out.columns == frame.columns
        assert all((r.spans, r.block, r.score) == (1, 4, "s") for r in got)
        ids = [r.doc_id for r in got]
        if name in ("quality classifier", "PII"):
            assert set(ids) <= {i for i, _ in rows}
        if name == "PII":
            assert sorted(map(repr, ids)) == sorted(repr(i) for i, _ in rows)
        if name == "n-gram Jaccard join":
            assert ids.count(2) == 2 and 3 not in ids and ids.count(None) == 2 and ids.count(1) == 2
        if name == "suffix-array dedup":
            assert 3 not in ids and ids.count(2) == 2 and ids.count(1) == 2
    none = stage(spark, frame.limit(0), folder)
    assert none.count() == 0
