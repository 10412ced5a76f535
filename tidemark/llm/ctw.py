"""Context-tree weighting over bytes, trained and applied as Spark jobs.

A byte is coded as eight binary decisions; the decision reached after some bits of the byte
has a context tree of its own, whose contexts are the last 0 to ``depth`` bytes. Every node
holds a Krichevsky-Trofimov estimate; a node's weighted probability is half its estimate plus
half the product of its children's. Scoring uses the trained tree as it stands, so the code
length of a byte depends on that byte and the ``depth`` bytes before it only.

How it spreads:

* Texts lie in blocks. A block's distinct contexts with their byte (grams) and its distinct
  words leave it once, with their counts: a word of every document is one entry per block.
* Entries go to buckets by the two nearest context bytes (or a hash of the word). Counts are
  summed over groups of blocks, then over the groups. A bucket holds whole subtrees from
  depth two on; the nodes above are at most 256 x 255 and are summed by Spark.
* Entries are laid out by bucket and group of blocks once, for the summing and the answering.
* Each bucket works out the code length of each distinct gram once and answers the blocks;
  a block sums them up over its texts. Answers on grams come without the grams, in the order
  in which the block lists them again.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts as tx
from tidemark.llm.workspace import Workspace, blocked

#: Bytes of context. A gram is the context and the byte, in one 64-bit number.
DEPTH = 5

#: Text of one block: larger ones hold fewer distinct grams a byte.
BLOCK_BYTES = 8 << 20

#: Buckets of grams and of words.
BUCKETS = 64

#: Blocks whose entries one task of the first summing, or of the answering, takes.
BLOCKS_TOGETHER = 64

#: Never a byte of UTF-8: stands before a text and ends it.
EDGE = b"\xff"

ALPHA = 0.1

ENTRY = "place int, kind int, bucket int, block int, keys binary, counts binary"
MERGED = "kind int, bucket int, keys binary, counts binary"
NODE = "node int, zeros double, ones double, weighted double"
ANSWER = "block int, kind int, bucket int, keys binary, vals binary"
GRAMS, WORDS = 0, 1


def packed(values: np.ndarray | bytes) -> bytes:
    """Bytes of an array, compressed."""
    raw = values if isinstance(values, bytes) else values.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked(blob: bytes, kind=None):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return raw if kind is None else np.frombuffer(raw, kind)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, np.uint64), dtype=np.uint64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers."""
    x = np.array(x, float)
    shift = np.zeros_like(x)
    for _ in range(16):
        small = x < 16
        shift[small] += np.log(x[small])
        x[small] += 1
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - shift


#: Counts whose logarithms are looked up.
LOOKED_UP = 1 << 12
GAMMA = {shift: log_gamma(np.arange(LOOKED_UP) + shift) for shift in (0.5, 1.0)}


def _log_gamma_of(counts: np.ndarray, shift: float) -> np.ndarray:
    """``log_gamma`` of whole numbers moved by a shift of ``GAMMA``."""
    small = counts < LOOKED_UP
    out = GAMMA[shift][np.where(small, counts, 0).astype(np.int64)]
    out[~small] = log_gamma(counts[~small] + shift)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return (
        _log_gamma_of(zeros, 0.5) + _log_gamma_of(ones, 0.5) - math.log(math.pi)
        - _log_gamma_of(zeros + ones, 1.0)
    )


def mixed(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log probability of nodes, and the weight of each node's own estimate."""
    half = math.log(0.5)
    weighted = np.logaddexp(half + own, half + below)
    return weighted, np.exp(half + own - weighted)


def _grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all texts and the text of each. Layout: nearest byte first, coded byte last."""
    lengths = np.diff(offsets) - depth
    at = tx.ranges(offsets[:-1] + depth, lengths)
    key = data[at - 1].astype(np.uint64)
    for back in range(2, depth + 1):
        key = (key << np.uint64(8)) | data[at - back]
    key = (key << np.uint64(8)) | data[at]
    return key, np.repeat(np.arange(len(lengths)), lengths)


def _text_grams(table: pa.Table, depth: int):
    return _grams(*tx.flat(table["text"], EDGE * depth, EDGE), depth)


def _gram_bucket(key: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    near = key >> np.uint64(8 * (depth - 1))
    return (tx.mix(near + np.uint64(1)) >> np.uint64(40)).astype(np.int64) % buckets


def _block_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word numbers, the text of each word, and the distinct words of the rows."""
    data, offsets = tx.flat(table["text"], after=b" ")
    data = tx.LOWER[data]
    starts, ends = tx.word_bounds(data)
    codes, words = tx.word_codes(data, starts, ends)
    return codes, np.searchsorted(offsets, starts, "right") - 1, words


def _unique_sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, tx.sums(inverse, counts, len(distinct)).astype(np.int64)


def _sorted_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _place(kind, bucket, salt, buckets: int):
    """One number for the kind and bucket of an entry and the group of its block."""
    return (salt * 2 + kind) * buckets + bucket


def _block_grams(grams: list[np.ndarray], depth: int, buckets: int) -> tuple[np.ndarray, list]:
    """Distinct grams of a block, ascending, and their positions for each bucket in turn."""
    key = np.unique(np.concatenate(grams))
    bucket = _gram_bucket(key, depth, buckets)
    return key, list(tx.blobs(np.argsort(bucket, kind="stable"), bucket))


def count_block(table: pa.Table, depth: int, buckets: int, together: int) -> pa.Table:
    """Entries of one block: distinct grams and words with their counts in training texts."""
    block = table["block"][0].as_py()
    keys, counts = [], []
    words, word_counts, ends = [], [], 0
    for part in tx.slices(table):
        held = part["held_out"].to_numpy()
        key, doc = _text_grams(part, depth)
        out = held[doc]
        for piece, weight in ((key[~out], 1), (key[out], 0)):
            distinct, count = _sorted_counts(piece)
            keys.append(distinct)
            counts.append(count * weight)
        code, doc, distinct = _block_words(part)
        words.append(distinct)
        word_counts.append(np.bincount(code[~held[doc]], minlength=len(distinct)))
        ends += int(np.count_nonzero(~held))
    rows = []
    _, count = _unique_sums(np.concatenate(keys), np.concatenate(counts))
    key, places = _block_grams(keys, depth, buckets)
    for b, at in places:
        rows.append((GRAMS, b, packed_keys(key[at]), packed(count[at])))
    words.append(pa.array([b""], pa.large_binary()))
    word_counts.append(np.array([ends]))
    coded = pa.concat_arrays(words).dictionary_encode()
    count = np.bincount(coded.indices.to_numpy(), np.concatenate(word_counts)).astype(np.int64)
    text = coded.dictionary.to_numpy(zero_copy_only=False)
    bucket = (tx.hashes(coded.dictionary) >> np.uint64(20)).astype(np.int64) % buckets
    for b, at in tx.blobs(np.argsort(bucket, kind="stable"), bucket):
        rows.append((WORDS, b, packed(b"\n".join(text[at])), packed(count[at])))
    kind, bucket, blob, count = zip(*rows)
    n = len(rows)
    place = [_place(k, b, block // together, buckets) for k, b in zip(kind, bucket)]
    return pa.table(
        {
            "place": pa.array(place, pa.int32()),
            "kind": pa.array(kind, pa.int32()),
            "bucket": pa.array(bucket, pa.int32()),
            "block": pa.array([block] * n, pa.int32()),
            "keys": pa.array(blob, pa.binary()),
            "counts": pa.array(count, pa.binary()),
        }
    )


def _numbers(blobs, kind) -> np.ndarray:
    return np.concatenate([unpacked(b, kind) for b in blobs])


def _all_keys(blobs) -> np.ndarray:
    return np.concatenate([unpacked_keys(b) for b in blobs])


def _split_words(blob: bytes) -> list[bytes]:
    return unpacked(blob).split(b"\n")


def merge(table: pa.Table) -> pa.Table:
    """Sums the entries of one bucket."""
    kind, bucket = table["kind"][0].as_py(), table["bucket"][0].as_py()
    blobs = table["keys"].to_pylist()
    count = _numbers(table["counts"].to_pylist(), np.int64)
    if kind == GRAMS:
        keys, count = _unique_sums(_all_keys(blobs), count)
        blob = packed_keys(keys)
    else:
        words = pa.array([w for b in blobs for w in _split_words(b)], pa.large_binary())
        coded = words.dictionary_encode()
        count = np.bincount(coded.indices.to_numpy(), count).astype(np.int64)
        blob = packed(b"\n".join(coded.dictionary.to_pylist()))
    return pa.table(
        {
            "kind": pa.array([kind], pa.int32()),
            "bucket": pa.array([bucket], pa.int32()),
            "keys": pa.array([blob], pa.binary()),
            "counts": pa.array([packed(count)], pa.binary()),
        }
    )


class Subtree:
    """The nodes of depth 2 to ``depth`` below some pairs of nearest bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int):
        self.depth = depth
        seen = counts > 0
        keys, counts = keys[seen], counts[seen].astype(float)
        self.nodes: dict[tuple[int, int], tuple] = {}
        for d in range(depth, 1, -1):
            key_d, inverse = np.unique(_shorten(keys, depth, d), return_inverse=True)
            count_d = tx.sums(inverse, counts, len(key_d))
            for level in range(8):
                self._add(d, level, key_d, count_d)

    def _add(self, d: int, level: int, keys: np.ndarray, counts: np.ndarray) -> None:
        node = _node(keys, level)
        ids, inverse = np.unique(node, return_inverse=True)
        ones = tx.sums(inverse, counts * _bit(keys, level), len(ids))
        zeros = tx.sums(inverse, counts, len(ids)) - ones
        own = log_kt(zeros, ones)
        if d == self.depth:
            weighted, weight = own, np.ones(len(ids))
        else:
            child, _, _, below, _ = self.nodes[d + 1, level]
            place = np.searchsorted(ids, _drop_byte(child))
            weighted, weight = mixed(own, tx.sums(place, below, len(ids)))
        self.nodes[d, level] = ids, zeros, ones, weighted, weight

    def chance(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Mixed chance of a one-bit from depth 2 down, and where depth 2 has a node."""
        p = np.full(len(keys), 0.5)
        for d in range(self.depth, 1, -1):
            ids, zeros, ones, _, weight = self.nodes[d, level]
            node = _node(_shorten(keys, self.depth, d), level)
            if len(ids) == 0:
                return p, np.zeros(len(keys), bool)
            at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
            found = ids[at] == node
            kt = (ones[at] + 0.5) / (zeros[at] + ones[at] + 1)
            p = np.where(found, weight[at] * kt + (1 - weight[at]) * p, 0.5)
        return p, found


def _shorten(keys: np.ndarray, depth: int, d: int) -> np.ndarray:
    """The gram with only the ``d`` nearest bytes of context."""
    context = (keys >> np.uint64(8)) >> np.uint64(8 * (depth - d))
    return (context << np.uint64(8)) | (keys & np.uint64(255))


def _node(keys: np.ndarray, level: int) -> np.ndarray:
    """Context and the binary decision of a level: the bits before it behind a leading one."""
    bits = ((keys & np.uint64(255)) | np.uint64(256)) >> np.uint64(8 - level)
    return ((keys >> np.uint64(8)) << np.uint64(8)) | bits


def _bit(keys: np.ndarray, level: int) -> np.ndarray:
    return ((keys >> np.uint64(7 - level)) & np.uint64(1)).astype(np.int64)


def _drop_byte(node: np.ndarray) -> np.ndarray:
    """The same decision with the farthest byte of context left out."""
    return ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))


def upper_nodes(batches, depth: int):
    """Sums for the nodes of depth 1, from the nodes of depth 2 of each bucket."""
    for batch in batches:
        for row in batch.to_pylist():
            tree = Subtree(
                unpacked_keys(row["keys"]), unpacked(row["counts"], np.int64), depth
            )
            total = np.zeros((4, 65536))
            for level in range(8):
                ids, zeros, ones, weighted, _ = tree.nodes[2, level]
                node = _drop_byte(ids).astype(np.int64)
                for line, value in enumerate((zeros, ones, weighted)):
                    total[line] += tx.sums(node, value, 65536)
                total[3] += np.bincount(node, minlength=65536)
            at = np.flatnonzero(total[3])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), *(pa.array(total[i][at]) for i in range(3))],
                names=["node", "zeros", "ones", "weighted"],
            )


class Top:
    """The nodes of depth 0 and 1: at most 255 and 256 x 255."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        self.weight, self.one, self.known = np.zeros(65536), np.full(65536, 0.5), np.zeros(65536, bool)
        weighted, weight = mixed(log_kt(zeros, ones), below)
        self.weight[nodes], self.known[nodes] = weight, True
        self.one[nodes] = (ones + 0.5) / (zeros + ones + 1)
        root = nodes & 255
        sums = [tx.sums(root, v, 256) for v in (zeros, ones, weighted)]
        _, self.root_weight = mixed(log_kt(sums[0], sums[1]), sums[2])
        self.root_one = (sums[1] + 0.5) / (sums[0] + sums[1] + 1)

    def chance(self, node: np.ndarray, p: np.ndarray) -> np.ndarray:
        p = np.where(self.known[node], self.weight[node] * self.one[node] + (1 - self.weight[node]) * p, 0.5)
        root = node & 255
        return self.root_weight[root] * self.root_one[root] + (1 - self.root_weight[root]) * p


def gram_scores(keys: np.ndarray, counts: np.ndarray, depth: int, top: Top) -> np.ndarray:
    """log10 probability of the byte of each gram after its context."""
    tree = Subtree(keys, counts, depth)
    score = np.zeros(len(keys))
    near = _shorten(keys, depth, 1)
    for level in range(8):
        p, found = tree.chance(keys, level)
        p = top.chance(_node(near, level).astype(np.int64), np.where(found, p, 0.5))
        score += np.log10(np.where(_bit(keys, level) == 1, p, 1 - p))
    return score


def bucket_values(batches, depth: int, top: Top):
    """For every entry of a bucket its answer: a log10 probability or a word's count."""
    for batch in batches:
        values = []
        for row in batch.to_pylist():
            counts = unpacked(row["counts"], np.int64)
            if row["kind"] == GRAMS:
                keys = unpacked_keys(row["keys"])
                values.append(packed(gram_scores(keys, counts, depth, top).astype(np.float32)))
            else:
                values.append(packed(counts.astype(float)))
        at = batch.schema.get_field_index("counts")
        yield batch.set_column(at, "vals", pa.array(values, pa.binary())).select(
            ["kind", "bucket", "keys", "vals"]
        )


def answer(entries: pa.Table, model: pa.Table) -> pa.Table:
    """The values of the entries of some blocks, from the model of their bucket."""
    if entries.num_rows == 0 or model.num_rows == 0:
        empty = {name: pa.array([], pa.int32()) for name in ("block", "kind", "bucket")}
        return pa.table({**empty, "keys": pa.array([], pa.binary()), "vals": pa.array([], pa.binary())})
    kind = entries["kind"][0].as_py()
    blob = model["keys"][0].as_py()
    values = unpacked(model["vals"][0].as_py(), np.float32 if kind == GRAMS else float)
    if kind == GRAMS:
        known = unpacked_keys(blob)
        found = [values[np.searchsorted(known, unpacked_keys(b))]
                 for b in entries["keys"].to_pylist()]
    else:
        known = pa.array(_split_words(blob), pa.large_binary())
        found = [
            values[pc.index_in(pa.array(_split_words(b), pa.large_binary()), known).to_numpy()]
            for b in entries["keys"].to_pylist()
        ]
    vals = pa.array([packed(v) for v in found], pa.binary())
    keys = entries["keys"] if kind == WORDS else pa.nulls(entries.num_rows, pa.binary())
    return pa.table({"block": entries["block"], "kind": entries["kind"],
                     "bucket": entries["bucket"], "keys": keys, "vals": vals})


def score_block(
    texts: pa.Table, answers: pa.Table, depth: int, buckets: int, total: int, distinct: int
) -> pa.Table:
    """One row per text of a block."""
    rows = answers.to_pylist()
    parts, grams = list(tx.slices(texts)), []
    for part in parts:
        key, doc = _text_grams(part, depth)
        found, inverse = np.unique(key, return_inverse=True)
        grams.append((found, inverse.astype(np.int32), doc.astype(np.int32)))
    keys, places = _block_grams([found for found, _, _ in grams], depth, buckets)
    vals = {r["bucket"]: r["vals"] for r in rows if r["kind"] == GRAMS}
    scores = np.zeros(len(keys))
    for bucket, at in places:
        scores[at] = unpacked(vals[bucket], np.float32)
    words = [r for r in rows if r["kind"] == WORDS]
    known = pa.array([w for r in words for w in _split_words(r["keys"])], pa.large_binary())
    counts = _numbers([r["vals"] for r in words], float)
    end = counts[pc.index_in(pa.scalar(b"", pa.large_binary()), known).as_py()]
    divisor = total + ALPHA * (distinct + 1)
    pieces = []
    for part, (found, inverse, doc) in zip(parts, grams):
        n = part.num_rows
        score = tx.sums(doc, scores[np.searchsorted(keys, found)][inverse], n)
        code, doc, distinct_words = _block_words(part)
        count = counts[pc.index_in(distinct_words, known).to_numpy()] if len(code) else counts[:0]
        count = count[code]
        base = tx.sums(doc, np.log10((count + ALPHA) / divisor), n)
        base += math.log10((end + ALPHA) / divisor)
        pieces.append(pa.table({
            "id": part["id"],
            "held_out": part["held_out"],
            "n_tokens": pa.array(np.bincount(doc, minlength=n) + 1, pa.int64()),
            "n_known": pa.array(tx.sums(doc, count > 0, n).astype(np.int64) + int(end > 0), pa.int64()),
            "train_tokens": pa.array([total] * n, pa.int64()),
            "base_score": pa.array(base, pa.float64()),
            "score": pa.array(score, pa.float64()),
            "n_bytes": pa.array(np.diff(tx.flat(part["text"])[1]), pa.int64()),
        }))
    return pa.concat_tables(pieces)


def score(
    documents: DataFrame,
    held_out,
    key: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    buckets: int = BUCKETS,
    block_bytes: int = BLOCK_BYTES,
    together: int = BLOCKS_TOGETHER,
) -> DataFrame:
    """Scores every text by a model learnt from the rows where ``held_out`` is false.

    held_out: a boolean column expression over ``documents``; null counts as false.
    Returns ``key``, held_out, n_tokens (words and one end), n_known, train_tokens,
    base_score (unigram log10 probability), score (log10 probability under the tree, the end
    of the text included), n_bytes and bits_per_byte (code length; null for an empty text).

    A null text counts as empty: only its end is coded. Repeated rows are scored once each and
    train as often as they occur; a null key is kept. An empty table gives no rows; without
    training rows every bit has the chance 1/2. Other columns are not read.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth must be 2 to 7")
    spark = documents.sparkSession
    work = Workspace(spark, "ctw")
    held = F.coalesce(held_out, F.lit(False))
    source = documents.select(
        F.col(key).alias("id"), F.col(text).alias("text"), held.alias("held_out")
    )
    table, count = blocked(work, source, "id", "text", block_bytes, ("held_out",))

    salts = -(-count // together)
    entries = work.bucketed(
        table.groupBy("block").applyInArrow(
            lambda t: count_block(t, depth, buckets, together), ENTRY
        ),
        "place", buckets * salts, "entries",
    )
    partial = entries.groupBy("place").applyInArrow(merge, MERGED)
    merged = work.keep(partial.groupBy("kind", "bucket").applyInArrow(merge, MERGED), "merged")

    nodes = (
        merged.where(F.col("kind") == GRAMS)
        .mapInArrow(lambda b: upper_nodes(b, depth), NODE)
        .groupBy("node")
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
        .toPandas()  # at most 256 x 255 rows
    )
    top = Top(nodes["node"].to_numpy(np.int64), *(nodes[c].to_numpy(float) for c in ("zeros", "ones", "weighted")))
    totals = (
        merged.where(F.col("kind") == WORDS)
        .mapInArrow(_word_totals, "total long, distinct long")
        .agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct"))
        .first()
    )
    total, distinct = int(totals["total"] or 0), int(totals["distinct"] or 0)

    model = merged.mapInArrow(
        lambda b: bucket_values(b, depth, top), "kind int, bucket int, keys binary, vals binary"
    ).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    place = _place(F.col("kind"), F.col("bucket"), F.col("salt"), buckets).cast("int")
    model = model.select("kind", "keys", "vals", place.alias("place"))
    answers = (
        entries.select("place", "kind", "bucket", "block", "keys").groupBy("place")
        .cogroup(model.groupBy("place")).applyInArrow(answer, ANSWER)
    )
    scored = table.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda t, a: score_block(t, a, depth, buckets, total, distinct),
        f"id {source.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens long, "
        "n_known long, train_tokens long, base_score double, score double, n_bytes long",
    )
    bits = -F.col("score") * math.log2(10) / F.when(F.col("n_bytes") > 0, F.col("n_bytes"))
    return work.finish(scored.withColumnRenamed("id", key).withColumn("bits_per_byte", bits))


def _word_totals(batches):
    for batch in batches:
        for row in batch.to_pylist():
            counts = unpacked(row["counts"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(counts.sum())]), pa.array([int((counts > 0).sum())])],
                names=["total", "distinct"],
            )
