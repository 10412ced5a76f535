"""Drawing documents that look like a target: importance resampling over hashed features.

Features are words and pairs of neighbouring words, each in the bucket of its CRC. The counts of
all buckets over corpus and target give every bucket a gain, a document weighs the mean gain of
its features, and the highest weights plus noise that depends on the key are drawn.

The head of the vocabulary is broadcast: of the frequent words their CRC, after the word and
after the space behind it, and of every pair of the most frequent ones its bucket. Any other
feature gets its CRC directly, a pair by going on from the state of its first word. Which words
are in the head changes the time only, since both ways give the same bucket; so the head comes
from a bounded sample, while all counts are over all texts.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import texts as tx
from tidemark.llm.workspace import Workspace

BUCKETS = 10_000

#: Share of the documents that is drawn, in hundredths, and the words that a drawn one has.
DRAWN_PERCENT = 25
LEAST_WORDS = 20

#: Rows of the sample that the head is taken from; words of the head, and how many of them
#: have all their pairs in the table (two bytes a pair).
SAMPLE_ROWS = 2_000
HEAD_WORDS = 20_000
HEAD_PAIRED = 1_000

#: Bytes of words: digits, lower-case letters and all beyond ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Head:
    """words by frequency; crc after each and after the space behind it; buckets of pairs of
    the first ones."""

    words: pa.Array
    crc: np.ndarray
    spaced: np.ndarray
    pairs: np.ndarray


def make_head(words: list[bytes], buckets: int, paired: int = HEAD_PAIRED) -> Head:
    crc = [zlib.crc32(w) for w in words]
    spaced = [zlib.crc32(b" ", c) for c in crc]
    first = words[:paired]
    pairs = [[zlib.crc32(b, s) % buckets for b in first] for s in spaced[:paired]]
    return Head(
        pa.array(words, pa.large_binary()),
        np.array(crc, np.uint32),
        np.array(spaced, np.uint32),
        np.array(pairs, np.uint16 if buckets <= 1 << 16 else np.uint32).reshape(len(first), len(first)),
    )


def words_of(column) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of all words in order, the distinct words, and the words per text."""
    data, offsets = tx.flat(column, after=b"\n")
    data = tx.LOWER[data]
    inside = INSIDE[data]
    change = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    coded = tx.as_strings(data[inside], bounds).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, coded.dictionary, np.diff(np.searchsorted(starts, offsets))


def feature_buckets(column, head: Head, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature, the text that it is of, and the words per text."""
    codes, distinct, counts = words_of(column)
    names = distinct.to_pylist()
    place = pc.fill_null(pc.index_in(distinct, head.words), -1).to_numpy(zero_copy_only=False)
    crc, spaced = np.empty(len(names), np.uint32), np.empty(len(names), np.uint32)
    known = place >= 0
    crc[known], spaced[known] = head.crc[place[known]], head.spaced[place[known]]
    for i in np.flatnonzero(~known).tolist():  # the tail
        crc[i] = zlib.crc32(names[i])
        spaced[i] = zlib.crc32(b" ", int(crc[i]))
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.flatnonzero(doc[1:] == doc[:-1])
    a, b = codes[first], codes[first + 1]
    pair = np.empty(len(first), np.int64)
    in_table = known & (place < len(head.pairs))
    table = in_table[a] & in_table[b]
    pair[table] = head.pairs[place[a[table]], place[b[table]]]
    left, right = spaced[a[~table]].tolist(), b[~table].tolist()
    crc32 = zlib.crc32
    pair[~table] = [crc32(names[w], s) % buckets for w, s in zip(right, left)]
    return np.concatenate([crc[codes] % buckets, pair]), np.concatenate([doc, doc[first]]), counts


def total_batches(batches, shared, buckets: int):
    total = np.zeros(buckets, np.int64)
    for part in tx.slices(batches):
        bucket, _, _ = feature_buckets(part["text"], shared.value, buckets)
        total += np.bincount(bucket, minlength=buckets)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["bucket", "n"]
    )


def totals(texts: DataFrame, head, buckets: int) -> np.ndarray:
    """Features per bucket over all texts; each task sends one row per bucket at most."""
    parts = texts.mapInArrow(lambda b: total_batches(b, head, buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most ``buckets`` rows
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier a bucket is in the target."""
    s_all, t_all, size = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
            for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())
        ],
        np.int64,
    )


def weight_batches(batches, shared, gain: np.ndarray):
    for part in tx.slices(batches):
        bucket, doc, counts = feature_buckets(part["text"], shared.value, len(gain))
        features = np.bincount(doc, minlength=len(counts))
        total = np.zeros(len(counts), np.int64)
        np.add.at(total, doc, gain[bucket])
        weight = np.where(features > 0, total // np.maximum(features, 1), 0)
        yield pa.RecordBatch.from_arrays(
            [
                tx.one_array(part["id"]),
                pa.array(counts, pa.int64()),
                pa.array(features, pa.int64()),
                pa.array(weight, pa.int64()),
            ],
            names=["id", "n_words", "n_features", "weight"],
        )


def head_batches(batches):
    for part in tx.slices(batches):
        codes, distinct, _ = words_of(part["text"])
        n = np.bincount(codes, minlength=len(distinct))
        yield pa.RecordBatch.from_arrays(
            [distinct.cast(pa.binary()), pa.array(n, pa.int64())], names=["word", "n"]
        )


def frequent_words(rows: DataFrame, most: int, sample_rows: int) -> list[bytes]:
    """The words that occur most often in a sample of rows with the least hashes of their
    keys."""
    if most == 0:
        return []
    chosen = rows.select(F.xxhash64("id").alias("h")).orderBy("h").limit(sample_rows)
    last = chosen.agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return []
    # rows that share a key share its hash, so the rows are bounded once more
    sample = rows.where(F.xxhash64("id") <= last).limit(sample_rows)
    counted = sample.select("text").mapInArrow(head_batches, "word binary, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word")
    return [bytes(r["word"]) for r in counted.limit(most).collect()]


def noise(seed: int, key: str):
    """Thousandths of Gumbel noise from 32 bits of a digest of seed and key."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((bits + 0.5) / 4294967296)))


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """Adds rank 1, 2, ... to the ``drawn`` rows of the highest score among those that may be
    drawn, ties by id; null to all others. ``lane`` splits rows that share score and id.

    A row's rank is the number of rows above its score, of rows of its score ahead of its id
    and lane, and its place there. Rows below the last score that is drawn are not ranked.
    """
    may = rows.where("may")
    by_score = may.groupBy("score").agg(F.count("*").alias("n"))  # as many rows as scores
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    by_score = by_score.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
    by_score = by_score.where(F.col("above") < drawn).select("score", "above")
    last = by_score.agg(F.min("score").alias("s")).first()["s"]
    if last is None:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    reached = F.col("may") & (F.col("score") >= last)
    some, rest = rows.where(reached), rows.where(~reached)
    ahead = Window.partitionBy("score").orderBy("id", "lane").rowsBetween(Window.unboundedPreceding, -1)
    groups = some.groupBy("score", "id", "lane").agg(F.count("*").alias("n"))
    groups = groups.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).join(by_score, "score")
    groups = groups.select(
        F.col("score").alias("s"), F.col("id").alias("i"), F.col("lane").alias("l"),
        (F.col("above") + F.col("ahead")).alias("before"),
    )
    same = (F.col("score") == F.col("s")) & F.col("id").eqNullSafe(F.col("i")) & (F.col("lane") == F.col("l"))
    nth = F.row_number().over(Window.partitionBy("score", "id", "lane").orderBy("n_features"))
    some = some.withColumn("nth", nth).join(groups, same)
    rank = F.col("before") + F.col("nth")
    some = some.withColumn("rank", F.when(rank <= drawn, rank)).select(*rows.columns, "rank")
    return some.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(
    documents: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = 7,
    head_words: int = HEAD_WORDS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: ``key``, n_words, n_features, weight, score and rank, all long.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred (rounded
    down) are drawn, those of the highest score, ties to the smaller key; rank is their place,
    null for the others. Features are the lower-cased words and neighbouring pairs, weight the
    mean gain of a document's features rounded down, 0 without any; score adds noise that
    depends on ``seed`` and key only.

    Null and empty texts have no features. Repeated rows are documents each, with the same score
    and ranks one after another; a null key comes first among equals and has the noise of an
    empty key. An empty corpus gives no rows, an empty target leaves all gains to the corpus.
    Other columns are not read.
    """
    spark = documents.sparkSession
    work = Workspace(spark, "resample")
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    head = make_head(frequent_words(rows, head_words, sample_rows), buckets)
    shared = spark.sparkContext.broadcast(head)  # at most head_words words and the pairs' table
    gain = gains(
        totals(rows.select("text"), shared, buckets),
        totals(target.select(F.col(target_text).alias("text")), shared, buckets),
    )
    kind = rows.schema["id"].dataType.simpleString()
    weighed = rows.mapInArrow(
        lambda b: weight_batches(b, shared, gain), f"id {kind}, n_words long, n_features long, weight long"
    )
    scored = work.keep(
        weighed.withColumn("score", F.col("weight") + noise(seed, "id"))
        .withColumn("may", F.col("n_words") >= least_words)
        .withColumn("lane", F.spark_partition_id()),
        "scored",
    )
    drawn = percent * scored.where("may").count() // 100
    out = ranked(scored, drawn).select(
        F.col("id").alias(key), "n_words", "n_features", "weight", "score", "rank"
    )
    return work.finish(out)
