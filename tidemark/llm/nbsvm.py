"""Naive Bayes support vectors: a linear quality classifier over n-gram indicators.

Indicators are byte trigrams, word shapes, pairs of word shapes and how often a word repeats
the one before, hashed into a fixed number of features. Each is scaled by its log-count ratio
between the classes, counted over all labelled training rows. A hinge-loss model is fitted by
dual coordinate descent on a bounded sample of those rows, and its margins are turned into
chances on rows of the sample that the fit did not see.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import texts as tx
from tidemark.llm.shingles import CELL_PIECE, cell_pieces, counted_cells

#: Hashed features; the ratios and weights are 2 MiB each, whatever the input.
FEATURES = 1 << 18

#: Labelled rows that the model is fitted on, by the smallest hashes of their keys.
SAMPLE_ROWS = 12_000

#: Text whose features a task holds at once; they take some hundred times as much memory.
PART_BYTES = 1 << 19

COST = 1.0
ROUNDS = 12
SMOOTHING = 1.0

# Fixed classes of bytes for shapes: letters, digits, others stand for themselves.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[ord("A") : ord("Z") + 1] = ord("A")
SHAPE[ord("a") : ord("z") + 1] = ord("a")
SHAPE[ord("0") : ord("9") + 1] = ord("0")
SHAPE[128:] = ord("a")


def shapes(data: np.ndarray, starts: np.ndarray, keep_digits: bool = False):
    """Number of each word's shape, runs taken together, and the distinct shapes."""
    kind = SHAPE[data]
    inside = ~tx.WHITE[data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    if keep_digits:
        keep |= kind == ord("0")
    keep[starts] = True
    keep &= inside
    before = np.concatenate([[0], np.cumsum(keep)])
    offsets = np.append(before[starts], before[-1])
    coded = tx.as_strings(kind[keep], offsets).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def features(column, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of every text: text numbers and features, sorted by both."""
    data, offsets = tx.flat(column, after=b" ")
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(n), lengths)
    gram = data.astype(np.uint64)
    three = (gram[:-2] << np.uint64(16)) | (gram[1:-1] << np.uint64(8)) | gram[2:]
    found, docs = [three[owner[:-2] == owner[2:]]], [owner[:-2][owner[:-2] == owner[2:]]]
    starts, ends = tx.word_bounds(data)
    if len(starts):
        doc = owner[starts]
        code, names = shapes(data, starts)
        shape = tx.hashes(names)[code]
        pair = shape[:-1] * np.uint64(31) + shape[1:]
        near = doc[1:] == doc[:-1]
        words, _ = tx.word_codes(data, starts, ends)
        again = np.bincount(doc[1:][near & (words[1:] == words[:-1])], minlength=n)
        count = np.bincount(doc, minlength=n)
        share = np.ceil(10 * again / np.maximum(count, 1)).astype(np.uint64)
        some = np.flatnonzero(count)
        found += [shape ^ np.uint64(1 << 40), pair[near] ^ np.uint64(1 << 41),
                  share[some] + np.uint64(1 << 42)]
        docs += [doc, doc[1:][near], some]
    hashed = (tx.mix(np.concatenate(found)) >> np.uint64(24)).astype(np.int64) % size
    both = np.unique(np.concatenate(docs) * size + hashed)
    return both // size, both % size


def count_batches(batches, size: int):
    """How many texts of either class have each feature, and how many texts there are."""
    counts = np.zeros(2 * size + 2, np.int64)
    for part in tx.slices(batches, most=PART_BYTES):
        label = part["label"].to_numpy().astype(np.int64)
        doc, feature = features(part["text"], size)
        counts += np.bincount(label[doc] * size + feature, minlength=2 * size + 2)
        counts[-2:] += np.bincount(label, minlength=2)
    yield cell_pieces(counts)


def log_ratios(counts: np.ndarray, size: int) -> np.ndarray:
    """Log of the classes' shares of each feature."""
    share = [
        (counts[c * size : (c + 1) * size] + SMOOTHING) / (counts[2 * size + c] + 2 * SMOOTHING)
        for c in (0, 1)
    ]
    return np.log(share[1] / share[0])


def feature_batches(batches, size: int):
    for part in tx.slices(batches, most=PART_BYTES):
        doc, feature = features(part["text"], size)
        cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
        yield pa.RecordBatch.from_arrays([
            tx.one_array(part["label"]),
            pa.array([feature[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ], names=["label", "features"])


def descend(
    rows: list, labels: np.ndarray, ratios: np.ndarray, cost: float = COST, rounds: int = ROUNDS
) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; rows are features, scaled when needed.

    The last weight belongs to a constant feature. Classes weigh the same in total.
    """
    size = len(ratios)
    weights = np.zeros(size + 1)
    sign = np.where(labels == 1, 1.0, -1.0)
    share = np.bincount(labels, minlength=2)
    bound = cost * len(labels) / (2.0 * np.maximum(share, 1))[labels]
    square = np.array([float(v @ v) + 1.0 for v in (scaled(at, ratios) for at in rows)])
    alpha = np.zeros(len(rows))
    random = np.random.default_rng(11)
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            at, value = rows[i], scaled(rows[i], ratios)
            slope = sign[i] * (value @ weights[at] + weights[size]) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), bound[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weights[at] += step * value
                weights[size] += step
                alpha[i] = new
    return weights


def chance_line(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, by Newton's method."""
    share = np.bincount(labels, minlength=2)
    target = np.where(labels == 1, (share[1] + 1) / (share[1] + 2), 1 / (share[0] + 2))
    line = np.array([1.0, float(np.log((share[1] + 1) / (share[0] + 1)))])
    x = np.column_stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -500, 500)))
        gradient = x.T @ (p - target) + np.array([1e-3 * (line[0] - 1), 0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        line = line - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(line[0], 0.0)), float(line[1])


def scaled(feature: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    value = ratios[feature]
    norm = np.sqrt(value @ value)
    return value / norm if norm > 0 else value


@dataclass
class Model:
    """weights: of the scaled features; the last one is the constant."""

    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def chance(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def feature_rows(column: pa.Array) -> list[np.ndarray]:
    """The features of each row, as parts of the column's own memory."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset :][: len(column) + 1] // 4
    flat = np.frombuffer(data, np.int32, ends[-1]) if ends[-1] else np.empty(0, np.int32)
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def fit_sample(table: pa.Table, ratios: np.ndarray) -> Model:
    labels = table["label"].to_numpy().astype(np.int64)
    rows = feature_rows(tx.one_array(table["features"]))
    size = len(ratios)
    check = np.arange(len(rows)) % 4 == 0
    if len(rows) < 40 or len(np.unique(labels[check])) < 2 or len(np.unique(labels[~check])) < 2:
        check[:] = True
        weights = descend(rows, labels, ratios)
    else:
        weights = descend([r for r, c in zip(rows, check) if not c], labels[~check], ratios)
    margins = np.array([
        scaled(at, ratios) @ weights[at] + weights[size] for at, c in zip(rows, check) if c
    ])
    return Model(ratios, weights, *chance_line(margins, labels[check]))


def score_batches(batches, shared, size: int):
    model = shared.value
    weight = model.ratios * model.weights[:size]
    square = model.ratios**2
    for part in tx.slices(batches, most=PART_BYTES):
        n = part.num_rows
        doc, feature = features(part["text"], size)
        norm = np.sqrt(tx.sums(doc, square[feature], n))
        margin = tx.sums(doc, weight[feature], n) / np.where(norm > 0, norm, 1) + model.weights[size]
        out = part.append_column("score", pa.array(model.chance(margin), pa.float64()))
        yield from out.to_batches()


def fit(
    documents: DataFrame,
    labels: DataFrame,
    held_out: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    size: int = FEATURES,
    sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """Learns from labelled rows where ``held_out`` (over the key column ``key``) is false.

    Ratios count all such rows; the hinge-loss fit sees at most ``sample_rows`` of them, one per
    key. Rows
    with a null label are no labelled rows. Returns None if there is none.
    """
    known = labels.where(F.col(label).isin(0, 1)).where(~F.coalesce(held_out, F.lit(False)))
    known = known.groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("label"))
    source = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    # Both sides are dealt by key at every size; neither is taken for small.
    rows = source.join(known.hint("merge"), "id").select("text", "label")
    counts = counted_cells(rows.mapInArrow(lambda b: count_batches(b, size), CELL_PIECE), 2 * size + 2)
    if not counts[-2:].any():
        return None
    ratios = log_ratios(counts, size)
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    sample = (
        source.join(F.broadcast(chosen), "id")
        .groupBy("id").agg(F.min(F.struct("text", "label")).alias("row"))  # one row per key
        .orderBy(F.xxhash64("id")).select("row.*")
        .mapInArrow(lambda b: feature_batches(b, size), "label int, features binary")
    )
    model = fit_sample(sample.toArrow(), ratios)  # at most sample_rows rows
    tx.give_back()
    return model


def score(
    documents: DataFrame,
    model: Model | None,
    text: str = "text",
    size: int = FEATURES,
) -> DataFrame:
    """The documents with a column ``score``: the chance of label 1.

    A null or empty text has no features and gets the model's constant; without a model every
    row gets 0.5. All rows and columns stay, whatever they hold; a column that is named score
    already is replaced.
    """
    rest = documents.drop("score")
    if model is None:
        return rest.withColumn("score", F.lit(0.5))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    inner = rest.select(F.struct(*rest.columns).alias("row"), F.col(text).alias("text"))
    out = inner.mapInArrow(
        lambda b: score_batches(b, shared, size),
        T.StructType([*inner.schema.fields, T.StructField("score", T.DoubleType())]),
    )
    return out.select("row.*", "score")
