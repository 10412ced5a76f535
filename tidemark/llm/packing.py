"""Packing documents into fixed-length sequences by non-negative least squares.

A document longer than a sequence is cut into full sequences and a rest; rests and short
documents stay whole. Their lengths form a histogram of at most ``length`` numbers, which is
all that the plan needs: ways to fill a sequence with two or three pieces are listed, a
non-negative least-squares problem gives how often each is used, the counts are rounded down to
what the histogram has, and what is left is packed greedily, longest first, each gap by the
longest piece that fits. A plan is a list of fillings with how often each occurs, so its size
follows the number of lengths and not the number of documents.

Pieces then take their places by rank within their length. Ranks come from counts per length
and lane; lanes split a length that many documents share.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import texts as tx
from tidemark.llm.pretokens import PieceIds
from tidemark.llm.workspace import Workspace

LENGTH = 2048
END_ID = 1

#: Lengths that fillings of three pieces start from: the commonest ones.
COMMON_LENGTHS = 48

#: Steps of the least-squares solver.
SOLVER_STEPS = 400

#: Pieces that one task ranks.
LANE_ROWS = 1_000

PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


class Ids:
    """Ids of whole texts as the library gives them by default: distinct pieces are looked up
    once, texts that hold a special token's string go to the library as a whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        plain = Tokenizer.from_file(path)
        plain.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = "|".join(re.escape(t.content) for t in added if t.content)

        def encode(pieces: list[bytes]) -> list[list[int]]:
            words = [p.decode() for p in pieces]
            return [e.ids for e in plain.encode_batch_fast(words, add_special_tokens=False)]

        self.memory = PieceIds(encode)

    def batch(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids per text."""
        column = tx.one_array(column)
        ids, counts = self.memory.batch(column)
        if not self.special:
            return ids, counts
        marked = pc.match_substring_regex(pc.fill_null(column, ""), self.special)
        hit = np.flatnonzero(np.asarray(marked))
        if len(hit) == 0:
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in hit:
            text = column[int(i)].as_py()
            parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, ids.dtype)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def cut_batches(batches, path: str, length: int, end_id: int):
    """The pieces of every text: full sequences first, the rest last."""
    memory = tx.kept(("packing", path), lambda: Ids(path))
    for part in tx.slices(batches, keeps=("packing", path)):
        ids, counts = memory.batch(part["text"])
        end = np.cumsum(counts + 1)
        every = np.full(int(end[-1]), end_id, "<u4")
        every[tx.ranges(end - counts - 1, counts)] = ids
        tokens = counts + 1
        pieces = -(-tokens // length)
        doc = np.repeat(np.arange(len(tokens)), pieces)
        start = tx.ranges(np.zeros(len(pieces), np.int64), pieces) * length
        size = np.minimum(length, tokens[doc] - start)
        at = (end - tokens)[doc] + start
        crc = [zlib.crc32(every[a:b]) for a, b in zip(at, at + size)]
        yield pa.RecordBatch.from_arrays(
            [
                tx.one_array(part["id"].take(pa.array(doc))),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(tokens[doc], pa.int64()),
            ],
            names=["id", "start", "length", "ids_crc32", "doc_tokens"],
        )


def fillings(counts: np.ndarray, common: int = COMMON_LENGTHS) -> np.ndarray:
    """Rows of up to three lengths that fill a sequence, of lengths that occur; 0: no piece."""
    length = len(counts) - 1
    present = np.flatnonzero(counts[1:]) + 1
    rows = [np.column_stack([present, length - present, 0 * present])]
    for a in present[np.argsort(-counts[present], kind="stable")][:common]:
        rows.append(np.column_stack([np.full(len(present), a), present, length - a - present]))
    every = np.concatenate(rows)
    every = every[(every >= 0).all(1)]
    every = every[((counts[every] > 0) | (every == 0)).all(1)]
    return np.unique(-np.sort(-every, 1), axis=0)


def solve(rows: np.ndarray, counts: np.ndarray, steps: int = SOLVER_STEPS) -> np.ndarray:
    """How often each filling is used: least squares with no negative number, by projected
    gradients with momentum. Pieces count by their length, so that long ones come first."""
    size = len(counts)
    use = (rows > 0).astype(float) * np.sqrt(rows / (size - 1))
    target = counts * np.sqrt(np.arange(size) / (size - 1))
    flat = rows.ravel()

    def apply(x):
        return np.bincount(flat, (use * x[:, None]).ravel(), size)

    norm = np.random.default_rng(0).random(len(rows))
    for _ in range(20):  # the largest eigenvalue bounds the step
        norm = (use * apply(norm)[rows]).sum(1)
        top = np.linalg.norm(norm)
        norm /= top
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        gradient = (use * (apply(y) - target)[rows]).sum(1)
        new = np.maximum(0, y - gradient / (1.05 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Fillings and how often each is used; uses up the histogram exactly.

    counts: pieces per length, from length 0 (none) to the length of a sequence.
    """
    left = counts.astype(np.int64).copy()
    length = len(left) - 1
    used: list[tuple[list[int], int]] = []

    def take(pieces: list[int], most: int | None = None) -> None:
        kinds, times = np.unique(pieces, return_counts=True)
        n = int((left[kinds] // times).min())
        n = n if most is None else min(n, most)
        if n > 0:
            left[kinds] -= n * times
            used.append((pieces, n))

    if left[length]:
        take([length])
    if left.any():
        rows = fillings(left)
        if len(rows):
            amount = solve(rows, left)
            for i in np.argsort(-amount, kind="stable"):
                if amount[i] < 0.5:
                    break
                take([int(v) for v in rows[i] if v], int(round(amount[i])))
    while True:
        rest = np.flatnonzero(left)
        if len(rest) == 0:
            return used
        spare = left[rest].copy()
        pieces, gap = [], length
        while True:
            at = np.searchsorted(rest, gap, "right") - 1
            while at >= 0 and spare[at] == 0:
                at -= 1
            if at < 0:
                break
            spare[at] -= 1
            pieces.append(int(rest[at]))
            gap -= pieces[-1]
        take(pieces)


def places(used: list[tuple[list[int], int]], length: int) -> dict[str, np.ndarray]:
    """For each length the ranks that each filling takes, as sorted rows.

    Row: length, first rank, first sequence, offset. Rank r at first rank f goes to sequence
    first + (r - f).
    """
    taken = np.zeros(length + 1, np.int64)
    rows, sequence = [], 0
    for pieces, times in used:
        offset = 0
        for piece in pieces:
            rows.append((piece, int(taken[piece]), sequence, offset))
            taken[piece] += times
            offset += piece
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 4)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def place_batches(batches, rows: dict[str, np.ndarray]):
    """Sequence and offset of every ranked piece."""
    width = np.int64(1) << 50
    order = rows["length"] * width + rows["rank"]
    for batch in batches:
        table = pa.Table.from_batches([batch])
        key = table["length"].to_numpy() * width + table["rank"].to_numpy()
        at = np.searchsorted(order, key, "right") - 1
        sequence = rows["sequence"][at] + table["rank"].to_numpy() - rows["rank"][at]
        yield from (
            table.drop_columns(["rank"])
            .append_column("sequence_id", pa.array(sequence, pa.int64()))
            .append_column("offset", pa.array(rows["offset"][at], pa.int64()))
            .to_batches()
        )


def pack(
    documents: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    lane_rows: int = LANE_ROWS,
) -> DataFrame:
    """One row per piece: ``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    tokenizer: file of the ``tokenizers`` library, readable under that path on every machine;
    ``end_id`` follows the ids of every document. A sequence is as long as its pieces together
    and is padded to ``length``.

    A null or empty text is one piece holding the end alone. Repeated rows and null keys are
    packed like any row; an empty table gives no rows; other columns are not read.
    """
    work = Workspace(documents.sparkSession, "packing")
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {PIECE}"
    pieces = work.keep(
        rows.mapInArrow(lambda b: cut_batches(b, tokenizer, length, end_id), schema), "pieces"
    )
    histogram = pieces.groupBy("length").count().toPandas()  # at most ``length`` rows
    counts = np.zeros(length + 1, np.int64)
    counts[histogram["length"].to_numpy(np.int64)] = histogram["count"].to_numpy(np.int64)
    where = places(plan(counts), length)
    tx.give_back()

    lanes = max(1, -(-int(counts.max()) // lane_rows))
    lane = F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(lanes)).cast("int")
    pieces = pieces.withColumn("lane", lane)
    by_length = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        pieces.groupBy("length", "lane").count()
        .withColumn("before", F.coalesce(F.sum("count").over(by_length), F.lit(0)))
        .drop("count")
    )
    within = Window.partitionBy("length", "lane").orderBy("id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("nth", F.row_number().over(within) - 1)
        .join(before, ["length", "lane"])
        .select("id", "start", "length", "ids_crc32", "doc_tokens",
                (F.col("nth") + F.col("before")).alias("rank"))
    )
    placed = ranked.mapInArrow(
        lambda b: place_batches(b, where), f"{schema}, sequence_id long, offset long"
    )
    return work.finish(placed.withColumnRenamed("id", key))


def default_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")
