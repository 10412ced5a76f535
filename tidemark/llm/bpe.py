"""Byte-level BPE as a tree reduction.

A piece is halved down to short leaves. Leaves are encoded many at a time. Two encoded
neighbours are joined by encoding anew a window of tokens around the border; the window grows
until its outer tokens come out as they went in. Then every pair of adjoining tokens is one
that encoding leaves as it is, either by an earlier step or within the window, and a row of
tokens all of whose adjoining pairs are left as they are is the encoding of its bytes.
Texts are sequences of pieces that never merge, so on top of the pieces joining is appending.
Decoding appends the bytes of the tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts as tx
from tidemark.llm.pretokens import PieceIds

#: Longest leaf in bytes, tokens on either side of a border at first, longest row of the
#: encoder that works on many rows at once.
LEAF_BYTES = 16
WINDOW = 2
ROW_BYTES = 64

NEVER = np.iinfo(np.int32).max


class Vocabulary:
    """Tokens and what two adjoining ones merge into."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        pairs.sort()
        self.pairs = np.array([p for p, _ in pairs], np.int64)
        self.merged = np.array([m for _, m in pairs], np.int32)
        self.ends = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])])
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)

    @staticmethod
    @lru_cache(maxsize=4)
    def load(path: str) -> "Vocabulary":
        with open(path, "rb") as lines:
            parts = (line.split() for line in lines if line.strip())
            return Vocabulary({base64.b64decode(a): int(b) for a, b in parts})

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Token that two tokens merge into, NEVER if none."""
        if len(self.pairs) == 0:
            return np.full(left.shape, NEVER, np.int32)
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (right >= 0) & (left >= 0), self.merged[at], NEVER)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a row of tokens."""
        return self.flat[tx.ranges(self.ends[ids], self.ends[ids + 1] - self.ends[ids])]

    # -- leaves and windows ---------------------------------------------------------------

    def encode_rows(self, rows: list[bytes]) -> list[list[int]]:
        """Encodes short strings, rows of about one length together."""
        out: list[list[int]] = [[]] * len(rows)
        short: dict[int, list[int]] = {}
        for i, row in enumerate(rows):
            whole = self.ranks.get(row)
            if whole is not None:
                out[i] = [whole]
            elif len(row) > ROW_BYTES:
                out[i] = self.encode_one(row)
            elif row:
                short.setdefault(-(-len(row) // 4) * 4, []).append(i)
        for width, at in short.items():
            for begin in range(0, len(at), 20_000):
                some = at[begin : begin + 20_000]
                for i, ids in zip(some, self._matrix([rows[i] for i in some], width)):
                    out[i] = ids
        return out

    def _matrix(self, rows: list[bytes], width: int) -> list[list[int]]:
        raw = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8)
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        column = np.arange(width)
        ids = np.where(column < size[:, None], self.bytes[raw.reshape(-1, width)], -1)
        rank = np.full(ids.shape, NEVER, np.int32)
        rank[:, :-1] = self.merge_of(ids[:, :-1], ids[:, 1:])
        live = np.arange(len(rows))
        while len(live):
            part = rank[live]
            j = part.argmin(1)  # the first of equals
            best = part[np.arange(len(live)), j]
            go = best < NEVER
            live, j, best = live[go], j[go], best[go]
            if len(live) == 0:
                break
            moved = column + (column > j[:, None])
            moved[:, -1] = np.minimum(moved[:, -1], width - 1)
            row, rk = ids[live], rank[live]
            last = moved >= width
            moved[last] = width - 1
            row = np.take_along_axis(row, moved, 1)
            rk = np.take_along_axis(rk, moved, 1)
            row[:, -1], rk[:, -1] = -1, NEVER
            at = np.arange(len(live))
            row[at, j] = best
            rk[at, j] = self.merge_of(best, row[at, np.minimum(j + 1, width - 1)])
            rk[at[j == width - 1], width - 1] = NEVER
            has_left = j > 0
            rk[at[has_left], j[has_left] - 1] = self.merge_of(
                row[at[has_left], j[has_left] - 1], best[has_left]
            )
            ids[live], rank[live] = row, rk
        count = (ids >= 0).sum(1)
        return [row[:n] for row, n in zip(ids.tolist(), count.tolist())]

    def encode_one(self, row: bytes) -> list[int]:
        """One longer string: the lowest merge first, by a heap over linked tokens."""
        ids = self.bytes[np.frombuffer(row, np.uint8)].tolist()
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        tokens, ranks = self.tokens, self.ranks
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0:
                rank = ranks.get(tokens[ids[i]] + tokens[ids[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else -1
            if j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]

    # -- the tree -------------------------------------------------------------------------

    def join(self, pairs: list[tuple[list[int], list[int]]], window: int = WINDOW) -> list[list[int]]:
        """Encodings of the joined bytes of pairs of encodings."""
        out: list[list[int]] = [[]] * len(pairs)
        open_ = [(i, min(window, len(a)), min(window, len(b))) for i, (a, b) in enumerate(pairs)]
        while open_:
            texts = []
            for i, a, b in open_:
                left, right = pairs[i]
                tokens = left[len(left) - a :] + right[:b]
                texts.append(b"".join(self.tokens[t] for t in tokens))
            grown = []
            for (i, a, b), middle in zip(open_, self.encode_rows(texts)):
                left, right = pairs[i]
                keeps_left = a == len(left) or (middle and middle[0] == left[-a])
                keeps_right = b == len(right) or (middle and middle[-1] == right[b - 1])
                if keeps_left and keeps_right:
                    out[i] = left[: len(left) - a] + middle + right[b:]
                else:
                    grown.append((
                        i,
                        a if keeps_left else min(2 * a, len(left)),
                        b if keeps_right else min(2 * b, len(right)),
                    ))
            open_ = grown
        return out

    def encode_pieces(self, pieces: list[bytes], leaf: int = LEAF_BYTES) -> list[list[int]]:
        """Encodes pieces, each by itself: leaves first, then joins level by level."""
        parts: list[bytes] = []
        bounds = [0]
        for piece in pieces:
            if len(piece) <= leaf or piece in self.ranks:
                parts.append(piece)
            else:
                count = 1 << (-(-len(piece) // leaf) - 1).bit_length()
                cuts = [len(piece) * k // count for k in range(count + 1)]
                parts.extend(piece[a:b] for a, b in zip(cuts, cuts[1:]))
            bounds.append(len(parts))
        coded = self.encode_rows(parts)
        level = [coded[a:b] for a, b in zip(bounds, bounds[1:])]
        deep = [i for i, row in enumerate(level) if len(row) > 1]
        while deep:
            pairs = [pair for i in deep for pair in zip(level[i][::2], level[i][1::2])]
            joined = iter(self.join(pairs))
            for i in deep:
                level[i] = [next(joined) for _ in range(len(level[i]) // 2)]
            deep = [i for i in deep if len(level[i]) > 1]
        return [row[0] if row else [] for row in level]


@lru_cache(maxsize=2)
def _memory(path: str) -> PieceIds:
    return PieceIds(Vocabulary.load(path).encode_pieces)


def encode_batches(batches, path: str, digest_only: bool):
    vocabulary, memory = Vocabulary.load(path), _memory(path)
    for part in tx.slices(batches):
        ids, counts = memory.batch(part["text"])
        decoded = vocabulary.decode(ids)
        sizes = np.diff(vocabulary.ends)[ids]
        cuts = np.concatenate([[0], np.cumsum(counts)])
        ends = np.concatenate([[0], np.cumsum(sizes)])[cuts]
        raw = ids.astype("<u4")
        if digest_only:
            columns = [
                pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])], pa.string()),
                pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(ends, ends[1:])], pa.string()),
            ]
            names = ["ids_sha256", "decoded_sha256"]
        else:
            columns = [
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32())),
                tx.as_strings(decoded, ends).cast(pa.binary()),
            ]
            names = ["ids", "decoded"]
        yield pa.RecordBatch.from_arrays(
            [tx.one_array(part["id"]), pa.array(counts, pa.int64()), *columns],
            names=["id", "n_tokens", *names],
        )


def encode(
    documents: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    digest_only: bool = False,
) -> DataFrame:
    """Ids of every text by the ranks in the file ``vocabulary``, and the text decoded back.

    The file must be readable under that path on every machine. Returns ``key``, n_tokens,
    ids (array of int) and decoded (binary); with ``digest_only`` ids_sha256 and
    decoded_sha256 (lowercase hex) in their place.

    A null or empty text has no ids and decodes to no bytes. Rows are independent: repeated
    rows and null keys come out as they came in, an empty table gives no rows, other columns
    are not read. A very long text costs memory in proportion to itself.
    """
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    found = (
        "ids_sha256 string, decoded_sha256 string" if digest_only
        else "ids array<int>, decoded binary"
    )
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, {found}"
    coded = rows.mapInArrow(lambda b: encode_batches(b, vocabulary, digest_only), schema)
    return coded.withColumnRenamed("id", key)


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")
