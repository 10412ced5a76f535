"""Token counts of every prefix of a text, by dynamic programming over a piece vocabulary.

The encoding of a text that ends with a token is the encoding of what comes ahead of that token
and the token itself. So the count at a prefix is one more than the count where its last token
begins, and the last token is the one piece that would be a token alone and that merges with
nothing across the border to the token ahead of it. Whether two neighbours merge depends on the
two alone and is remembered.

A text is first cut wherever no piece of the vocabulary holds the two neighbouring characters;
no merge passes such a place. What lies between is looked up once, however often it occurs.
Counts at all prefixes answer how long a text is, whether it fits and where to cut it without
encoding it again.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts as tx
from tidemark.llm.pretokens import code_points

# The sign that stands for a space, and the kinds of pieces of a model.
SPACE = "▁"
NORMAL, BYTE = 1, 6

#: Tokens of a window that the query asks about.
LIMIT = 4096

#: Remembered neighbours at most; beyond it they are forgotten and found again.
MOST_NEIGHBOURS = 1_000_000


class Vocabulary:
    """Pieces of a BPE model with byte fallback, and their merges by score."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.alone: dict[str, bool] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self._neighbours()

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        plain = rules.add_dummy_prefix and rules.escape_whitespaces and not (
            rules.remove_extra_whitespaces or rules.precompiled_charsmap
            or model.trainer_spec.treat_whitespace_as_suffix
        )
        if model.trainer_spec.model_type != 2 or BYTE not in kinds or kinds - {1, 2, 3, 6} or not plain:
            raise ValueError("needs a BPE model with byte fallback that leaves texts as they are")
        return cls({p.piece: p.score for p in model.pieces if p.type == NORMAL})

    def _neighbours(self) -> None:
        """Which characters stand side by side within a piece, as a table of classes."""
        pairs = {(ord(a), ord(b)) for piece in self.scores for a, b in zip(piece, piece[1:])}
        self.left, self.right = np.zeros((2, 0x110000), np.int32)
        for side, place in ((self.left, 0), (self.right, 1)):
            known = sorted({p[place] for p in pairs})
            side[known] = np.arange(1, len(known) + 1)
        self.beside = np.zeros((self.left.max() + 1, self.right.max() + 1), bool)
        for a, b in pairs:
            self.beside[self.left[a], self.right[b]] = True

    def encode(self, text: str) -> list[str]:
        """Pieces by merging the neighbours of the best score, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                     if a + b in self.scores]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stands_alone(self, piece: str) -> bool:
        known = self.alone.get(piece)
        if known is None:
            known = self.alone[piece] = len(self.encode(piece)) == 1
        return known

    def stay_apart(self, a: str, b: str) -> bool:
        known = self.apart.get((a, b))
        if known is None:
            if len(self.apart) >= MOST_NEIGHBOURS:
                self.apart.clear()
            known = self.apart[a, b] = self.encode(a + b) == [a, b]
        return known

    def tokens_of(self, piece: str) -> int:
        """A piece is a token; a character that is none is a token for each of its bytes."""
        return 1 if piece in self.scores else len(piece.encode())

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters."""
        counts, last = [0], [""]
        for end in range(1, len(text) + 1):
            for size in range(min(end, self.longest), 0, -1):
                piece = text[end - size : end]
                if size > 1 and piece not in self.scores:
                    continue
                ahead = last[end - size]
                if self.stands_alone(piece) and (not ahead or self.stay_apart(ahead, piece)):
                    counts.append(counts[end - size] + self.tokens_of(piece))
                    last.append(piece)
                    break
        return counts[1:]


class Prefixes:
    """Counts at all prefixes of whole batches. Stretches met so far in this worker are kept
    until they take too many bytes."""

    def __init__(self, vocabulary: Vocabulary, most_bytes: int = 48 << 20):
        self.vocabulary = vocabulary
        self.most_bytes = most_bytes
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.held = 0
        self.flat = np.empty(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def _learn(self, stretches: list[bytes]) -> np.ndarray:
        """Numbers of the stretches, after the counts of new ones are worked out."""
        if self.held > self.most_bytes:
            self.forget()
        known = len(self.place)
        number = [self.place.setdefault(s, len(self.place)) for s in stretches]
        fresh = [s for s, i in zip(stretches, number) if i >= known]
        if fresh:
            counts = [self.vocabulary.prefix_counts(s.decode().replace(" ", SPACE)) for s in fresh]
            sizes = np.fromiter(map(len, counts), np.int64, len(counts))
            new = np.fromiter((c for one in counts for c in one), np.int32, int(sizes.sum()))
            self.flat = np.concatenate([self.flat, new])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.held += sum(map(len, fresh)) + 100 * len(fresh) + new.nbytes
        return np.array(number, np.int64)

    def batch(self, column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Counts at the prefixes of 0, 1, 2, ... characters of all texts one after another,
        and the offsets of the texts in them."""
        data, offsets = tx.flat(column, before=b" ")  # the model sets a space ahead of a text
        code, at = code_points(data) if len(data) else (np.empty(0, np.int32), np.empty(0, np.int64))
        code = np.where(code == 0x20, ord(SPACE), code)
        first = np.searchsorted(at, offsets)
        cut = np.ones(len(code), bool)
        kinds = self.vocabulary
        cut[1:] = ~kinds.beside[kinds.left[code[:-1]], kinds.right[code[1:]]]
        cut[first[:-1]] = True
        begin = np.flatnonzero(cut)
        if len(begin) == 0:
            return np.empty(0, np.int64), first
        coded = tx.as_strings(data, np.append(at[begin], len(data))).dictionary_encode()
        number = self._learn(coded.dictionary.to_pylist())
        number = number[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = np.diff(np.append(begin, len(code)))
        counts = self.flat[tx.ranges(self.ends[number], sizes)].astype(np.int64)
        whole = self.flat[self.ends[number + 1] - 1].astype(np.int64)
        ahead = np.cumsum(whole) - whole
        text_of = np.searchsorted(begin, first[:-1])
        ahead -= np.repeat(ahead[text_of], np.diff(np.append(text_of, len(begin))))
        counts += np.repeat(ahead, sizes)
        counts[first[:-1]] = 0  # the space alone stands for the empty prefix
        return counts, first


@lru_cache(maxsize=2)
def _memory(path: str) -> Prefixes:
    return Prefixes(Vocabulary.load(path))


def longest_within(counts: np.ndarray, offsets: np.ndarray, limit: int) -> np.ndarray:
    """Characters of the longest prefix of each text with at most ``limit`` tokens.

    A longer prefix may have fewer tokens than a shorter one, so the last one counts.
    """
    fits = np.flatnonzero(counts <= limit)
    last = fits[np.searchsorted(fits, offsets[1:]) - 1]
    return last - offsets[:-1]


def count_batches(batches, path: str, limit: int, keep: bool):
    memory = _memory(path)
    for part in tx.slices(batches):
        counts, offsets = memory.batch(part["text"])
        total = counts[offsets[1:] - 1]
        columns = [
            tx.one_array(part["id"]),
            pc.fill_null(pc.binary_length(tx.one_array(part["text"])), 0).cast(pa.int64()),
            pa.array(total, pa.int64()),
            pa.array(total > limit, pa.bool_()),
            pa.array(longest_within(counts, offsets, limit), pa.int64()),
        ]
        names = ["id", "n_bytes", "n_tokens", "over_limit", "cut_chars"]
        if keep:
            held = pa.array(counts.astype(np.int32), pa.int32())
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), held))
            names.append("prefix_tokens")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def count(
    documents: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    keep_prefixes: bool = False,
) -> DataFrame:
    """One row per document: ``key``, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``
    tokens) and cut_chars, the characters of its longest prefix with at most ``limit`` tokens.

    model: file of a piece model, readable under that path on every machine; a BPE model with
    byte fallback that changes nothing in a text but spaces. Strings of its special tokens are
    ordinary text. With ``keep_prefixes`` the column prefix_tokens holds the count at every
    prefix, from no character to all: ``tokens_at`` and ``longest_prefix`` answer
    from it with any limit.

    A null or empty text has no tokens. Repeated rows and null keys come out as they came in, an
    empty table gives no rows, other columns are not read. A text takes memory in proportion to
    its own length.
    """
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long"
    if keep_prefixes:
        schema += ", prefix_tokens array<int>"
    found = rows.mapInArrow(lambda b: count_batches(b, model, limit, keep_prefixes), schema)
    return found.withColumnRenamed("id", key)


def tokens_at(prefix_tokens: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` characters; null beyond the text."""
    return F.get(prefix_tokens, F.lit(chars) if isinstance(chars, int) else chars)


def longest_prefix(prefix_tokens: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix within ``budget`` tokens."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    places = F.transform(prefix_tokens, lambda n, i: F.when(n <= budget, i))
    return F.array_max(places)


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")
