"""The split of texts that public byte-level vocabularies use, on whole batches at once.

Same pieces as the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
but found from runs of character classes instead of one match after another.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from tidemark.llm import texts as tx

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3

# The code points of the property White_Space, and the listed contractions.
WHITE_SPACE = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

SURROGATES = 0xD800, 0xE000
CODE_POINTS = 0x110000


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(CODE_POINTS, OTHER, np.uint8)
    every = [*range(SURROGATES[0]), *range(SURROGATES[1], CODE_POINTS)]
    text = "".join(map(chr, every))
    code = np.array(every)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for match in regex.finditer(pattern, text):
            table[code[match.start() : match.end()]] = kind
    table[WHITE_SPACE] = SPACE
    return table


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point and byte position of every character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.int32)
    wide = np.flatnonzero(code >= 0x80)
    if len(wide):
        lead, place = code[wide], at[wide]
        size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        value = lead & np.where(size == 2, 0x1F, np.where(size == 3, 0x0F, 0x07))
        for step in range(1, 4):
            more = size > step
            follow = data[place[more] + step] & 0x3F
            value[more] = (value[more] << 6) | follow
        code[wide] = value
    return code, at


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where pieces start; every text starts a piece of its own."""
    if len(data) == 0:
        return np.empty(0, np.int64)
    code, at = code_points(data)
    n = len(code)
    kind = classes()[code]
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, offsets)] = True
    run = np.empty(n, bool)
    run[0] = True
    run[1:] = (kind[1:] != kind[:-1]) | first[1:n]
    start = run.copy()
    # white space before a character of the same text: the last one stands apart, and
    # a plain space goes with what follows
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n])
    start[last] = True
    start[last[code[last] == 0x20] + 1] = False
    _contract(start, code, kind, run, first)
    return at[start]


def _contract(
    start: np.ndarray, code: np.ndarray, kind: np.ndarray, run: np.ndarray, first: np.ndarray
) -> None:
    """Parts the contractions, none of which reaches into the next text; ``start`` is changed
    in place."""
    n = len(code)
    quote = np.flatnonzero(start & (code == 0x27))
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1]]
    quote = quote[run[quote + 1] & (kind[quote + 1] == LETTER) & start[quote + 1]]
    for letters in CONTRACTIONS:
        size = len(letters)
        fits = quote[quote + size < n]
        for step, letter in enumerate(letters, 1):
            fits = fits[code[fits + step] == ord(letter)]
            if step > 1:
                fits = fits[~run[fits + step]]
        start[fits + 1] = False
        after = fits + size + 1
        after = after[after < n]
        start[after[~run[after]]] = True


def pieces(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of the pieces of all texts in order, the distinct pieces, the pieces per text."""
    data, offsets = tx.flat(column)
    starts = piece_starts(data, offsets)
    coded = tx.as_strings(data, np.append(starts, len(data))).dictionary_encode()
    counts = np.diff(np.searchsorted(starts, offsets))
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, counts


class PieceIds:
    """Ids of pieces met so far in this worker; forgets all when it holds too many bytes.

    ``encode`` turns a list of distinct pieces into their lists of ids.
    """

    def __init__(self, encode, most_bytes: int = 48 << 20):
        self.encode = encode
        self.most_bytes = most_bytes
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.held = 0
        self.flat = np.empty(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def batch(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids per text."""
        codes, distinct, counts = pieces(column)
        if self.held > self.most_bytes:
            self.forget()
        words = distinct.to_pylist()
        known = len(self.place)
        number = [self.place.setdefault(w, len(self.place)) for w in words]
        if len(self.place) > known:
            fresh = [w for w, i in zip(words, number) if i >= known]
            ids = self.encode(fresh)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            new = np.fromiter((i for one in ids for i in one), np.int32, int(sizes.sum()))
            self.flat = np.concatenate([self.flat, new])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.held += sum(map(len, fresh)) + 100 * len(fresh) + new.nbytes
        number = np.array(number, np.int64)[codes] if len(codes) else codes
        sizes = self.ends[number + 1] - self.ends[number]
        ids = self.flat[tx.ranges(self.ends[number], sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[bounds])
