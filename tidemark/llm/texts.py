"""Whole texts as flat byte arrays: what the numpy operators share.

A task turns a batch of texts into one byte array with document offsets and works on that,
so a very long text costs memory in proportion to its own bytes only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that separate words: space and 0x09 to 0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Lower case for A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SLICE_BYTES = 2 << 20


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


def give_back() -> None:
    """Returns freed memory of this worker to the system. Workers live on from stage to stage,
    so what one keeps in reserve is missing to the next."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]) -> object:
    """What an operator keeps in this worker from task to task; made once, and one at a time."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go(but: Hashable = None) -> None:
    """Drops what another operator has kept in this worker."""
    other = [k for k in _kept if k != but]
    for k in other:
        del _kept[k]
    if other:
        give_back()


def lean(function: Callable) -> Callable:
    """A function over a group that gives back what it took."""

    @wraps(function)
    def run(*args, **given):
        let_go()
        try:
            return function(*args, **given)
        finally:
            give_back()

    return run


def one_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def flat(
    column: pa.Array | pa.ChunkedArray, before: bytes = b"", after: bytes = b""
) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each between ``before`` and ``after``; null counts as empty.

    Returns the bytes and the offsets of the texts, one more than there are texts.
    """
    kind = pa.large_binary()
    column = pc.fill_null(one_array(column).cast(kind), pa.scalar(b"", kind))
    if before or after:
        column = pc.binary_join_element_wise(
            pa.scalar(before, kind), column, pa.scalar(after, kind), pa.scalar(b"", kind)
        )
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    content = column.buffers()[2]
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch] | pa.Table, text: str = "text", most: int = SLICE_BYTES,
    keeps: Hashable = None,
) -> Iterator[pa.Table]:
    """The rows in pieces of about ``most`` bytes of text; a longer text is a piece alone.
    ``keeps`` is the key of what the caller has ``kept``; all else goes."""
    let_go(keeps)
    if isinstance(batches, pa.Table):
        batches = iter([batches])
    for batch in batches:
        table = batch if isinstance(batch, pa.Table) else pa.Table.from_batches([batch])
        sizes = pc.fill_null(pc.binary_length(one_array(table[text])), 0)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64) + 16)
        at = 0
        while at < table.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield table.slice(at, to - at)
            at = to
    give_back()


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word. Each text must end with a white byte."""
    inside = (~WHITE[data]).astype(np.int8)
    change = np.diff(inside, prepend=0, append=0)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def as_strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Adjoining pieces of a byte array as an Arrow column, without a copy per piece."""
    offsets = np.ascontiguousarray(offsets, np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


def word_codes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, pa.Array]:
    """For every word its number in the list of distinct words, and that list."""
    letters = data[~WHITE[data]]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    coded = as_strings(letters, offsets).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def hashes(values: pa.Array) -> np.ndarray:
    """64 bits per string, the same in every task."""
    if len(values) == 0:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False), categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; wraps around."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after another."""
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(begin - starts, lengths)


def sums(place: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of the values at each place; places may be missing altogether."""
    return np.bincount(place, values, size).astype(float)


def blobs(order: np.ndarray, groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(group, positions) for every group of a sorted order."""
    if len(order) == 0:
        return
    sorted_groups = groups[order]
    cuts = np.flatnonzero(np.diff(sorted_groups)) + 1
    for piece in np.split(order, cuts):
        yield int(groups[piece[0]]), piece
