"""Runs of repeated words: stretches that go on with one period.

Short periods are found by comparing every word with the one so many words ahead. Longer ones
are sought per scale: of the hashed grams of a window the least is its minimizer, and since a
run repeats, so do the minimizers of its windows, one period apart. Pairs of equal minimizers
within reach of the scale are seeds, each seed is extended to both sides word by word, and a
stretch that is long enough is a run.

Grams that go on with a much smaller period themselves are no minimizers. They lie in runs that
smaller scales have found already. What is left cannot occur again within that smaller period,
so a minimizer has few equals within reach and all of them are paired; and a stretch of one
period's length holds such a gram, as else it would have the smaller period as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts as tx

#: A run has this many words and this many periods at least.
LEAST_WORDS = 24
LEAST_PERIODS = 3

#: Periods below it are found by direct comparison; grams of the first scale.
FIRST_PERIOD = 64
FIRST_GRAM = 32

RUNS = "array<struct<start:long,length:long,period:long>>"


def stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches of at least ``least`` true values."""
    change = np.flatnonzero(np.diff(equal.view(np.int8), prepend=0, append=0))
    begin, end = change[::2], change[1::2]
    long = end - begin >= least
    return begin[long], end[long]


def least_matches(period: int) -> int:
    """Words of a run that equal the word one period ahead, at least."""
    return max(LEAST_WORDS - period, (LEAST_PERIODS - 1) * period)


class Found:
    """Runs by (start, end), the smallest period of each; an end is the word after."""

    def __init__(self):
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        known = self.period.get((start, end))
        if known is None or period < known:
            self.period[start, end] = period

    def rows(self) -> np.ndarray:
        """(start, end, period) by start, then period."""
        rows = np.array([(s, e, p) for (s, e), p in self.period.items()], np.int64).reshape(-1, 3)
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]

    def covered(self, size: int, most: int, gram: int) -> np.ndarray:
        """Places whose gram of so many words has a period of ``most`` words or fewer."""
        depth = np.zeros(size + 1, np.int32)
        for (start, end), period in self.period.items():
            if period <= most and end - start >= gram:
                depth[start] += 1
                depth[end - gram + 1] -= 1
        return np.cumsum(depth[:size]) > 0


def grams(code: np.ndarray, size: int) -> np.ndarray:
    """64 bits of every gram of ``size`` words, a power of two; shorter ones at the end."""
    value = tx.mix(code.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < size:
        ahead = np.zeros_like(value)
        ahead[:-step] = value[step:]
        value = tx.mix(value * np.uint64(0xD6E8FEB86659FD93) + tx.mix(ahead + np.uint64(step)))
        step *= 2
    return value


def minimizers(value: np.ndarray, window: int) -> np.ndarray:
    """Places of the least value of every window, the first of equals, each once."""
    n = len(value)
    if n < window:
        return np.empty(0, np.int64)
    best = np.arange(n)
    step = 1
    while 2 * step <= window:
        best = _less(value, best[:-step], best[step:])
        step *= 2
    rest = window - step
    if rest:
        best = _less(value, best[: len(best) - rest], best[rest:])
    return np.unique(best)


def _less(value: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two places the one with the lesser value, the first of equals; a <= b."""
    return np.where(value[b] < value[a], b, a)


def pairs_within(place: np.ndarray, value: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of all pairs of equal values at most ``reach`` apart."""
    order = np.lexsort((place, value))
    place, value = place[order], value[order]
    starts, gaps = [], []
    ahead = 1
    live = np.arange(len(place))
    while len(live):
        live = live[live + ahead < len(place)]
        live = live[(value[live + ahead] == value[live]) & (place[live + ahead] - place[live] <= reach)]
        starts.append(place[live])
        gaps.append(place[live + ahead] - place[live])
        ahead += 1
    return np.concatenate(starts or [live]), np.concatenate(gaps or [live])


def reach_ahead(code: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on, b > a."""
    done, step = 0, 64
    while b + done < len(code):
        to = min(len(code), b + done + step)
        unequal = np.flatnonzero(code[b + done : to] != code[a + done : a + to - b])
        if len(unequal):
            return done + int(unequal[0])
        done, step = to - b, 2 * step
    return len(code) - b


def reach_back(code: np.ndarray, a: int, b: int) -> int:
    """How many words ahead of ``a`` equal those ahead of ``b``, b > a."""
    done, step = 0, 64
    while done < a:
        size = min(step, a - done)
        unequal = np.flatnonzero(code[a - done - size : a - done] != code[b - done - size : b - done])
        if len(unequal):
            return done + size - 1 - int(unequal[-1])
        done, step = done + size, 2 * step
    return a


def short_periods(code: np.ndarray, found: Found, below: int) -> None:
    for period in range(1, min(below, len(code))):
        begin, end = stretches(code[period:] == code[:-period], least_matches(period))
        for a, b in zip(begin.tolist(), end.tolist()):
            found.add(a, b + period, period)


def long_periods(code: np.ndarray, found: Found, span: int, gram: int) -> None:
    """Runs with periods from half of ``span`` to ``span`` less a quarter of the gram.

    Windows hold ``span`` words. Two of them one period apart fit into a run of three periods,
    and a window of such a run holds a gram without a period of a quarter of its length.
    """
    value = grams(code, gram)
    value = value[: max(0, len(code) - gram + 1)]
    value = np.where(found.covered(len(value), gram // 4, gram), np.uint64(2**64 - 1), value)
    place = minimizers(value, span - gram + 1)
    place = place[value[place] != np.uint64(2**64 - 1)]
    start, period = pairs_within(place, value[place], span - gram // 4)
    order = np.lexsort((start, period))
    last, reached = 0, 0
    for a, q in zip(start[order].tolist(), period[order].tolist()):
        if q < span // 2 or (q == last and a < reached):
            continue
        low = a - reach_back(code, a, a + q)
        last, reached = q, a + reach_ahead(code, a, a + q)
        if reached - low >= least_matches(q):
            found.add(low, reached + q, q)


def scales(most: int) -> list[tuple[int, int]]:
    """(span, gram) per scale, such that all periods from FIRST_PERIOD to ``most`` have one."""
    out, span, gram = [], 2 * FIRST_PERIOD, FIRST_GRAM
    while span // 2 <= most:
        out.append((span, gram))
        above = span - gram // 4 + 1  # the least period that this scale does not find
        span = 2 * above
        while 8 * gram <= span:
            gram *= 2
    return out


def runs(code: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length, period) rows of all documents, each by start, then period, and the
    offsets of the documents in them.

    code: word numbers of all documents one after another; sizes: words per document.
    """
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    apart = code.astype(np.int64) + doc * (int(code.max(initial=0)) + 1)  # documents share no word
    found = Found()
    short_periods(apart, found, min(FIRST_PERIOD, int(sizes.max(initial=0)) // LEAST_PERIODS + 1))
    near = found.rows()
    rows = [near]
    for i in np.flatnonzero(sizes >= LEAST_PERIODS * FIRST_PERIOD).tolist():
        low, high = int(ends[i] - sizes[i]), int(ends[i])
        own = Found()
        mine = slice(*np.searchsorted(near[:, 0], [low, high]))
        for s, e, p in near[mine].tolist():
            own.add(s - low, e - low, p)
        for span, gram in scales((high - low) // LEAST_PERIODS):
            long_periods(apart[low:high], own, span, gram)
        more = own.rows()
        rows.append(more[more[:, 2] >= FIRST_PERIOD] + [low, low, 0])
    every = np.concatenate(rows)
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    offsets = np.searchsorted(every[:, 0], np.append(ends - sizes, ends[-1:]))
    first = np.repeat(ends - sizes, np.diff(offsets))
    return np.column_stack([every[:, 0] - first, every[:, 1] - every[:, 0], every[:, 2]]), offsets


def strongest(rows: np.ndarray) -> tuple | None:
    """The run with most periods; the first of equals by start, then period."""
    best = None
    for start, length, period in rows.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def kept(rows: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Words that stay, since no run holds them after its first period; ``first`` is the place
    of the first word of each run's document."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, first + rows[:, 0] + rows[:, 2], 1)
    np.add.at(depth, first + rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(depth[:size]) == 0


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of ``counts`` words each, joined by one space; a white byte follows every word."""
    last = np.zeros(len(starts), bool)
    last[np.cumsum(counts)[counts > 0] - 1] = True
    sizes = ends - starts + ~last
    letters = data[tx.ranges(starts, sizes)]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    letters[bounds[1:][~last] - 1] = 0x20
    offsets = bounds[np.concatenate([[0], np.cumsum(counts)])]
    return tx.as_strings(letters, offsets).cast(pa.large_string()).cast(pa.string())


def run_batches(batches):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for part in tx.slices(batches):
        data, offsets = tx.flat(part["text"], after=b"\n")
        starts, ends = tx.word_bounds(data)
        code, _ = tx.word_codes(data, starts, ends)
        first = np.searchsorted(starts, offsets)
        sizes = np.diff(first)
        rows, bounds = runs(code, sizes)
        stay = kept(rows, np.repeat(first[:-1], np.diff(bounds)), len(starts))
        counts = np.diff(np.concatenate([[0], np.cumsum(stay)])[first])
        best = [strongest(rows[a:b]) for a, b in zip(bounds, bounds[1:])]
        columns = [pa.array(rows[:, i], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(
            [
                tx.one_array(part["id"]),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(kind))
                ),
                pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], kind),
                joined(data, starts[stay], ends[stay], counts),
            ],
            names=["id", "n_words", "runs", "strongest", "collapsed"],
        )


def find(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, n_words, runs (start, length, period in words, by start,
    then period), strongest (the run of greatest length / period, null if there is none) and
    collapsed, the words that are left when of each run only its first period stays, joined by
    one space.

    A run is a stretch of words with a smallest period, at least 24 words and three periods
    long, that no neighbouring word extends. A null or empty text has no words and no runs.
    Repeated rows and null keys come out as they came in, an empty table gives no rows, other
    columns are not read. A text takes memory in proportion to its own length.
    """
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    run = "struct<start:long,length:long,period:long>"
    schema = f"id {kind}, n_words long, runs {RUNS}, strongest {run}, collapsed string"
    return rows.mapInArrow(run_batches, schema).withColumnRenamed("id", key)


def with_period(words: Column, start: Column, period: Column) -> Column:
    """The words with each from ``start`` on taken from the first period there, as a text."""
    turned = F.transform(
        words, lambda w, i: F.when(i < start, w).otherwise(F.get(words, (start + (i - start) % period).cast("int")))
    )
    return F.array_join(turned, " ")
