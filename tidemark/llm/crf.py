"""Personal data by a linear-chain conditional random field over word shapes.

Plain patterns find what has a fixed form. The field adds what stands where such data stands
and looks alike: it is trained on a small labelled table of text windows and decoded by
Viterbi, many lines at a time. Its spans are kept where they could be such data at all and
touch no span of a pattern.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import texts as tx
from tidemark.llm.nbsvm import shapes

# Kinds in their order, and the patterns.
KINDS = ["email", "ip", "card", "phone"]
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Every match of a number's pattern lies within one run of these.
NUMBER_RUN = re.compile(r"[0-9+(). \-]{7,}")

#: Documents, by the smallest hashes of their keys, whose windows are the labelled table of
#: the query; words on either side of a span in a window.
LABELLED_DOCUMENTS = 3_000
MARGIN = 12

#: Windows that come to the driver at most, by the smallest hashes of window and place.
LABELLED_WINDOWS = 12_000

#: Hashed shapes; words of one decoded sequence; steps of the training.
SHAPES = 4096
SEQUENCE = 256
STEPS = 80

#: Words of one item at most: a card has no more digits.
MOST_WORDS = 19

#: Labelled by hand, as [kind|item]: what the patterns miss or take as one.
HAND_MADE = [
    "call us at [phone|(462) 555-0193] before noon",
    "phone [phone|(826) 555-4081] or [phone|(843) 555-7672] for help",
    "the office number is [phone|462 555 0193] on weekdays",
    "tel. [phone|462-555-0193], ask for the manager",
    "fax: [phone|826.555.4081] and by mail as well",
    "reach me on [phone|843-555-7672] after six",
    "my number, [phone|(701) 555-2244] is new",
    "pay with [card|4465758382889437] [card|7536784127813050] today",
    "cards on file [card|4845168114407329] [card|4550997810720808] [card|4465758382889437] were used",
    "card [card|4465 7583 8288 9437] was charged twice",
    "charge [card|7536 7841 2781 3050] or [card|4845-1681-1440-7329] please",
    "the card [card|4550 9978 1072 0808] [card|4465 7583 8288 9437] ends soon",
    "write to [email|josé@correo.es] for the papers",
    "mail [email|юрий@почта.рф] or [email|müller@büro.de] today",
    "send it to [email|zoë@voilà.fr], thank you",
    "server [ip|10.0.0.12] [ip|192.168.4.7] did not answer",
    "order 4465 of 7583 pieces in 2024 and 1999",
    "the total is 555-0193 units, see page 826",
    "in 1999 (462) people came and 555 left",
    "version 1.2 and 3.4 of the build 20240117",
]

TAGS = 1 + len(KINDS)
GROUPS = 4
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def good_ip(text: str) -> bool:
    parts = text.split(".")
    if len(parts) != 4 or not all(p.isdigit() for p in parts):
        return False
    values = [p.lstrip("0") for p in parts]  # Python takes no number of thousands of digits
    return all(len(v) <= 3 and int(v or "0") <= 255 for v in values)


def good_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def good_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def emails(text: str):
    """(start, end) of the mail addresses. Every @ is looked at once: a name ends at it and
    holds none, and so does a host."""
    free, at = 0, text.find("@")
    while at >= 0:
        host = EMAIL_HOST.match(text, at + 1)
        low = at
        while host and low > free and text[low - 1] in EMAIL_NAME:
            low -= 1
        if low < at:
            free = host.end()
            yield low, free
        at = text.find("@", at + 1)


def addresses(zone: str):
    """(start, end) of four dotted groups, again and again along a chain of groups."""
    for chain in DOTTED.finditer(zone):
        groups = chain.group().split(".")
        start = chain.start()
        for a in range(0, len(groups) - 3, 4):
            size = sum(map(len, groups[a : a + 4])) + 3
            yield start, start + size
            start += size + 1


def matches(pattern: re.Pattern):
    return lambda zone: (m.span() for m in pattern.finditer(zone))


NUMBERS = [(1, addresses, good_ip), (2, matches(CARD), good_card), (3, matches(PHONE), good_phone)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, in code points and in order.

    The patterns are those of the kinds, read so that the time follows the length of the text:
    a name of a mail address ends at each @, an address is four groups of a chain of groups.
    """
    found = [(start, 0, end) for start, end in emails(text)]
    for run in NUMBER_RUN.finditer(text):
        zone, base = run.group(), run.start()
        for kind, bounds, good in NUMBERS:
            found += [(base + a, kind, base + b) for a, b in bounds(zone) if good(zone[a:b])]
    return sorted(found)


class Taken:
    """Whether a stretch meets one of the spans, by one search each."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        ordered = sorted(spans)
        self.starts = [s for s, _, _ in ordered]
        self.reach = list(accumulate((e for _, _, e in ordered), max))

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.reach[before - 1] > start


def taught_spans(text: str) -> list[tuple[int, int, int]]:
    """As base_spans, with the cards in longer runs of digits, which the pattern takes as one."""
    found = base_spans(text)
    taken, added = Taken(found), []
    for m in CARD.finditer(text):
        run = m.group()
        if len(_digits(run)) <= MOST_WORDS:
            continue
        bounds = [w.span() for w in re.finditer("[^ ]+", run)]
        for a, b in items(2, len(bounds), lambda a, b, r=run, w=bounds: r[w[a][0] : w[b - 1][1]]):
            start, end = m.start() + bounds[a][0], m.start() + bounds[b - 1][1]
            if not taken.meets(start, end):
                added.append((start, 2, end))
    return sorted(found + added)


def word_features(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Hashed own shape with all digits, and own shape with runs taken together."""
    out = []
    for salt, keep in ((0, True), (1, False)):
        code, names = shapes(data, starts, keep)
        hashed = (tx.mix(tx.hashes(names) + np.uint64(salt)) >> np.uint64(20)).astype(np.int64) % SHAPES
        out.append(hashed[code])
    return out


@dataclass
class Field:
    """weights: per group (own, short, before, after) and shape a score for each tag."""

    weights: np.ndarray
    moves: np.ndarray
    begin: np.ndarray


def _padded(sequences: list[np.ndarray], width: int) -> np.ndarray:
    out = np.full((len(sequences), width, sequences[0].shape[1]), -1, np.int64)
    for i, s in enumerate(sequences):
        out[i, : len(s)] = s
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(sequences: list[np.ndarray], tags: list[np.ndarray], steps: int = STEPS,
          rate: float = 0.3, decay: float = 1e-3) -> Field:
    """Maximises the likelihood of the tags by AdaGrad, all sequences at once.

    A row of a sequence holds the hashed features of a word, one per group.
    """
    size = GROUPS * (SHAPES + 1)
    flat = np.zeros((size, TAGS))
    moves, begin = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
    if sequences:
        width = max(map(len, sequences))
        x = _padded([s + np.arange(GROUPS) * (SHAPES + 1) for s in sequences], width)
        lengths = np.array([len(s) for s in sequences])
        live = np.arange(width) < lengths[:, None]
        x[~live] = 0
        y = _padded([t[:, None] for t in tags], width)[..., 0]
        onehot = (y[..., None] == np.arange(TAGS)) & live[..., None]
        both = onehot[:, :-1, :, None] & onehot[:, 1:, None, :]
        seen_moves, seen_begin = both.sum((0, 1)), onehot[:, 0].sum(0)
        power = [np.full_like(v, 1e-8) for v in (flat, moves, begin)]
        n = len(sequences)
        for _ in range(steps):
            score = flat[x].sum(2)
            ahead = np.zeros((n, width, TAGS))
            ahead[:, 0] = begin + score[:, 0]
            for t in range(1, width):
                new = _logsum(ahead[:, t - 1, :, None] + moves, 1) + score[:, t]
                ahead[:, t] = np.where(live[:, t, None], new, ahead[:, t - 1])
            total = _logsum(ahead[:, -1], 1)
            back = np.zeros((n, width, TAGS))
            pairs = np.zeros((TAGS, TAGS))
            for t in range(width - 2, -1, -1):
                step = moves + (score[:, t + 1] + back[:, t + 1])[:, None, :]
                on = live[:, t + 1]
                back[:, t] = np.where(on[:, None], _logsum(step, 2), 0)
                pairs += np.exp(ahead[on, t, :, None] + step[on] - total[on, None, None]).sum(0)
            chance = np.exp(ahead + back - total[:, None, None]) * live[..., None]
            gap = (onehot - chance).reshape(-1, TAGS)
            slope = np.zeros_like(flat)
            for group in range(GROUPS):
                np.add.at(slope, x[..., group].ravel(), gap)
            slopes = (slope - decay * flat, seen_moves - pairs - decay * moves,
                      seen_begin - chance[:, 0].sum(0) - decay * begin)
            for value, slope, squares in zip((flat, moves, begin), slopes, power):
                squares += slope**2
                value += rate * slope / np.sqrt(squares)
    return Field(flat.reshape(GROUPS, SHAPES + 1, TAGS), moves, begin)


def with_neighbours(own: np.ndarray, short: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Features of each word from its own and its neighbours' shapes; SHAPES stands for none."""
    before, after = np.roll(short, 1), np.roll(short, -1)
    return np.column_stack([own, short, np.where(first, SHAPES, before), np.where(last, SHAPES, after)])


def viterbi(score: np.ndarray, lengths: np.ndarray, field: Field) -> np.ndarray:
    """Best tags of sequences of one batch; score: sequence, place, tag."""
    n, width, _ = score.shape
    best = field.begin + score[:, 0]
    link = np.zeros((n, width, TAGS), np.int8)
    for t in range(1, width):
        step = best[:, :, None] + field.moves
        link[:, t] = step.argmax(1)
        new = step.max(1) + score[:, t]
        on = t < lengths
        best = np.where(on[:, None], new, best)
    tags = np.zeros((n, width), np.int8)
    now = best.argmax(1)
    row = np.arange(n)
    for t in range(width - 1, -1, -1):
        on = t < lengths
        tags[on, t] = now[on]
        if t:
            now = np.where(on, link[row, t, now], now)
    return tags


def decode(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, field: Field) -> np.ndarray:
    """Tag of every word. Lines are sequences; longer ones than SEQUENCE words are parted."""
    n = len(starts)
    if n == 0:
        return np.empty(0, np.int8)
    own, short = word_features(data, starts)
    lines = np.cumsum(data == 10)[starts]
    doc = np.searchsorted(offsets, starts, "right")
    new = np.ones(n, bool)
    new[1:] = (lines[1:] != lines[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    place = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    new |= place % SEQUENCE == 0
    begin = np.flatnonzero(new)
    lengths = np.diff(np.append(begin, n))
    last = np.append(new[1:], True)
    weights = field.weights.astype(np.float32)
    rows = with_neighbours(own, short, new, last)
    score = weights[0][rows[:, 0]]
    for group in range(1, GROUPS):
        score = score + weights[group][rows[:, group]]
    tags = np.zeros(n, np.int8)
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        width = int(lengths[order[at]])
        to = at
        while to < len(order) and (to - at + 1) * lengths[order[to]] <= 60_000 or to == at:
            width = int(lengths[order[to]])
            to += 1
        some = order[at:to]
        size = lengths[some]
        inside = np.arange(width) < size[:, None]
        padded = np.zeros((len(some), width, TAGS), np.float32)
        words = tx.ranges(begin[some], size)
        padded[inside] = score[words]
        tags[words] = viterbi(padded, size, field)[inside]
        at = to
    return tags


def plausible(kind: int, text: str) -> bool:
    """Whether a tagged stretch could be such data at all."""
    if kind == 0:
        name, _, host = text.partition("@")
        return bool(name) and "." in host.strip(".") and "@" not in host
    if set(text) - set("0123456789+(). -"):
        return False
    return [good_ip, good_card, good_phone][kind - 1](text)


def stripped(kind: int, words: str) -> str:
    return words.strip(".,;:!?\"'<>[]{}" if kind else ".,;:!?\"'<>[](){}")


def items(kind: int, n: int, spaced) -> list[tuple[int, int]]:
    """Neighbouring items (first word, word after) of a tagged stretch that is none as a whole.

    Of all ways to part it into runs that could be such data, the one that covers most words;
    ``spaced`` gives the text of a run. An item of more words than a card has digits does not
    exist, and a mail address is one word.
    """
    best: list[tuple[int, tuple]] = [(0, ())]
    for end in range(1, n + 1):
        covered, runs = best[end - 1]
        for length in range(1, min(end, MOST_WORDS if kind else 1) + 1):
            low = end - length
            if best[low][0] + length > covered and plausible(kind, stripped(kind, spaced(low, end))):
                covered, runs = best[low][0] + length, (best[low][1], (low, end))
        best.append((covered, runs))
    found, runs = [], best[-1][1]
    while runs:
        runs, last = runs
        found.append(last)
    return found[::-1]


def field_spans(part: pa.Table, texts: list[str], base: list[list], field: Field) -> list[list]:
    """What the field adds to the spans of the patterns, per text."""
    added: list[list] = [[] for _ in texts]
    data, offsets = tx.flat(part["text"], after=b"\n")
    starts, ends = tx.word_bounds(data)
    tags = decode(data, offsets, starts, field)
    hit = np.flatnonzero(tags)
    if len(hit) == 0:
        return added
    doc = np.searchsorted(offsets, starts[hit], "right") - 1
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    taken = {i: Taken(base[i]) for i in np.unique(doc).tolist()}
    cut = (np.diff(hit) != 1) | (np.diff(tags[hit]) != 0) | (np.diff(doc) != 0)
    for group in np.split(np.arange(len(hit)), np.flatnonzero(cut) + 1):
        i, kind = int(doc[group[0]]), int(tags[hit[group[0]]]) - 1
        lows, highs = starts[hit[group]], ends[hit[group]]

        def spaced(a: int, b: int, lows=lows, highs=highs) -> str:
            return data[lows[a] : highs[b - 1]].tobytes().decode("utf-8", "replace")

        whole = (0, len(group))
        runs = [whole] if plausible(kind, stripped(kind, spaced(*whole))) else \
            items(kind, len(group), spaced)
        for a, b in runs:
            words = spaced(a, b)
            text = stripped(kind, words)
            start = int(lead[lows[a]] - lead[offsets[i]]) + words.index(text)
            end = start + len(text)
            if not taken[i].meets(start, end):
                added[i].append((start, kind, end))
    return added


def span_batches(batches, shared, redact: bool):
    field = shared.value if shared is not None else None
    for part in tx.slices(batches):
        texts = [t or "" for t in part["text"].to_pylist()]
        base = [base_spans(t) for t in texts]
        added = field_spans(part, texts, base, field) if field else [[] for _ in texts]
        every = [sorted([(*s, True) for s in a] + [(*s, False) for s in b]) for a, b in zip(base, added)]
        if redact:
            given = part["text"].to_pylist()
            clean = [None if g is None else redacted(g, s) for g, s in zip(given, every)]
            yield from part.append_column("redacted", pa.array(clean, pa.string())).to_batches()
            continue
        flat = [s for one in every for s in one]
        spans = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, every)]), pa.int32()),
            pa.StructArray.from_arrays([
                pa.array([KINDS[k] for _, k, _, _ in flat], pa.string()),
                pa.array([s for s, _, _, _ in flat], pa.int64()),
                pa.array([e for _, _, e, _ in flat], pa.int64()),
                pa.array([b for _, _, _, b in flat], pa.bool_()),
            ], names=["kind", "start", "end", "base"]),
        )
        yield pa.RecordBatch.from_arrays([tx.one_array(part["id"]), spans], names=["id", "spans"])


def redacted(text: str, spans: list[tuple]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    out, at = [], 0
    for start, kind, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def window_batches(batches, margin: int):
    """Labelled windows: the words around each span of taught_spans, or the first words."""
    for part in tx.slices(batches):
        for text in part["text"].to_pylist():
            text = text or ""
            spans = taught_spans(text)
            words = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
            if not words:
                continue
            begin = np.array([s for s, _ in words])
            rows, cover = [], -1
            for start, _, end in spans or [(0, 0, 0)]:
                if start < cover:
                    continue
                low = max(0, int(np.searchsorted(begin, start, "right")) - 1 - margin)
                high = min(len(words), int(np.searchsorted(begin, end)) + margin)
                a, cover = words[low][0], words[high - 1][1]
                inner = [s for s in spans if s[0] >= a and s[2] <= cover]
                rows.append((text[a:cover], [(s - a, k, e - a) for s, k, e in inner], a))
            yield pa.RecordBatch.from_arrays([
                pa.array([r for r, _, _ in rows], pa.string()),
                pa.array([[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans] for _, spans, _ in rows],
                         pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))),
                pa.array([a for _, _, a in rows], pa.int64()),
            ], names=["text", "spans", "place"])


def hand_made() -> list[tuple[str, list[tuple[int, str, int]]]]:
    """HAND_MADE as rows (text, spans)."""
    rows = []
    for marked in HAND_MADE:
        text, spans, at = "", [], 0
        for m in re.finditer(r"\[([a-z]+)\|([^\]]+)\]", marked):
            text += marked[at : m.start()]
            spans.append((len(text), m[1], len(text) + len(m[2])))
            text, at = text + m[2], m.end()
        rows.append((text + marked[at:], spans))
    return rows


def labelled_windows(
    documents: DataFrame, key: str = "doc_id", text: str = "text",
    most: int = LABELLED_DOCUMENTS, margin: int = MARGIN, windows: int = LABELLED_WINDOWS,
) -> DataFrame:
    """A small labelled table (text, spans): at most ``windows`` windows from at most ``most``
    keys, marked by taught_spans, and the windows labelled by hand."""
    keys = documents.select(F.col(key).alias("id")).distinct()
    chosen = keys.orderBy(F.xxhash64("id"), "id").limit(most)  # a bounded number of keys
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(chosen), "id", "left_semi").select("text")
    schema = "text string, spans array<struct<start:long,kind:string,end:long>>"
    by_hand = documents.sparkSession.createDataFrame(hand_made(), schema)
    marked = rows.mapInArrow(lambda b: window_batches(b, margin), f"{schema}, place long")
    marked = marked.orderBy(F.xxhash64("text", "place"), "text", "place").limit(windows)
    return marked.select("text", "spans").unionByName(by_hand)


def fit(labelled: DataFrame) -> Field | None:
    """Trains on a small table of texts and their spans, which comes to the driver as a whole.

    Null and empty texts, and null spans, are no examples. None if there are no examples.
    """
    table = labelled.where(F.length("text") > 0).select("text", "spans").toArrow()
    sequences, tags = [], []
    for row in table.sort_by("text").to_pylist():
        data, offsets = tx.flat(pa.array([row["text"]], pa.string()), after=b"\n")
        starts, ends = tx.word_bounds(data)
        if len(starts) == 0:
            continue
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        begin, end = lead[starts], lead[ends]
        tag = np.zeros(len(starts), np.int64)
        for span in row["spans"] or []:
            tag[(begin < span["end"]) & (end > span["start"])] = 1 + KINDS.index(span["kind"])
        own, short = word_features(data, starts)
        edge = np.zeros(len(starts), bool)
        first, last = edge.copy(), edge.copy()
        first[0] = last[-1] = True
        rows = with_neighbours(own, short, first, last)
        for a in range(0, len(rows), 4 * MARGIN):
            sequences.append(rows[a : a + 4 * MARGIN])
            tags.append(tag[a : a + 4 * MARGIN])
    field = train(sequences, tags) if sequences else None
    tx.give_back()
    return field


def find(documents: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key`` and spans (kind, start, end in code points, end exclusive,
    base: found by a pattern), by start, then kind.

    Null and empty texts have no spans; without a field only the patterns are used. Repeated
    rows and null keys come out as they came in, an empty table gives no rows, other columns
    are not read.
    """
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(field) if field else None
    schema = f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}"
    found = rows.mapInArrow(lambda b: span_batches(b, shared, False), schema)
    return found.withColumnRenamed("id", key)


def redact(documents: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """The documents with every span in ``text`` replaced by its kind in square brackets.

    All rows and other columns stay as they are; a null text stays null.
    """
    shared = documents.sparkSession.sparkContext.broadcast(field) if field else None
    inner = documents.select(F.struct(*documents.columns).alias("row"), F.col(text).alias("text"))
    out = inner.mapInArrow(
        lambda b: span_batches(b, shared, True),
        T.StructType([*inner.schema.fields, T.StructField("redacted", T.StringType())]),
    )
    return out.select(
        *(F.col("redacted").alias(c) if c == text else F.col("row")[c].alias(c) for c in documents.columns)
    )
