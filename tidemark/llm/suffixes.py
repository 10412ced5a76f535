"""Removing repeated passages by merged Burrows-Wheeler transforms.

A passage repeats when the same ``span`` bytes start at two places. Every window of ``span``
bytes belongs to its anchor, the smallest hash of ``gram`` bytes inside it; equal windows have
anchors of equal hash. Neighbouring windows of one anchor form a segment.

* Blocks of texts report the hashes of their anchors; hashes that occur once in all texts
  cannot hold a repeat and go no further. The windows of a very frequent anchor are reported
  in the same way, one by one, and those that occur once go no further either.
* The segments of the other anchors go to buckets by anchor, each block sending equal segments
  once. In a bucket the distinct segments that share their anchor with another one are dealt
  into shards. A shard sorts the suffixes of its own segments and yields its transform.
* Transforms are merged by refining their interleave: after step h the rows of all shards lie
  in blocks of equal first h bytes. The next step follows each row's preceding byte. A block
  with rows of one shard only is settled, its common prefixes being those the shard knows, and
  leaves the refinement; what is left after ``span`` steps are the intervals that repeat across
  shards. No suffix of one shard is sorted against those of another.
* An interval's earliest start stays; every other start removes its ``span`` bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts as tx
from tidemark.llm.workspace import BLOCK_BYTES, Workspace, blocked

SPAN = 100
GRAM = 40

#: Window starts that are hashed at once, so that they stay in the processor's cache; a multiple
#: of 128.
CHUNK = 1 << 16

#: Bytes of segments that are gathered, and of windows that are compared, at once.
GATHERED = 1 << 20

#: Bytes of segments in one shard.
SHARD_BYTES = 1 << 19

#: Blocks whose anchors one bucket of anchor hashes takes.
BLOCKS_PER_BUCKET = 16

#: Beyond so many occurrences the windows of an anchor travel one by one, each to the bucket
#: of its own bytes, so that no bucket holds all surroundings of one common passage. Only
#: windows that occur again travel, and a text's neighbouring windows without bytes as one row.
HOT_ANCHOR = 50_000

POWER = 0x9E3779B97F4A7C15
BYTE_HASH = np.random.Generator(np.random.PCG64(20_240_101)).integers(
    0, 1 << 64, 256, dtype=np.uint64
)

ANCHORS = "bucket int, block int, keys binary, counts binary"
REPEATED = "block int, keys binary, hot binary, n_hot int"
SEGMENT = "bucket int, anchor int, block int, row int, id long, start long, size int, content binary"
GONE = "block int, row int, start long, size int"


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every place on, by doubling."""
    level, width, done, at = BYTE_HASH[data], 1, None, 0
    rest = size
    while rest:
        if rest & 1:
            if done is None:
                done, at = level, width
            else:
                n = len(level) - at
                factor = np.uint64(pow(POWER, width, 1 << 64))
                done = done[:n] * factor + level[at : at + n]
                at += width
        rest >>= 1
        if rest:
            factor = np.uint64(pow(POWER, width, 1 << 64))
            level = level[:-width] * factor + level[width:]
            width *= 2
    return tx.mix(done)


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    over = size - width
    return np.minimum(values[: len(values) - over], values[over:]) if over else values


def anchors(
    data: np.ndarray, offsets: np.ndarray, span: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor hash of every segment of all texts, and
    whether equal windows may lie within the segment.

    Of equal hashes in a window the first one is the anchor, unless a place divisible by 128
    lies behind it: then it is the first one from there on. Only in that case can a window and
    an equal later one have the same anchor.
    """
    found = []
    width = span - gram + 1
    ends = offsets[1:]
    short = np.maximum(offsets[:-1], ends - span + 1)
    for begin in range(0, len(data) - span + 1, CHUNK):
        part = data[begin : begin + CHUNK + span - 1]
        n = len(part) - span + 1
        order = window_hashes(part, gram)
        low = np.arange(len(order), dtype=np.uint64) & np.uint64(127)
        best = sliding_min((order & ~np.uint64(127)) | low, width)
        here = np.arange(n)
        place = here + ((best.astype(np.int64) - here) & 127)
        valid = np.ones(n, bool)
        inside = (ends > begin) & (short < begin + n)
        first = np.maximum(short[inside] - begin, 0)
        valid[tx.ranges(first, np.minimum(ends[inside] - begin, n) - first)] = False
        start = np.flatnonzero(valid)
        if len(start) == 0:
            continue
        place = place[start]
        new = np.flatnonzero((np.diff(start) != 1) | (np.diff(place) != 0)) + 1
        new = np.concatenate([[0], new])
        count = np.diff(np.append(new, len(start)))
        first, place = start[new], place[new]
        keys = order[place] & ~np.uint64(127)
        again = np.zeros(len(new), bool)
        across = np.flatnonzero((first < place & ~127) & (count > 1))
        if len(across):
            bounds = np.column_stack([first[across], place[across] & ~127]).ravel()
            least = np.minimum.reduceat(order & ~np.uint64(127), bounds)[::2]
            again[across] = least == keys[across]
        found.append((first + begin, count, keys, again))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, bool))
    return tuple(np.concatenate(c) for c in zip(*found))


def _sorted_block(table: pa.Table) -> pa.Table:
    keys = [("id", "ascending"), ("text", "ascending")]
    return table.take(pc.sort_indices(table, keys, null_placement="at_start"))


@tx.lean
def block_anchors(table: pa.Table, span: int, gram: int, buckets: int) -> pa.Table:
    """Anchor hashes of a block, each once with its count."""
    _, _, keys, again = anchors(*tx.flat(_sorted_block(table)["text"]), span, gram)
    return _counted(np.concatenate([keys, keys[again]]), table["block"][0].as_py(), buckets)


def _counted(keys: np.ndarray, block: int, buckets: int) -> pa.Table:
    """The distinct keys of a block with their counts, by bucket."""
    keys, counts = np.unique(keys, return_counts=True)
    counts = np.minimum(counts, 65535).astype(np.uint16)
    bucket = (keys >> np.uint64(33)).astype(np.int64) % buckets
    groups = list(tx.blobs(np.argsort(bucket, kind="stable"), bucket))
    return pa.table({
        "bucket": pa.array([b for b, _ in groups], pa.int32()),
        "block": pa.array([block] * len(groups), pa.int32()),
        "keys": pa.array([keys[at].tobytes() for _, at in groups], pa.binary()),
        "counts": pa.array([counts[at].tobytes() for _, at in groups], pa.binary()),
    })


@tx.lean
def repeated_anchors(table: pa.Table, hot: int) -> pa.Table:
    """For every block of a bucket its anchor hashes that occur again somewhere."""
    parts = [np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()]
    counts = np.concatenate([np.frombuffer(b, np.uint16) for b in table["counts"].to_pylist()])
    _, inverse = np.unique(np.concatenate(parts), return_inverse=True)
    total = tx.sums(inverse, counts, int(inverse.max()) + 1)[inverse]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    keep = [t > 1 for t in np.split(total, cuts)]
    warm = [t > hot for t in np.split(total, cuts)]
    return pa.table({
        "block": table["block"],
        "keys": pa.array([p[k].tobytes() for p, k in zip(parts, keep)], pa.binary()),
        "hot": pa.array([w[k].tobytes() for w, k in zip(warm, keep)], pa.binary()),
        "n_hot": pa.array([int(w.sum()) for w in warm], pa.int32()),
    })


def _known(repeated: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys that occur again, sorted, and which of them are hot."""
    keys = [np.frombuffer(b, np.uint64) for b in repeated["keys"].to_pylist()]
    hot = [np.frombuffer(b, bool) for b in repeated["hot"].to_pylist()]
    keys = np.concatenate([np.empty(0, np.uint64), *keys])
    order = np.argsort(keys)
    return keys[order], np.concatenate([np.empty(0, bool), *hot])[order]


def _among(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are known, and the place of each."""
    if len(known) == 0:
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys, at


def hashes_at(data: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """Hash of the window at each of the sorted starts."""
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + CHUNK, CHUNK))
    for begin, a, b in zip(range(0, len(data), CHUNK), cuts, cuts[1:]):
        if a < b:
            part = window_hashes(data[begin : begin + CHUNK + span - 1], span)
            out[a:b] = part[starts[a:b] - begin]
    return out


@tx.lean
def hot_windows(table: pa.Table, repeated: pa.Table, span: int, gram: int, buckets: int) -> pa.Table:
    """Hashes of the windows of a block's hot anchors, each once with its count."""
    if table.num_rows == 0 or repeated.num_rows == 0:
        return _counted(np.empty(0, np.uint64), 0, buckets)
    known, hot = _known(repeated)
    data, offsets = tx.flat(_sorted_block(table)["text"])
    start, count, keys, _ = anchors(data, offsets, span, gram)
    warm = _among(keys, known[hot])[0]
    one = tx.ranges(start[warm], count[warm])
    return _counted(hashes_at(data, one, span), table["block"][0].as_py(), buckets)


def _contents(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of all pieces. Pieces overlap, and each byte needs a place to be taken from, so
    they are gathered part by part."""
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(offsets[-1]), np.uint8)
    cuts = np.searchsorted(offsets, np.arange(0, offsets[-1], GATHERED))
    cuts = np.unique(np.append(cuts, len(starts)))
    for a, b in zip(cuts, cuts[1:]):
        out[offsets[a] : offsets[b]] = data[tx.ranges(starts[a:b], sizes[a:b])]
    return tx.as_strings(out, offsets)


def _window_codes(data: np.ndarray, starts: np.ndarray, own: np.ndarray, span: int) -> np.ndarray:
    """A number per window, by its hash ``own``; windows of one number are equal. Equal windows
    have one number too, unless others of their hash lie between them."""
    order = np.argsort(own, kind="stable")
    at = starts[order]
    alike = np.flatnonzero(np.diff(own[order]) == 0) + 1
    new = np.ones(len(at), bool)
    every = np.lib.stride_tricks.sliding_window_view(data, span)
    step = max(1, GATHERED // span)
    for low in range(0, len(alike), step):
        some = alike[low : low + step]
        new[some] = (every[at[some]] != every[at[some - 1]]).any(1)
    code = np.empty(len(at), np.int64)
    code[order] = np.cumsum(new) - 1
    return code


@tx.lean
def block_segments(table: pa.Table, repeated: pa.Table, span: int, gram: int, buckets: int) -> pa.Table:
    """Segments of repeated anchors of a block: the first of equal ones with its bytes, the
    later ones without, as they are removed whatever else is found.

    Rows of ``repeated`` without ``hot`` hold the windows of hot anchors that occur again.
    ``anchor`` tells anchors apart, and is below 0 where equal windows may lie within the
    segment.
    """
    empty = pa.table({n: pa.array([], t) for n, t in (
        ("bucket", pa.int32()), ("anchor", pa.int32()), ("block", pa.int32()), ("row", pa.int32()), ("id", pa.int64()),
        ("start", pa.int64()), ("size", pa.int32()), ("content", pa.binary()))})
    if table.num_rows == 0 or repeated.num_rows == 0:
        return empty
    block = table["block"][0].as_py()
    table = _sorted_block(table)
    apart = pc.is_null(repeated["hot"])
    known, hot = _known(repeated.filter(pc.invert(apart)))
    again = [np.frombuffer(b, np.uint64) for b in repeated.filter(apart)["keys"].to_pylist()]
    data, offsets = tx.flat(table["text"])
    start, count, keys, loop = anchors(data, offsets, span, gram)
    hit, at = _among(keys, known)
    if not hit.any():
        return empty
    start, count, keys, loop, warm = start[hit], count[hit], keys[hit], loop[hit], hot[at[hit]]
    alone = np.zeros(len(start), bool)
    if warm.any():  # windows one by one, by a hash of their bytes
        one = tx.ranges(start[warm], count[warm])
        own = hashes_at(data, one, span)
        twice = _among(own, np.sort(np.concatenate([np.empty(0, np.uint64), *again])))[0]
        one, own = one[twice], own[twice]
        start = np.concatenate([start[~warm], one])
        count = np.concatenate([count[~warm], np.ones(len(one), np.int64)])
        keys = np.concatenate([keys[~warm], own])
        loop = np.concatenate([loop[~warm], np.zeros(len(one), bool)])
        alone = np.concatenate([alone[~warm], np.ones(len(one), bool)])
        place = np.argsort(start, kind="stable")
        start, count, keys, loop, alone = (x[place] for x in (start, count, keys, loop, alone))
    if len(start) == 0:
        return empty
    size = count + span - 1
    row = np.searchsorted(offsets, start, "right") - 1
    ids = _ids(table)[row]
    start_in = start - offsets[row]
    code = np.empty(len(start), np.int64)
    coded = _contents(data, start[~alone], size[~alone]).dictionary_encode()
    code[~alone] = coded.indices.to_numpy(zero_copy_only=False)
    if alone.any():
        code[alone] = len(coded.dictionary) + _window_codes(data, start[alone], keys[alone], span)
    first = _earliest(code, ids, start_in)[code]
    early = (ids == ids[first]) & (start_in == start_in[first])
    # neighbours without bytes are one row
    bare = np.flatnonzero(~early)
    apart = np.diff(row[bare]) != 0
    apart |= start[bare][1:] > (start + size)[bare][:-1]
    head = np.concatenate([[True], apart]) if len(bare) else np.empty(0, bool)
    last = bare[np.append(head[1:], True)] if len(bare) else bare
    bare = bare[head]
    size[bare] = start[last] + size[last] - start[bare]
    content = _contents(data, start[early], size[early]).cast(pa.binary())
    early = np.flatnonzero(early)
    anywhere = tx.mix(keys[bare] + start[bare].astype(np.uint64))
    keys, sent = np.concatenate([keys[early], anywhere]), np.concatenate([early, bare])
    anchor = (keys & np.uint64((1 << 38) - 1)) >> np.uint64(7)
    anchor = anchor.astype(np.int32)
    return pa.table({
        "bucket": pa.array((keys >> np.uint64(20)).astype(np.int64) % buckets, pa.int32()),
        "anchor": pa.array(np.where(loop[sent], ~anchor, anchor), pa.int32()),
        "block": pa.array(np.full(len(sent), block), pa.int32()),
        "row": pa.array(row[sent], pa.int32()),
        "id": pa.array(ids[sent], pa.int64()),
        "start": pa.array(start_in[sent], pa.int64()),
        "size": pa.array(size[sent], pa.int32()),
        "content": pa.concat_arrays([content, pa.nulls(len(bare), pa.binary())]),
    })


def _earliest(code: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every code, 0 and up, its row of smallest id and then start."""
    order = np.lexsort((starts, ids, code))
    return order[np.concatenate([[True], np.diff(code[order]) != 0])]


def _ids(table: pa.Table) -> np.ndarray:
    """Ids as numbers; a null comes before all others."""
    low = np.iinfo(np.int64).min
    return tx.one_array(table["id"]).cast(pa.int64()).fill_null(low).to_numpy(zero_copy_only=False)


class Shard:
    """The transform of some segments, with where each row's suffix starts.

    Symbols are bytes plus one; 0 ends every segment. Suffixes that are equal to their ends
    are ordered by segment.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, span: int):
        n = len(sizes)
        ends = np.cumsum(sizes + 1)
        begins = ends - sizes - 1
        text = np.zeros(int(ends[-1]), np.uint16)
        text[tx.ranges(begins, sizes)] = data.astype(np.uint16) + 1
        rank, same = self._ranks(text, int(sizes.max()) + 1, span)
        order = np.argsort(rank, kind="stable")
        self.segment = np.repeat(np.arange(n), sizes + 1)[order]
        self.offset = (order - begins[self.segment]).astype(np.int64)
        before = np.roll(text, 1)
        before[begins] = 0
        before = before[order]
        self.transform = before.astype(np.uint8) if before.max() < 256 else before
        # rows that share their first ``span`` bytes with the row before
        self.repeats = same(order)
        self.long = self.offset <= sizes[self.segment] - span

    @staticmethod
    def _ranks(text: np.ndarray, longest: int, span: int):
        """Order of all suffixes by doubling; a suffix ends at its first 0.

        A rank is the place where its group starts. Only groups of several suffixes that go
        on are sorted again.
        """
        size = len(text)
        padded = np.concatenate([text, np.zeros(7, text.dtype)]).astype(np.uint64)
        live = np.ones(size, bool)
        word = np.zeros(size, np.uint64)
        for step in range(7):
            symbol = np.where(live, padded[step : step + size], np.uint64(0))
            word = (word << np.uint64(9)) | symbol
            live &= symbol != 0
        order = np.argsort(word)
        slots = np.arange(size)
        edge = np.concatenate([[True], np.diff(word[order]) != 0])
        rank = np.empty(size, np.int64)
        rank[order] = np.maximum.accumulate(np.where(edge, slots, 0))
        ended, width = ~live, 7
        half, half_rank = width, rank.copy()
        alone = edge & np.append(edge[1:], True)
        slots, order = slots[~alone], order[~alone]
        while width < longest and len(order):
            go = ~ended[order]
            slots, order = slots[go], order[go]
            if len(order) == 0:
                break
            key = rank[order] * (size + 1) + rank[np.minimum(order + width, size - 1)]
            by = np.argsort(key)
            order, key = order[by], key[by]
            edge = np.concatenate([[True], np.diff(key) != 0])
            begin = np.maximum.accumulate(np.where(edge, np.arange(len(order)), 0))
            rank[order] = slots[begin]
            reach = np.ones(size, bool)
            reach[:-width] = ended[width:]
            ended = ended | reach
            width *= 2
            if width <= span:
                half, half_rank = width, rank.copy()
            alone = edge & np.append(edge[1:], True)
            slots, order = slots[~alone], order[~alone]

        def same(order: np.ndarray) -> np.ndarray:
            second = np.minimum(order + (span - half), size - 1)
            out = np.zeros(size, bool)
            out[1:] = (half_rank[order][1:] == half_rank[order][:-1]) & (
                half_rank[second][1:] == half_rank[second][:-1]
            )
            return out

        return rank, same


def step_back(transform: np.ndarray) -> np.ndarray:
    """For every row the row of the suffix that is one byte longer."""
    order = np.argsort(transform, kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return back


def merge_shards(shards: list[Shard], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that share ``span`` bytes with a row of another shard, and the interval of each.

    Rows are numbered through all shards.
    """
    base = np.cumsum([0] + [len(s.transform) for s in shards])
    transform = np.concatenate([s.transform for s in shards])
    back = np.concatenate([step_back(s.transform) + b for s, b in zip(shards, base)])
    owner = np.repeat(np.arange(len(shards)), np.diff(base)).astype(np.int32)
    back = back.astype(np.int32 if len(back) < 1 << 31 else np.int64)
    # only rows with ``span`` bytes ahead of them can go back so many steps
    rows = np.flatnonzero(np.concatenate([s.offset for s in shards]) >= span).astype(back.dtype)
    block = np.zeros(len(rows), back.dtype)
    for _ in range(span):
        if len(rows) == 0:
            break
        symbol = transform[rows]
        order = np.argsort(symbol, kind="stable")
        rows, block, symbol = back[rows[order]], block[order], symbol[order]
        edge = np.empty(len(rows), bool)
        edge[0] = True
        edge[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(edge, dtype=back.dtype) - 1
        begin = np.flatnonzero(edge)
        own = owner[rows]
        mixed = np.minimum.reduceat(own, begin) != np.maximum.reduceat(own, begin)
        keep = mixed[block]
        rows, block = rows[keep], block[keep]
    return rows, block


def repeated_intervals(data: np.ndarray, sizes: np.ndarray, span: int, shard_bytes: int):
    """Segment, offset and interval of every window that occurs more than once."""
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    cut = np.searchsorted(bounds, np.arange(0, bounds[-1], shard_bytes)[1:])
    cut = np.unique(np.concatenate([[0], cut, [len(sizes)]]))
    if len(cut) == 2 and len(sizes) > 1:
        cut = np.array([0, len(sizes) // 2, len(sizes)])
    shards, segment, offset, inner, interval = [], [], [], [], 0
    for a, b in zip(cut, cut[1:]):
        shard = Shard(data[bounds[a] : bounds[b]], sizes[a:b], span)
        shards.append(shard)
        segment.append(shard.segment + a)
        offset.append(shard.offset)
        label = np.cumsum(~(shard.repeats & shard.long)) + interval
        interval = int(label[-1]) + 1
        label[~shard.long] = -1
        inner.append(label)
    segment, offset, label = map(np.concatenate, (segment, offset, inner))
    if len(shards) > 1:
        rows, block = merge_shards(shards, span)
        label[rows] = block + interval
    windows = np.flatnonzero(label >= 0)
    _, inverse, counts = np.unique(label[windows], return_inverse=True, return_counts=True)
    many = counts[inverse] > 1
    return segment[windows[many]], offset[windows[many]], inverse[many]


@tx.lean
def bucket_spans(table: pa.Table, span: int, shard_bytes: int) -> pa.Table:
    """What the segments of a bucket lose; all of it where the bytes did not come along."""
    bare = pc.is_null(table["content"])
    rest = table.filter(bare).select(["block", "row", "start", "size"])
    table = table.filter(pc.invert(bare))
    if table.num_rows == 0:
        return rest
    ids, starts = table["id"].to_numpy(), table["start"].to_numpy()
    size = table["size"].to_numpy().astype(np.int64)
    coded = tx.one_array(table["content"]).cast(pa.large_binary()).dictionary_encode()
    code = coded.indices.to_numpy()
    # the earliest occurrence of each distinct segment
    lead = _earliest(code, ids, starts)
    first = lead[code]
    is_first = (ids == ids[first]) & (starts == starts[first])
    # a segment alone with its anchor has its windows from no other one
    anchor = table["anchor"].to_numpy()[lead]
    _, inverse, counts = np.unique(
        np.where(anchor < 0, ~anchor, anchor), return_inverse=True, return_counts=True
    )
    met = np.flatnonzero((counts[inverse] > 1) | (anchor < 0))
    data, bounds = tx.flat(coded.dictionary.take(pa.array(met)))
    segment = offset = interval = np.empty(0, np.int64)
    if len(met):
        segment, offset, interval = repeated_intervals(data, np.diff(bounds), span, shard_bytes)
        segment = met[segment]
    # the earliest start of each interval
    distinct_ids, id_rank = np.unique(ids[lead], return_inverse=True)
    start_of = starts[lead][segment] + offset
    by = np.lexsort((start_of, id_rank[segment], interval))
    head = np.concatenate([[True], np.diff(interval[by]) != 0]) if len(by) else np.empty(0, bool)
    best = by[np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))] if len(by) else by
    later = np.zeros(len(by), bool)
    later[by] = (id_rank[segment][by] != id_rank[segment][best]) | (start_of[by] != start_of[best])
    segment, offset = segment[later], offset[later]
    by = np.lexsort((offset, segment))
    segment, offset = segment[by], offset[by]
    # neighbouring windows in one go
    new = np.flatnonzero((np.diff(segment) != 0) | (np.diff(offset) != 1)) + 1
    new = np.concatenate([[0], new]) if len(segment) else np.empty(0, np.int64)
    count = np.diff(np.append(new, len(segment)))
    segment, offset = segment[new], offset[new]
    # to the rows: first ones lose these runs, later ones lose all
    order = np.argsort(segment, kind="stable")
    lo = np.searchsorted(segment, np.arange(len(lead)), "left")
    hi = np.searchsorted(segment, np.arange(len(lead)), "right")
    firsts = np.flatnonzero(is_first)
    runs = (hi - lo)[code[firsts]]
    at = tx.ranges(lo[code[firsts]], runs)
    owner = np.concatenate([np.repeat(firsts, runs), np.flatnonzero(~is_first)])
    begin = np.concatenate([offset[at], np.zeros(int((~is_first).sum()), np.int64)])
    length = np.concatenate([count[at] + span - 1, size[~is_first]])
    lost = pa.table({
        "block": table["block"].take(pa.array(owner)),
        "row": table["row"].take(pa.array(owner)),
        "start": pa.array(starts[owner] + begin, pa.int64()),
        "size": pa.array(length, pa.int32()),
    })
    return pa.concat_tables([lost, rest])


@tx.lean
def cut_block(table: pa.Table, gone: pa.Table) -> pa.Table:
    """The texts of a block without what is gone."""
    table = _sorted_block(table) if table.num_rows else table
    data, offsets = tx.flat(table["text"])
    n = table.num_rows
    change = np.zeros(len(data) + 1, np.int32)
    row = gone["row"].to_numpy()
    begin = offsets[row] + gone["start"].to_numpy()
    np.add.at(change, begin, 1)
    np.add.at(change, begin + gone["size"].to_numpy(), -1)
    out = np.cumsum(change[:-1]) > 0
    edge = np.diff(out.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    inner = np.setdiff1d(offsets[1:-1], [0, len(data)])  # a run ends with its text
    inner = inner[out[inner] & out[inner - 1]] if len(inner) else inner
    starts = np.sort(np.concatenate([starts, inner]))
    ends = np.sort(np.concatenate([ends, inner]))
    doc = np.searchsorted(offsets, starts, "right") - 1
    kept = np.concatenate([[0], np.cumsum(~out)])[offsets]
    texts = tx.as_strings(data[~out], kept).cast(pa.binary())
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(starts - offsets[doc], pa.int64()), pa.array(ends - offsets[doc], pa.int64())],
            names=["start", "end"],
        ),
    )
    return pa.table({
        "id": table["id"],
        "rest": table["rest"],
        "n_bytes": pa.array(np.diff(offsets), pa.int64()),
        "spans": spans,
        "kept": texts,
    })


def remove_repeats(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT_ANCHOR,
    shard_bytes: int = SHARD_BYTES,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """Returns ``key``, ``columns`` (carried along as they are), n_bytes, spans (array of start and end, the bytes removed) and kept
    (binary, the bytes that are left) for every row.

    ``key`` is an integer; smaller ones come first, null before all. A byte goes if it lies in
    ``span`` bytes that start earlier as well: under a smaller key, or under the same key
    nearer the front. Rows that share key and text are therefore treated alike and do not
    remove each other. Null and empty texts, and texts shorter than ``span``, keep all they
    have. Cuts may fall within a character, so what is left is binary. An empty table gives no
    rows; other columns are not read.
    """
    if not 8 <= gram <= span - 1 or span - gram + 1 > 128:
        raise ValueError("gram must be below span, and span - gram below 128")
    work = Workspace(documents.sparkSession, "suffixes")
    rest = F.struct(*[F.col(c) for c in columns], F.lit(0).alias("_")).alias("rest")
    source = documents.select(F.col(key).alias("id"), F.col(text).alias("text"), rest)
    table, count = blocked(work, source, "id", "text", block_bytes, ("rest",))
    whole, table = table, table.drop("rest")
    kind = table.schema["id"].dataType.simpleString()
    buckets = max(32, count // BLOCKS_PER_BUCKET)

    def again(found: DataFrame, most: int, name: str) -> DataFrame:
        grouped = found.groupBy("bucket")
        return work.keep(grouped.applyInArrow(lambda t: repeated_anchors(t, most), REPEATED), name)

    found = table.groupBy("block").applyInArrow(
        lambda t: block_anchors(t, span, gram, buckets), ANCHORS
    )
    repeated = again(found, hot, "repeated")
    warm = repeated.filter("n_hot > 0")
    if not warm.isEmpty():
        found = table.groupBy("block").cogroup(warm.groupBy("block")).applyInArrow(
            lambda t, r: hot_windows(t, r, span, gram, buckets), ANCHORS
        )
        windows = again(found, 1 << 62, "windows").withColumn("hot", F.lit(None).cast("binary"))
        repeated = repeated.unionByName(windows)
    segments = table.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
        lambda t, r: block_segments(t, r, span, gram, max(32, 2 * count)), SEGMENT
    )
    gone = work.keep(
        segments.groupBy("bucket").applyInArrow(lambda t: bucket_spans(t, span, shard_bytes), GONE),
        "gone",
    )
    cut = whole.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(
        lambda t, g: cut_block(t, g),
        f"id {kind}, rest {source.schema['rest'].dataType.simpleString()}, n_bytes long, "
        "spans array<struct<start:long,end:long>>, kept binary",
    )
    carried = [F.col("rest")[c].alias(c) for c in columns]
    return work.finish(cut.select(F.col("id").alias(key), *carried, "n_bytes", "spans", "kept"))
