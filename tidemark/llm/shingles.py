"""Jaccard join of word n-grams by signature trees.

A document is the set of its distinct shingles. Documents with one set are one node.

* Two linked sets share a sixth of their shingles within each side's rarest five twelfths (at
  a similarity of 0.75), where rare means few occurrences in a table of counted hash cells over
  all documents, then small hash. A node of which fewer shingles there occur in another node
  cannot be linked and goes no further. The table tells apart fewer shingles the more documents
  there are, so those that meet are counted one by one, and the commonest of each node go as far
  as linked sets still share a twelfth, then one; nodes with less go. The others are candidates
  of each other where they meet; connected candidates are a family. A passage that documents
  share is a small part of most of them, and a common one comes last in both orders, so it does
  not tie them together, whatever the input.
* A family's sets are sent once; a small table of marks tells whose sets are needed. Its
  signature tree holds in every tree node the OR of the bitmaps below, the range of set sizes and
  how many shingles share bits at most. The tree is walked against itself; a pair of tree nodes
  is left out when no pair below can overlap enough, or when all below belong together already.
  What is left is compared shingle by shingle. A family beyond a bound is dealt into parts, and
  pairs of parts are walked.
* Links give the classes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts as tx
from tidemark.llm.components import components
from tidemark.llm.workspace import Workspace, block_count

WORDS = 5
PERCENT = 75

#: Cells in which occurrences are counted; 2 MiB, whatever the input.
CELLS = 1 << 18

#: Cells of one row on their way from the tasks to the driver; 16 KiB.
PIECE_CELLS = 1 << 11

#: Text whose rare shingles one bucket takes.
BUCKET_BYTES = 8 << 20

#: Nodes of a family that one task takes from either side.
PART_NODES = 2048

#: Marks for one document whose set is sent, and marks at most; 8 MiB. Where the marks run short,
#: more sets are made and dropped when they meet the chosen ones.
MARKS, MOST_MARKS = 64, 1 << 26

#: Rounds in which nodes without enough shingles in common with others are left out; each asks for
#: the least number shared through this afterwards, and for one at least.
ROUNDS = (2, 1, 1 << 30)

LEAF = 32
FLUSH_BYTES = 8 << 20
MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)

SIGN = "kind int, id {id}, n_shingles long, node long, piece int, counts binary"
CELL_PIECE = "piece int, counts binary"
POSTING = "bucket int, hashes binary, nodes binary, least binary"
MET = "bucket int, hashes binary, nodes binary, least binary, counts binary"
MEMBER = "id {id}, node long, shingles binary"


def shingle_sets(column, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data, offsets = tx.flat(column, after=b" ")
    data = tx.LOWER[data]
    starts, ends = tx.word_bounds(data)
    codes, distinct = tx.word_codes(data, starts, ends)
    word = tx.hashes(distinct)[codes] if len(codes) else np.empty(0, np.uint64)
    doc = np.searchsorted(offsets, starts, "right") - 1
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    n = max(0, len(word) - words + 1)
    rolled = np.full(n, words, np.uint64)
    for step in range(words):
        rolled = rolled * MULTIPLIER + word[step : step + n]
    rolled = tx.mix(rolled)
    sets = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= words:
            sets.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:  # the whole sequence is the one shingle
            whole = np.full(1, b - a, np.uint64)
            for w in word[a:b]:
                whole = whole * MULTIPLIER + w
            sets.append(tx.mix(whole))
        else:
            sets.append(rolled[:0])
    return sets


def node_of(shingles: np.ndarray) -> int:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _cell(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (hashes >> np.uint64(11)).astype(np.int64) % cells


def sign_batches(batches, words: int, cells: int, id_type):
    """A row per document with its node, and the counted cells of all of them."""
    counts = np.zeros(cells, np.int64)
    names = ["kind", "id", "n_shingles", "node", "piece", "counts"]
    for part in tx.slices(batches):
        sets = shingle_sets(part["text"], words)
        counts += np.bincount(_cell(np.concatenate(sets), cells), minlength=cells)
        n = len(sets)
        yield pa.RecordBatch.from_arrays([
            pa.array([0] * n, pa.int32()),
            tx.one_array(part["id"]),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
            pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
        ], names=names)
    pieces = cell_pieces(counts)
    n = pieces.num_rows
    if n:
        yield pa.RecordBatch.from_arrays([
            pa.array([1] * n, pa.int32()), pa.nulls(n, id_type), pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.int64()), *pieces.columns,
        ], names=names)


def cell_pieces(counts: np.ndarray) -> pa.RecordBatch:
    """A task's counted cells in pieces; those without a count are left out."""
    parts = [counts[a : a + PIECE_CELLS] for a in range(0, len(counts), PIECE_CELLS)]
    some = [i for i, part in enumerate(parts) if part.any()]
    return pa.RecordBatch.from_arrays([
        pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary()),
    ], names=["piece", "counts"])


def add_piece(table: pa.Table) -> pa.Table:
    total = 0
    for blob in table["counts"]:
        total = total + np.frombuffer(blob.as_buffer(), np.int64)
    return pa.table({
        "piece": table["piece"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary()),
    })


def counted_cells(rows: DataFrame, cells: int) -> np.ndarray:
    """Sums the cells of all tasks, piece by piece; one table of cells comes to the driver."""
    added = rows.groupBy("piece").applyInArrow(lambda t: add_piece(t), CELL_PIECE)
    total = np.zeros(cells, np.int64)
    for row in added.collect():
        one = np.frombuffer(row.counts, np.int64)
        total[row.piece * PIECE_CELLS :][: len(one)] = one
    tx.give_back()
    return total


def least_shared(size: int, percent: int) -> int:
    """How many of the rarest shingles two linked sets share at least."""
    return max(1, size * (100 - percent) // 150)


def rarest(shingles: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """Enough of the rarest shingles that two linked sets must share ``least_shared`` of them.

    At least ``percent`` percent of a set are shared, so of any part of it all but the rest.
    """
    n = len(shingles)
    shared = least_shared(n, percent)
    size = min(n, n - (-(-percent * n // 100)) + shared)
    order = np.lexsort((shingles, counts[_cell(shingles, len(counts))]))
    return shingles[order[:size]]


def by_bucket(key: np.ndarray, buckets: int, **columns: np.ndarray) -> pa.RecordBatch:
    """A row per bucket of the key, a range of it, with the columns' values there in the order of
    the key. Values travel byte by byte, first bytes first, so that like bytes are neighbours."""
    order = np.argsort(key)
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    groups = list(tx.blobs(order, bucket))
    return pa.RecordBatch.from_arrays([
        pa.array([b for b, _ in groups], pa.int32()),
        *(
            pa.array([v[at].view(np.uint8).reshape(len(at), -1).T.tobytes() for _, at in groups], pa.binary())
            for v in columns.values()
        ),
    ], names=["bucket", *columns])


def of_bucket(table: pa.Table, **kinds) -> list[np.ndarray]:
    """The columns of all rows of a bucket."""
    def values(blob, kind) -> np.ndarray:
        parts = np.frombuffer(blob.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1)
        return np.ascontiguousarray(parts.T).view(kind).ravel()

    return [np.concatenate([values(b, kind) for b in table[name]]) for name, kind in kinds.items()]


def posting_batches(batches, words: int, percent: int, buckets: int, cells):
    """Rare shingles with their nodes and how many a linked node shares at least, by bucket of the
    shingles; a node once per task."""
    counts, seen = cells.value, set()
    held: list[tuple] = []
    size = 0

    def flush():
        if not held:
            return
        hashes = np.concatenate([h for h, _, _ in held])
        each = [len(h) for h, _, _ in held]
        nodes = np.repeat(np.array([n for _, n, _ in held], np.int64), each)
        least = np.repeat(np.array([x for _, _, x in held], np.int32), each)
        yield by_bucket(hashes, buckets, hashes=hashes, nodes=nodes, least=least)
        held.clear()

    for part in tx.slices(batches):
        for shingles in shingle_sets(part["text"], words):
            if len(shingles) == 0 or (node := node_of(shingles)) in seen:
                continue
            seen.add(node)
            chosen = rarest(shingles, counts, percent)
            held.append((chosen, node, least_shared(len(shingles), percent)))
            size += 20 * len(chosen)
        if size > FLUSH_BYTES:
            yield from flush()
            size = 0
    yield from flush()


def meeting(table: pa.Table) -> tuple[np.ndarray, ...]:
    """The shingles of a bucket that several nodes have, in order, with those nodes, their
    least numbers and how many nodes each shingle has."""
    hashes, nodes, least = of_bucket(table, hashes=np.uint64, nodes=np.int64, least=np.int32)
    order = np.lexsort((nodes, hashes))
    hashes, nodes, least = hashes[order], nodes[order], least[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (nodes[1:] != nodes[:-1]))  # once per node
    hashes, nodes, least = hashes[new], nodes[new], least[new]
    start = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    count = np.diff(np.append(start, len(hashes)))
    count = np.repeat(count, count)
    many = count > 1
    return hashes[many], nodes[many], least[many], count[many].astype(np.int32)


@tx.lean
def meetings(table: pa.Table, buckets: int) -> pa.Table:
    """``meeting`` by bucket of the nodes."""
    hashes, nodes, least, counts = meeting(table)
    place = tx.mix(nodes.view(np.uint64))
    found = by_bucket(place, buckets, hashes=hashes, nodes=nodes, least=least, counts=counts)
    return pa.Table.from_batches([found])


@tx.lean
def able(table: pa.Table, buckets: int, part: int) -> pa.Table:
    """What nodes of a bucket that may be linked have in common with others, by bucket of the
    shingles. The commonest go, as far as linked nodes still share the least number through
    ``part``, which is then the least number.

    Linked nodes share the larger of their least numbers at least. Of a node that meets m with a
    least number of s, at most m - s are shared with no given linked node; so its rarest m - s + t
    hold the first t of the shared ones, and one more for every one shared beyond s.
    """
    hashes, nodes, least, counts = of_bucket(
        table, hashes=np.uint64, nodes=np.int64, least=np.int32, counts=np.int32
    )
    order = np.lexsort((hashes, counts, nodes))
    hashes, nodes, least = hashes[order], nodes[order], least[order]
    start = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
    met = np.diff(np.append(start, len(nodes)))
    rank = np.arange(len(nodes)) - np.repeat(start, met)
    met = np.repeat(met, met)
    asked = np.maximum(1, least // part)
    keep = (met >= least) & (rank < met - least + asked)
    hashes, nodes, least = hashes[keep], nodes[keep], asked[keep]
    found = by_bucket(hashes, buckets, hashes=hashes, nodes=nodes, least=least)
    return pa.Table.from_batches([found])


def narrowed(postings: DataFrame, buckets: int, part: int) -> DataFrame:
    """The postings without shingles that one node has alone, and without nodes that cannot be
    linked for what is left."""
    met = postings.groupBy("bucket").applyInArrow(lambda t: meetings(t, buckets), MET)
    return met.groupBy("bucket").applyInArrow(lambda t: able(t, buckets, part), POSTING)


@tx.lean
def touches(table: pa.Table) -> pa.Table:
    """Links that tie the nodes of every shingle of a bucket together, once each."""
    hashes, nodes, _, counts = meeting(table)
    first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
    low = np.repeat(nodes[first], counts[first])
    both = np.unique(np.column_stack([nodes, low])[nodes != low], axis=0)
    return pa.table({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})


def marked(places: DataFrame, bits: int) -> np.ndarray:
    """A bit for every place, set where there is one; a row per 4 KiB comes to the driver."""
    rows = places.groupBy(F.shiftright("place", 15).alias("number")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(32767)).alias("bits")
    )
    marks = np.zeros(-(-bits // 32768) * 4096, np.uint8)
    for row in rows.collect():
        marks[row.number * 4096 :][:4096] = np.frombuffer(row.bits, np.uint8)
    return marks


def member_batches(batches, words: int, marks):
    """The sets of documents whose place is marked."""
    def some():
        for batch in batches:
            at = batch["place"].to_numpy()
            yield batch.filter(pa.array((marks.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))

    for part in tx.slices(some()):
        sets = shingle_sets(part["text"], words)
        keep = [i for i, s in enumerate(sets) if len(s)]
        yield pa.RecordBatch.from_arrays([
            tx.one_array(part["id"].take(pa.array(keep, pa.int64()))),
            pa.array([node_of(sets[i]) for i in keep], pa.int64()),
            pa.array([sets[i].tobytes() for i in keep], pa.binary()),
        ], names=["id", "node", "shingles"])


class Tree:
    """A binary tree over sets with bitmaps ORed together, size ranges and shared bits."""

    def __init__(self, sets: list[np.ndarray], at: np.ndarray, bits: int):
        self.at = at
        size = np.array([len(sets[i]) for i in at])
        flags = np.zeros((len(at), bits), bool)
        for row, i in enumerate(at):
            flags[row, (sets[i] >> np.uint64(17)).astype(np.int64) & (bits - 1)] = True
        self.bitmap = np.packbits(flags, axis=1).view(np.uint64)
        self.size = size
        self.shared = size - np.bitwise_count(self.bitmap).sum(1).astype(np.int64)
        begin = np.arange(0, len(at), LEAF)
        levels = [(
            np.bitwise_or.reduceat(self.bitmap, begin, axis=0),
            np.minimum.reduceat(size, begin), np.maximum.reduceat(size, begin),
            np.maximum.reduceat(self.shared, begin),
        )]
        while len(levels[-1][1]) > 1:
            bitmap, low, high, shared = levels[-1]
            pair = np.arange(0, len(low), 2)
            levels.append((
                np.bitwise_or.reduceat(bitmap, pair, axis=0), np.minimum.reduceat(low, pair),
                np.maximum.reduceat(high, pair), np.maximum.reduceat(shared, pair),
            ))
        self.levels = levels

    def members(self, level: int, i: int) -> np.ndarray:
        width = LEAF << level
        return self.at[i * width : (i + 1) * width]


def family_links(table: pa.Table, percent: int) -> pa.Table:
    """Links that connect the nodes of a family, or of two parts of one, as far as they are linked."""
    left, right = table["left"][0].as_py(), table["right"][0].as_py()
    nodes, first = np.unique(table["node"].to_numpy(), return_index=True)
    blobs, side = table["shingles"], table["part"].to_numpy()[first]
    sets = [np.frombuffer(blobs[int(i)].as_py(), np.uint64) for i in first]
    links = linked(sets, np.flatnonzero(side == left), np.flatnonzero(side == right), percent)
    return pa.table({
        "a": pa.array([int(nodes[i]) for i, _ in links], pa.int64()),
        "b": pa.array([int(nodes[j]) for _, j in links], pa.int64()),
    })


def linked(
    sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Walks the trees of two parts against each other; links that join what was apart."""
    if len(left) == 0 or len(right) == 0:
        return []
    sizes = np.array([len(s) for s in sets])
    bits = 1 << int(np.clip(np.ceil(np.log2(4 * np.median(sizes) + 1)), 9, 13))
    alike = np.array_equal(left, right)
    smallest = np.array([int(s[0]) for s in sets], np.uint64)  # likely alike in like sets
    trees = [Tree(sets, part[np.lexsort((sizes[part], smallest[part]))], bits)
             for part in ([left] if alike else [left, right])]
    one, two = trees[0], trees[-1]
    root = np.arange(len(sets))
    links: list[tuple[int, int]] = []

    def may_link(overlap, small, large):
        return (100 + percent) * overlap >= percent * (small + large)

    def leaves(i: int, j: int) -> None:
        a, b = slice(i * LEAF, (i + 1) * LEAF), slice(j * LEAF, (j + 1) * LEAF)
        both = np.bitwise_count(one.bitmap[a][:, None] & two.bitmap[b][None]).sum(2).astype(np.int64)
        x, y = one.size[a][:, None], two.size[b][None]
        most = np.minimum(both + np.minimum(one.shared[a][:, None], two.shared[b][None]), np.minimum(x, y))
        good = may_link(most, x, y)
        if alike and i == j:
            good &= np.arange(len(good))[:, None] < np.arange(good.shape[1])
        u, v = np.nonzero(good)
        near = np.argsort(-(most[u, v] / (x[u, 0] + y[0, v])), kind="stable")
        for p, q in zip(one.at[a][u[near]], two.at[b][v[near]]):
            if root[p] == root[q]:
                continue
            overlap = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
            if may_link(overlap, sizes[p], sizes[q]):
                links.append((p, q))
                root[root == root[p]] = root[q]

    stack = []

    def offer(level_a: int, i: int, level_b: int, j: int) -> None:
        bits_a, low_a, high_a, shared_a = one.levels[level_a]
        bits_b, low_b, high_b, shared_b = two.levels[level_b]
        overlap = int(np.bitwise_count(bits_a[i] & bits_b[j]).sum()) + min(shared_a[i], shared_b[j])
        if not may_link(min(overlap, high_a[i], high_b[j]), low_a[i], low_b[j]):
            return
        if 100 * high_a[i] < percent * low_b[j] or 100 * high_b[j] < percent * low_a[i]:
            return
        stack.append((level_a, i, level_b, j))

    offer(len(one.levels) - 1, 0, len(two.levels) - 1, 0)
    while stack:
        level_a, i, level_b, j = stack.pop()
        roots = root[np.concatenate([one.members(level_a, i), two.members(level_b, j)])]
        if (roots == roots[0]).all():
            continue
        if level_a == level_b == 0:
            leaves(i, j)
        elif level_a >= level_b and alike and level_a == level_b and i == j:
            kids = [k for k in (2 * i, 2 * i + 1) if k < len(one.levels[level_a - 1][1])]
            if len(kids) == 2:  # the pair across comes last
                offer(level_a - 1, kids[0], level_b - 1, kids[1])
            for k in kids:
                offer(level_a - 1, k, level_b - 1, k)
        elif level_a >= level_b:
            for k in (2 * i, 2 * i + 1):
                if k < len(one.levels[level_a - 1][1]):
                    offer(level_a - 1, k, level_b, j)
        else:
            for k in (2 * j, 2 * j + 1):
                if k < len(two.levels[level_b - 1][1]):
                    offer(level_a, i, level_b - 1, k)
    return links


def join(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    cells: int = CELLS,
    bucket_bytes: int = BUCKET_BYTES,
    part_nodes: int = PART_NODES,
) -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id.

    Words are lower-cased (A-Z) and parted by white bytes; shingles are runs of ``words`` of
    them, or the whole text if it has fewer. Two documents are linked when their shingles have
    at least ``percent`` percent in common; component_id is the smallest key reachable by links,
    itself included. Shingles and sets are known by 64-bit hashes.

    Null, empty and white texts have no shingles and are linked with nothing: component_id is
    their own key. A null key gets the smallest key of its class, null if there is none.
    Repeated rows come out once each. An empty table gives no rows; other columns are not read.
    """
    spark = documents.sparkSession
    work = Workspace(spark, "shingles")
    source = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    buckets = max(32, block_count(source, "text", bucket_bytes))
    id_type = source.schema["id"].dataType.simpleString()
    arrow_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    signs = work.keep(
        source.mapInArrow(lambda b: sign_batches(b, words, cells, arrow_type), SIGN.format(id=id_type)),
        "signs",
    )
    cell_rows = signs.where("kind = 1").select("piece", "counts")
    counts = spark.sparkContext.broadcast(counted_cells(cell_rows, cells))
    signs = signs.where("kind = 0").select("id", "n_shingles", "node")

    postings = source.mapInArrow(
        lambda b: posting_batches(b, words, percent, buckets, counts), POSTING
    )
    for part in ROUNDS:
        postings = narrowed(postings, buckets, part)
    touching = work.keep(
        postings.groupBy("bucket").applyInArrow(lambda t: touches(t), "a long, b long"), "touching"
    )
    families = work.keep(components(work, touching, "families", touching.count()), "family")
    work.remove("touching")
    work.drop_shuffles()

    # one document of each candidate node brings the set, to each pair of parts it is in
    parts = families.groupBy("root").agg(F.ceil(F.count("*") / part_nodes).cast("int").alias("parts"))
    chosen = work.keep(
        signs.join(families, "node").groupBy("node", "root").agg(F.min("id").alias("carrier"))
        .join(parts, "root").withColumnRenamed("root", "family"),
        "chosen",
    )
    bits = min(MOST_MARKS, 1 << (MARKS * chosen.count()).bit_length())
    place = F.pmod(F.xxhash64("id"), F.lit(bits)).alias("place")
    marks = spark.sparkContext.broadcast(
        marked(chosen.select(F.col("carrier").alias("id")).select(place), bits)
    )
    sets = source.select("id", "text", place).mapInArrow(
        lambda b: member_batches(b, words, marks), MEMBER.format(id=id_type)
    )
    carried = sets["id"].eqNullSafe(chosen["carrier"]) & (sets["node"] == chosen["node"])
    members = sets.join(chosen, carried).select("family", "parts", chosen["node"], "shingles")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pairs = (
        members.withColumn("part", part).withColumn("other", other)
        .withColumn("left", F.least("part", "other")).withColumn("right", F.greatest("part", "other"))
        .select("family", "left", "right", "part", "node", "shingles")
    )
    links = pairs.groupBy("family", "left", "right").applyInArrow(
        lambda t: family_links(t, percent), "a long, b long"
    )
    roots = work.keep(components(work, links, "classes"), "class")

    placed = signs.join(roots, "node", "left").select(
        "id", "n_shingles", F.coalesce("root", "node").alias("class")
    )
    least = placed.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("first"))
    result = placed.join(least, "class", "left").select(
        F.col("id").alias(key), "n_shingles",
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("first")).alias("component_id"),
    )
    return work.finish(result)
