"""Range joins: rows against rules that give open intervals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import hot_key_join
from tidemark.operators.rule_totals import Totals, countable, rule_totals
from tidemark.operators.sizing import HOT_ROWS, Size, measure

# Up to here comparing every row with every rule is cheaper than building cells.
LIST_ROWS = 64

# Totals come from pairs while rows times rules are no more; beyond that they are counted.
TOTALS_OF_PAIRS = 1 << 26

# Cell sizes are powers of two between these exponents; rules without an end share one cell.
FINEST, COARSEST = -100, 1000

# Bits of a double: finer cells than the bounds can tell apart are of no use.
DOUBLE_BITS = 52

# On a stream the levels are fixed, so that rules of any width may come later.
STREAM_LEVELS = (*range(-16, 72, 8), COARSEST)


@dataclass(frozen=True)
class Bounds:
    """``low < value < high``; a null bound never matches."""

    value: str
    low: str
    high: str

    def holds(self) -> Column:
        value = F.col(self.value)
        return (value > F.col(self.low)) & (value < F.col(self.high))


def match_rules(
    rows: DataFrame,
    rules: DataFrame,
    halves: Sequence[Bounds],
    list_rows: int = LIST_ROWS,
    hot_rows: int = HOT_ROWS,
    totals: Totals | None = None,
    most_pairs: int = TOTALS_OF_PAIRS,
    **limits: int,
) -> DataFrame:
    """One row per (row, rule) where at least one of ``halves`` holds.

    The rule table is measured when the query is built:

    * a short list is broadcast and compared directly,
    * a longer one is placed on cells, so that rows meet only the rules near them by an
      equi join; the cells are broadcast while small, beyond that both sides are shuffled
      with the crowded cells spread over tasks.

    On a stream nothing is measured and no hint is given, since the rules may grow while it
    runs: the rules are placed on a fixed set of levels and Spark plans every micro-batch by
    the size they have then. Every way gives the same pairs; ``Bounds.holds`` decides on the
    values as they are.

    With ``totals`` the pairs are summed up per group of rules. Where rows times rules exceed
    ``most_pairs``, number ranges are counted without building the pairs (``rule_totals``).

    A pair that several halves find counts for the first of them only, so it appears once
    and equal rows stay apart.
    """
    if totals:
        if countable(rows, rules, halves):
            count = rules.count()
            if count > list_rows and count * rows.count() > most_pairs:
                return rule_totals(rows, rules, halves, totals, **limits)
        pairs = match_rules(rows, rules, halves, list_rows, hot_rows, **limits)
        return totals.of_pairs(pairs)
    if rows.isStreaming:
        return _match_by_cells(rows, rules, halves, False, hot_rows)
    size = measure(rules)
    if size.rows <= list_rows and size.fits(**limits):
        either = reduce(lambda a, b: a | b, (h.holds() for h in halves))
        return rows.join(F.broadcast(rules), either)
    copies = 2 * len(halves)
    placed = Size(size.rows * copies, size.bytes * copies)
    return _match_by_cells(rows, rules, halves, placed.fits(**limits), hot_rows)


def _match_by_cells(
    rows: DataFrame, rules: DataFrame, halves: Sequence[Bounds], small: bool, hot_rows: int
) -> DataFrame:
    """Equi join on (half, level, cell).

    A rule lives at the level whose cells are at least as wide as the rule, so it covers
    at most two of them; a row looks into its one cell at each level in use. A pair can
    therefore meet in one cell only.
    """
    levels = STREAM_LEVELS if rows.isStreaming else None
    placed = reduce(
        DataFrame.unionByName,
        (_place(rules, i, half, levels) for i, half in enumerate(halves)),
    )
    if levels:
        used = [(half, level) for half in range(len(halves)) for level in levels]
    else:  # at most (COARSEST - FINEST + 1) values per half
        used = [tuple(r) for r in placed.select("_half", "_level").distinct().collect()]
    looks = [
        F.struct(
            F.lit(half).alias("_half"),
            F.lit(level).alias("_level"),
            _cell(F.col(halves[half].value).cast("double"), F.lit(level)).alias("_cell"),
        )
        for half, level in sorted(used)
    ]
    if not looks:
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rules.schema.fields]
        return rows.filter(F.lit(False)).select(*rows.columns, *none)
    on = ["_half", "_level", "_cell"]
    probes = rows.withColumn("_look", F.explode(F.array(*looks)))
    probes = probes.select(*rows.columns, "_look.*")
    if small:
        pairs = probes.join(F.broadcast(placed), on)
    elif rows.isStreaming:
        pairs = probes.join(placed, on)
    else:
        pairs = hot_key_join(probes, placed, on, hot_rows=hot_rows)
    found = F.lit(False)
    for i, half in enumerate(halves):
        first = half.holds()
        for earlier in halves[:i]:
            first = first & ~F.coalesce(earlier.holds(), F.lit(False))
        found = found | ((F.col("_half") == i) & first)
    return pairs.filter(found).select(*rows.columns, *rules.columns)


def _place(
    rules: DataFrame, number: int, half: Bounds, levels: Sequence[int] | None = None
) -> DataFrame:
    """The rules of one half on their cells; with ``levels`` on the next coarser of them.

    Cells are taken from the bounds as doubles. Rounding keeps their order, so the cell of
    a value between them is one of the two end cells, or both are one; rules are left out by
    their own types only.
    """
    low, high = F.col(half.low).cast("double"), F.col(half.high).cast("double")
    # The small addend keeps a rounded logarithm from choosing too fine a level. Bounds that
    # are one double have no logarithm; greatest passes over it.
    width = F.log2(high - low) + F.lit(1e-9)
    told_apart = F.log2(F.greatest(F.abs(low), F.abs(high))) - F.lit(float(DOUBLE_BITS))
    finest, coarsest = F.lit(float(FINEST)), F.lit(float(COARSEST))
    level = F.ceil(F.least(F.greatest(width, told_apart, finest), coarsest)).cast("int")
    if levels:
        level = F.least(*(F.when(level <= n, F.lit(n)) for n in levels))
    ends = F.array(_cell(low, F.col("_level")), _cell(high, F.col("_level")))
    return (
        rules.filter(F.col(half.low) < F.col(half.high))
        .withColumn("_half", F.lit(number))
        .withColumn("_level", level)
        .withColumn("_cell", F.explode(F.array_distinct(ends)))
    )


def _cell(value: Column, level: Column) -> Column:
    """Number of the cell that holds ``value``; one common cell at the coarsest level."""
    return F.when(level >= COARSEST, F.lit(0).cast("bigint")).otherwise(
        F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")
    )
