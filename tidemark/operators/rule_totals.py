"""Totals per rule over the rows in its ranges, without building the pairs.

Values become ranks among the distinct values of the rows, so a rule's open range is a range of
ranks. With two ranges per rule the rows in either are those in the first, and those in the
second, less those in both:

* The rows in one range are read from a tree over the ranks with four children per node; a range
  is the union of a few nodes per level, and a node holds its rows' count, minima and maxima.
* The rows in both are counted from four corners. A corner's rank on the first axis is split into
  digits; at each digit the rows that agree in the digits above it and are smaller in this one
  are counted in the order of the second axis. Large groups are cut along the second axis, and
  each cut begins with the counts of those before it.

Work grows with rows and rules times the digits of their number, whatever the ranges hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import lookup_join
from tidemark.session import scratch

# Distinct values that one task puts in order, and the most pieces an axis is cut into for that.
PIECE_VALUES = 200_000
MOST_PIECES = 1_024

# Rows that one task sweeps along the second axis, on average.
SWEEP_ROWS = 1_000_000

DIGITS = 16


@dataclass(frozen=True)
class Totals:
    """Per value of the rules' column ``by``: the number of pairs under the name ``count``, and
    minima and maxima of columns of the rows, by their names in the result."""

    by: str
    count: str
    least: Mapping[str, str] = field(default_factory=dict)
    greatest: Mapping[str, str] = field(default_factory=dict)

    def of_pairs(self, pairs: DataFrame) -> DataFrame:
        return pairs.groupBy(self.by).agg(
            F.count("*").alias(self.count),
            *(F.min(c).alias(name) for name, c in self.least.items()),
            *(F.max(c).alias(name) for name, c in self.greatest.items()),
        )


def countable(rows: DataFrame, rules: DataFrame, halves: Sequence) -> bool:
    """Whether ``rule_totals`` takes these tables: no stream, at most two ranges of numbers."""
    columns = [rows.schema[h.value] for h in halves]
    columns += [rules.schema[c] for h in halves for c in (h.low, h.high)]
    numbers = all(isinstance(c.dataType, T.NumericType) for c in columns)
    return numbers and len(halves) in (1, 2) and not (rows.isStreaming or rules.isStreaming)


def rule_totals(
    rows: DataFrame,
    rules: DataFrame,
    halves: Sequence,
    totals: Totals,
    piece_values: int = PIECE_VALUES,
    sweep_rows: int = SWEEP_ROWS,
    **limits: int,
) -> DataFrame:
    """The totals of the pairs that ``match_rules`` gives; groups without a pair have no row.

    Tables of ranks are written below the shared folder on the way.
    """
    path = scratch(rows.sparkSession, "totals")
    least, greatest = list(totals.least.values()), list(totals.greatest.values())
    kinds = [
        rows.select(h.value).union(rules.select(h.low)).union(rules.select(h.high)).schema[0].dataType
        for h in halves
    ]
    axes = range(len(halves))
    points = rows.select(
        *(F.col(h.value).cast(kind).alias(f"v{k}") for k, h, kind in zip(axes, halves, kinds)),
        *(F.col(c).alias(f"l{i}") for i, c in enumerate(least)),
        *(F.col(c).alias(f"g{i}") for i, c in enumerate(greatest)),
    )
    points = points.groupBy(*(f"v{k}" for k in axes)).agg(F.count("*").alias("n"), *_bounds(totals))
    points = _stored(points, f"{path}/points")
    placed = rules.select(
        F.col(totals.by).alias("by"),
        *(F.col(h.low).cast(kind).alias(f"low{k}") for k, h, kind in zip(axes, halves, kinds)),
        *(F.col(h.high).cast(kind).alias(f"high{k}") for k, h, kind in zip(axes, halves, kinds)),
    )
    sizes = []
    for k in axes:
        ranks, size = _ranks(points, placed, k, f"{path}/axis-{k}", piece_values)
        sizes.append(max(size, 1))
        below, upto = F.col("lt"), F.col("le")
        points = lookup_join(
            points, ranks.select(F.col("v").alias(f"v{k}"), below.alias(f"p{k}")), f"v{k}", "left", **limits
        )
        for bound, rank, name in ((f"low{k}", upto, f"a{k}"), (f"high{k}", below, f"b{k}")):
            table = ranks.select(F.col("v").alias(bound), rank.alias(name))
            placed = lookup_join(placed, table, bound, "left", **limits)
    points = _stored(points, f"{path}/ranked-points")
    any_range = reduce(lambda x, y: x | y, (_holds(k) for k in axes))
    placed = placed.filter(any_range).select("by", *(f"{e}{k}" for k in axes for e in "ab"))
    placed = _stored(placed, f"{path}/ranked-rules")

    parts = [_in_one(points, placed, k, sizes[k], totals, f"{path}/nodes-{k}", limits) for k in axes]
    if len(parts) == 2:
        both = _in_both(points, placed, sizes, sweep_rows)
        nothing = [
            F.lit(None).cast(parts[0].schema[c].dataType).alias(c) for c in parts[0].columns[2:]
        ]
        parts.append(both.select("by", "n", *nothing))
    found = reduce(DataFrame.unionByName, parts).groupBy("by")
    found = found.agg(F.sum("n").alias("n"), *_bounds(totals)).filter("n > 0")
    return found.select(
        F.col("by").alias(totals.by),
        F.col("n").alias(totals.count),
        *(F.col(f"l{i}").alias(name) for i, name in enumerate(totals.least)),
        *(F.col(f"g{i}").alias(name) for i, name in enumerate(totals.greatest)),
    )


def _stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _bounds(totals: Totals) -> list[Column]:
    return [
        *(F.min(f"l{i}").alias(f"l{i}") for i in range(len(totals.least))),
        *(F.max(f"g{i}").alias(f"g{i}") for i in range(len(totals.greatest))),
    ]


def _holds(k: int) -> Column:
    return F.coalesce(F.col(f"a{k}") < F.col(f"b{k}"), F.lit(False))


def _ranks(
    points: DataFrame, rules: DataFrame, k: int, path: str, piece_values: int
) -> tuple[DataFrame, int]:
    """For every value and bound ``v`` how many distinct values are less (``lt``), and less or
    equal (``le``); and how many there are."""
    values = points.select(F.col(f"v{k}").alias("v"), F.lit(1).alias("held"))
    for bound in (f"low{k}", f"high{k}"):
        values = values.union(rules.select(bound, F.lit(0)))
    values = values.filter("v IS NOT NULL").groupBy("v").agg(F.max("held").alias("held"))
    values = _stored(values, f"{path}-values")
    pieces = min(-(-values.count() // piece_values), MOST_PIECES)
    cuts = []
    if pieces > 1:  # where the cuts are changes no rank
        shares = [i / pieces for i in range(1, pieces)]
        cuts = values.agg(F.percentile_approx("v", shares).alias("cuts")).first()["cuts"]
    values = values.withColumn("piece", _piece(F.col("v"), cuts))
    held = dict(values.groupBy("piece").agg(F.sum("held")).collect())
    before, total = [], 0
    for piece in range(len(cuts) + 1):
        before.append(F.lit(total).cast("bigint"))
        total += held.get(piece, 0)
    order = Window.partitionBy("piece").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.get(F.array(*before), F.col("piece")) + F.sum("held").over(order)
    return _stored(values.select("v", (upto - F.col("held")).alias("lt"), upto.alias("le")), path), total


def _piece(value: Column, cuts: Sequence) -> Column:
    """How many of the sorted cuts are not above the value, by halving."""
    if not cuts:
        return F.lit(0)
    table = F.array(*(F.lit(c) for c in cuts))
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))))

    def halve(at: Column, step: Column) -> Column:
        reached = F.coalesce(F.get(table, at + step - 1) <= value, F.lit(False))
        return F.when(reached, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), halve)


def _run(first: str, last: str) -> str:
    """The numbers from ``first`` to ``last``, none if the last is smaller."""
    return f"IF({first} <= {last}, sequence({first}, {last}), CAST(array() AS array<bigint>))"


def _in_one(
    points: DataFrame, rules: DataFrame, k: int, size: int, totals: Totals, path: str, limits: dict
) -> DataFrame:
    """Totals of the rows in the rules' ranges on one axis."""
    levels = 1
    while 4 ** (levels - 1) < size:
        levels += 1
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    sums = [F.sum("n").alias("n"), *_bounds(totals)]
    leaves = points.filter(F.col(f"p{k}").isNotNull()).groupBy(F.col(f"p{k}").alias("p")).agg(*sums)
    nodes = leaves.select("*", level).withColumn("node", F.expr("shiftright(p, 2 * level)"))
    nodes = _stored(nodes.groupBy("level", "node").agg(*sums), path)
    ranges = rules.filter(_holds(k)).select(
        "by", F.col(f"a{k}").alias("a"), F.col(f"b{k}").alias("b"), level
    )
    wide = "shiftleft(1L, 2 * level)"
    ranges = ranges.selectExpr(
        "by", "level", f"shiftright(a + {wide} - 1, 2 * level) AS lo", "shiftright(b, 2 * level) AS hi"
    ).filter("lo < hi")
    ranges = ranges.selectExpr("*", "shiftright(lo + 3, 2) AS up_lo", "shiftright(hi, 2) AS up_hi")
    ends = f"concat({_run('lo', '4 * up_lo - 1')}, {_run('4 * up_hi', 'hi - 1')})"
    ranges = ranges.selectExpr(
        "by", "level", f"explode(IF(up_lo < up_hi, {ends}, {_run('lo', 'hi - 1')})) AS node"
    )
    return lookup_join(ranges, nodes, ["level", "node"], **limits).groupBy("by").agg(*sums)


def _in_both(points: DataFrame, rules: DataFrame, sizes: Sequence[int], sweep_rows: int) -> DataFrame:
    """Per group of rules less the number of rows that lie in both ranges."""
    points = points.filter("p0 IS NOT NULL AND p1 IS NOT NULL").select("p0", "p1", "n")
    rules = rules.filter(_holds(0) & _holds(1))
    corners = rules.select("by", F.explode(F.array(*(
        F.struct(F.col(x).alias("p0"), F.col(y).alias("p1"), F.lit(sign).alias("sign"))
        for x, y, sign in (("b0", "b1", -1), ("a0", "b1", 1), ("b0", "a1", 1), ("a0", "a1", -1))
    ))).alias("corner")).select("by", "corner.*").filter("p0 > 0 AND p1 > 0")

    levels = 1
    while DIGITS**levels <= sizes[0]:
        levels += 1
    swept = points.count() + 4 * rules.count()
    cuts = [-(-swept // (DIGITS ** (levels - 1 - i) * sweep_rows)) for i in range(levels)]
    cuts = F.array(*(F.lit(max(1, min(c, sizes[1]))).cast("bigint") for c in cuts))

    def digits(frame: DataFrame) -> DataFrame:
        frame = frame.select("*", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
        frame = frame.withColumn("cuts", F.get(cuts, F.col("level")))
        return frame.selectExpr(
            "*", "shiftright(p0, 4 * level + 4) AS prefix",
            "CAST(shiftright(p0, 4 * level) & 15 AS INT) AS digit",
            f"least(cuts - 1, p1 * cuts div {sizes[1]}) AS cut",
        ).drop("p0")

    group = ["level", "prefix", "cut", "digit"]
    held = digits(points).groupBy(*group, "cuts", "p1").agg(F.sum("n").alias("n"))
    earlier = held.filter("cut < cuts - 1").groupBy(*group, "cuts").agg(F.sum("n").alias("n"))
    earlier = earlier.withColumn("cut", F.expr("explode(sequence(cut + 1, cuts - 1))"))
    earlier = earlier.groupBy(*group).agg(F.sum("n").alias("n")).withColumn("p1", F.lit(-1).cast("bigint"))
    no_group = F.lit(None).cast(rules.schema["by"].dataType).alias("by")
    none = F.lit(None).cast("int").alias("sign")
    columns = [*group, "p1"]
    rows = held.select(*columns, "n", none, no_group).union(earlier.select(*columns, "n", none, no_group))
    asked = digits(corners).filter("digit > 0")
    rows = rows.union(asked.select(*columns, F.lit(0).cast("bigint"), "sign", "by"))
    # a corner comes ahead of the rows at its own rank
    order = Window.partitionBy("level", "prefix", "cut").orderBy("p1", F.col("sign").isNull())
    order = order.rowsBetween(Window.unboundedPreceding, 0)
    smaller = [
        F.sum(F.when(F.col("digit") < d, F.col("n")).otherwise(0)).over(order).alias(f"s{d}")
        for d in range(1, DIGITS)
    ]
    counted = rows.select("*", *smaller).filter("sign IS NOT NULL")
    number = F.get(F.array(*(F.col(f"s{d}") for d in range(1, DIGITS))), F.col("digit") - 1)
    return counted.groupBy("by").agg(F.sum(F.col("sign") * number).alias("n"))
