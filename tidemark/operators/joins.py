"""Equi joins that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizing import HOT_ROWS, SALTS, measure

# Keys that the sketch of the most frequent ones gives, and that it keeps track of.
MOST_HOT, TRACKED = 1_000, 10_000


def row_salt(frame: DataFrame, salts: int) -> Column:
    """A number below ``salts`` for each row.

    It depends on the row and its input partition only, not on the order of rows, so a
    repeated task gives every row the same salt. Exact copies spread by partition.
    """
    parts = [F.col(f"`{c}`") for c in frame.columns]
    if not frame.isStreaming:
        parts.append(F.spark_partition_id())
    return F.pmod(F.xxhash64(*parts), F.lit(salts)).cast("int")


def hot_key_join(
    rows: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Shuffled join that spreads the keys with more than ``hot_rows`` rows.

    Hot keys are found by a sketch of the most frequent ones, one per task, so no count per
    key is shuffled. A key that holds more than a thousandth of the rows is always found, and
    which keys are spread never changes the result. Rows of a hot key get one of ``salts``
    numbers and only the hot keys' entries of ``table`` are repeated. Rows without a key
    are spread as well. Every pair still meets exactly once.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    name = F.xxhash64(*keys)
    top = F.expr(f"approx_top_k(_name, {MOST_HOT}, {TRACKED})")
    hot = (
        rows.select(name.alias("_name"))
        .agg(F.explode(top).alias("_top"))
        .filter(F.col("_top.count") > hot_rows)
        .select(F.col("_top.item").alias("_name"), F.lit(True).alias("_hot"))
    )
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    salted = (
        rows.withColumn("_spread", row_salt(rows, salts))
        .withColumn("_name", name)
        .join(F.broadcast(hot), "_name", "left")
        .withColumn(
            "_salt",
            F.when(F.col("_hot") | no_key, F.col("_spread")).otherwise(F.lit(0)),
        )
        .drop("_hot", "_spread", "_name")
    )
    repeated = (
        table.withColumn("_name", name)
        .join(F.broadcast(hot), "_name", "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                    F.array(F.lit(0))
                )
            ),
        )
        .drop("_hot", "_name")
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    **limits: int,
) -> DataFrame:
    """Join against a reference table whose measured size decides the way.

    Within the limits the table is broadcast and ``rows`` are not shuffled. Beyond them
    the rows are joined with their hot keys spread. On a stream the table is measured when
    the query is built, so at every restart; without the hint Spark may broadcast the
    micro-batch instead and join all of it in the few tasks that hold the table. Beyond the
    limits, and where the table is a stream too, a stream is joined without a hint.
    """
    if rows.isStreaming and (table.isStreaming or not measure(table).fits(**limits)):
        return rows.join(table, on, how)
    if rows.isStreaming:
        return rows.join(F.broadcast(table), on, how)
    if measure(table).fits(**limits):
        return rows.join(F.broadcast(table), on, how)
    return hot_key_join(rows, table, on, how)
