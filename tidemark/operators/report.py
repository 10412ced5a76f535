"""Counts by value, kept in a report log, and the freshness of the log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import FRESH_SECONDS, MEDALS
from tidemark.functions.times import wall_clock


def count_by_value(
    frame: DataFrame, column: str, values: Sequence[str] = MEDALS
) -> DataFrame:
    """Rows per listed value, all values in one pass; a value without rows is absent."""
    return (
        frame.filter(F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("count"))
    )


def log_rows(
    counts: DataFrame, created_at: dt.datetime, values: Sequence[str] = MEDALS, last_id: int = 0
) -> DataFrame:
    """Counts as rows of the report log.

    Ids go up from ``last_id`` in the order of ``values``; they need no sort, since the
    list bounds the rows.
    """
    place = F.array_position(F.array(*(F.lit(v) for v in values)), F.col("value"))
    return counts.select(
        (F.lit(last_id) + place).cast("bigint").alias("id"),
        "value",
        "count",
        wall_clock(created_at).alias("created_at"),
    )


def newest(log: DataFrame, by: str = "id") -> DataFrame:
    """The newest row of a log."""
    return log.orderBy(F.col(by).desc()).limit(1)


def freshness(
    log: DataFrame,
    as_of: dt.datetime | Column,
    by: str = "id",
    time: str = "created_at",
    seconds: int = FRESH_SECONDS,
) -> DataFrame:
    """Whether the newest row is younger than ``seconds``, in real seconds."""
    at = as_of if isinstance(as_of, Column) else wall_clock(as_of)
    age = F.timestamp_diff("MICROSECOND", F.col(time), at)
    return newest(log, by).withColumn("fresh", age < F.lit(seconds * 1_000_000))
