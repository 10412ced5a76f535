"""Medal counts appended to a report table, and its freshness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import MEDALS
from tidemark.operators.report import count_by_value, freshness, log_rows
from tidemark.schemas import REPORT_LOG


def create_log(spark: SparkSession, table: str, location: str | None = None) -> None:
    """The report table, if it is absent; ``location`` keeps its files in a given folder."""
    place = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({REPORT_LOG}) USING parquet {place}")


def append_counts(
    spark: SparkSession,
    table: str,
    frame: DataFrame,
    column: str,
    created_at: dt.datetime,
    values: Sequence[str] = MEDALS,
) -> None:
    """One log row per value, for all values in one pass.

    A value that the log holds for this time is left out, so a repeated run adds nothing;
    other values of the time, and earlier times, are added.
    """
    log = spark.table(table)
    last_id = log.agg(F.max("id")).first()[0]
    same_time = F.col("created_at") == F.lit(created_at).cast("timestamp_ntz")
    there = log.where(same_time & F.col("value").isin(*values))
    logged = {r[0] for r in there.select("value").distinct().collect()}
    values = [v for v in values if v not in logged]
    if not values:
        return
    counts = count_by_value(frame, column, values)
    log_rows(counts, created_at, values, last_id or 0).write.mode("append").insertInto(table)


def is_fresh(spark: SparkSession, table: str, as_of: dt.datetime) -> bool:
    """Whether the newest log row is recent; an empty log is not."""
    row = freshness(spark.table(table), as_of).first()
    return bool(row and row["fresh"])
