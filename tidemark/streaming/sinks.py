"""Batch sinks that may be repeated: after a failure Spark runs a batch again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming.runner import BatchSink


def batch_folders(path: str) -> BatchSink:
    """Each batch in its own folder, overwritten when the batch is repeated."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return write


def append_once(
    read: Callable[[int], DataFrame],
    append: Callable[[DataFrame], None],
    groups: Sequence[str],
) -> BatchSink:
    """Append to a table that cannot replace a batch, such as a database table.

    ``read`` gives the rows the table already holds of a batch (the filter on
    ``batch_id`` runs in the database); groups found there are not appended again.
    Without a failure that is none.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(number).cast("bigint"))
        there = read(number).select(*(F.col(g).alias(f"_{g}") for g in groups))
        same = F.lit(True)
        for g in groups:
            same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
        append(rows.join(there, same, "left_anti"))

    return write


def to_all(*sinks: BatchSink) -> BatchSink:
    """One computation of a batch for several sinks.

    An empty batch is skipped. The batch is kept for the sinks, on disk where memory is
    short. An error in any sink fails the batch, so that Spark repeats it.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if kept.isEmpty():
                return
            for sink in sinks:
                sink(kept, number)
        finally:
            kept.unpersist()

    return write


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Everything the batches appended, with ``batch_id``: the history of the groups."""
    return spark.read.parquet(path)


def latest(log: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The newest row of each group of a log."""
    values = [c for c in log.columns if c not in groups and c != "batch_id"]
    newest = F.max_by(F.struct(*values), F.col("batch_id"))
    return log.groupBy(*groups).agg(newest.alias("_v")).select(*groups, "_v.*")
