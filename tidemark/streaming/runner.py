"""Starting, draining and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BatchSink = Callable[[DataFrame, int], None]


def writer(
    frame: DataFrame,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    drain: bool = False,
    name: str | None = None,
) -> DataStreamWriter:
    """A stream writer with its own checkpoint; ``drain`` stops after the waiting data."""
    if not checkpoint:
        raise ValueError("every query needs its own checkpoint folder")
    out = frame.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        out = out.queryName(name)
    if drain:
        return out.trigger(availableNow=True)
    return out.trigger(processingTime=every) if every else out


def to_console(out: DataStreamWriter, rows: int = 20) -> DataStreamWriter:
    return out.format("console").option("truncate", "false").option("numRows", rows)


def to_files(out: DataStreamWriter, path: str, *partitions: str) -> DataStreamWriter:
    """Append-mode rows to parquet; the sink's own log makes each batch appear once."""
    out = out.format("parquet").option("path", path)
    return out.partitionBy(*partitions) if partitions else out


def to_batches(out: DataStreamWriter, sink: BatchSink) -> DataStreamWriter:
    return out.foreachBatch(sink)


def finish(query: StreamingQuery) -> None:
    """Wait for a drained query; its error is raised here."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


def run_until_one_ends(spark: SparkSession, writers: Sequence[DataStreamWriter]) -> None:
    """Start all queries before waiting; when one ends, stop the others.

    The error of a failed query is raised. Queries that ended earlier do not count.
    """
    started: list[StreamingQuery] = []
    spark.streams.resetTerminated()
    try:
        for out in writers:
            started.append(out.start())
        spark.streams.awaitAnyTermination()
    finally:
        for query in started:
            query.stop()
