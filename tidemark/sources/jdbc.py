"""Tables of a relational database."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import DatabaseSettings

FETCH_ROWS = 10_000
WRITE_ROWS = 10_000


def connection(settings: DatabaseSettings) -> dict[str, str]:
    options = {"url": settings.url, "driver": settings.driver}
    if settings.user:
        options["user"] = settings.user
    if settings.password:
        options["password"] = settings.password
    return options


def read_table(
    spark: SparkSession,
    settings: DatabaseSettings,
    table: str,
    split_by: str | None = None,
    partitions: int = 32,
) -> DataFrame:
    """A table; with ``split_by`` (a number or date column) in parallel ranges.

    The range ends are asked from the database, one row.
    """
    base = spark.read.format("jdbc").options(**connection(settings))
    reader = base.option("dbtable", table).option("fetchsize", FETCH_ROWS)
    if split_by:
        ends = base.option(
            "query", f"select min({split_by}) as lo, max({split_by}) as hi from {table}"
        ).load()
        low, high = ends.first()
        if low is not None:
            reader = split(reader, split_by, low, high, partitions)
    return reader.load()


def split(reader, column: str, low, high, partitions: int):
    """Range options of a parallel read."""
    return (
        reader.option("partitionColumn", column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", partitions)
    )


def append_table(frame: DataFrame, settings: DatabaseSettings, table: str) -> None:
    writer = frame.write.format("jdbc").options(**connection(settings))
    writer.option("dbtable", table).option("batchsize", WRITE_ROWS).mode("append").save()


def log_table(
    spark: SparkSession, settings: DatabaseSettings, table: str, empty: DataFrame
) -> tuple[Callable[[int], DataFrame], Callable[[DataFrame], None]]:
    """(read, append) of a log table with ``batch_id``, created from ``empty`` if absent.

    Reading asks the database for the rows of one batch only.
    """
    append_table(empty, settings, table)

    def read(number: int) -> DataFrame:
        reader = spark.read.format("jdbc").options(**connection(settings))
        return reader.option("query", batch_query(table, number)).load()

    return read, lambda rows: append_table(rows, settings, table)


def batch_query(table: str, number: int) -> str:
    return f"select * from {table} where batch_id = {int(number)}"
