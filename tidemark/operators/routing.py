"""Destinations that follow from the data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import SYMBOL_TOPICS, TOPIC_PREFIX
from tidemark.operators.joins import lookup_join
from tidemark.operators.scd import one_per_key
from tidemark.schemas import SYMBOL_TOPIC


def destination_table(
    spark: SparkSession, pairs: Iterable[tuple[str, str]] = SYMBOL_TOPICS
) -> DataFrame:
    """Configured (symbol, topic) pairs as a table; of pairs whose symbols differ in case
    only, the last one counts."""
    last = {symbol.lower(): (symbol, topic) for symbol, topic in pairs}
    return spark.createDataFrame(list(last.values()), SYMBOL_TOPIC)


def route_by_symbol(
    frame: DataFrame, symbol: str = "symbol", prefix: str = TOPIC_PREFIX
) -> DataFrame:
    """Adds ``topic``, the prefix and the symbol; rows without a symbol are dropped."""
    known = frame.filter(F.col(symbol).isNotNull())
    return known.withColumn("topic", F.concat(F.lit(prefix), F.col(symbol)))


def route_by_table(
    frame: DataFrame, destinations: DataFrame, symbol: str = "symbol"
) -> DataFrame:
    """Adds ``topic`` from a (symbol, topic) table; case does not matter, rows without an
    entry are dropped. The symbol comes out in lower case.

    Repeated entries count once; a symbol with two topics ends the query, since a table
    has no order that could choose between them.
    """
    named = destinations.filter(F.col("symbol").isNotNull())
    table = one_per_key(named.select(F.lower("symbol").alias(symbol), "topic").distinct(), symbol)
    lowered = frame.withColumn(symbol, F.lower(F.col(symbol)))
    return lookup_join(lowered, table, symbol)


def keep_listed(frame: DataFrame, listed: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows whose symbol is in ``listed``, whatever its case."""
    wanted = listed.select(F.lower("symbol").alias("_symbol")).distinct()
    marked = frame.withColumn("_symbol", F.lower(F.col(symbol)))
    return lookup_join(marked, wanted, "_symbol", "left_semi").drop("_symbol")


def write_by_topic(frame: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per topic. Tasks write what they hold, so a hot topic stays spread."""
    frame.write.mode(mode).partitionBy("topic").parquet(path)
