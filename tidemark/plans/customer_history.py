"""First load and later batches of a customer dimension, for each type of history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import scd
from tidemark.sources.dimension_store import DimensionStore, Rules
from tidemark.sources.files import read_customers


def from_files(
    spark: SparkSession,
    path: str,
    first: str,
    later: list[tuple[str, dt.date]],
    first_day: dt.date,
    rules: Rules = scd.TYPE2_RELATIONAL,
) -> DimensionStore:
    """Customer files of consecutive days as one stored dimension, of the type of its rules.

    The first load inserts each key once and does nothing where the dimension exists; a
    key that repeats in a later file ends that merge.
    """
    store = DimensionStore(spark, path, rules)
    store.publish_first(read_customers(spark, first), first_day)
    for file, day in later:
        store.publish(read_customers(spark, file), day)
    return store


def published(
    spark: SparkSession,
    path: str,
    first: DataFrame,
    later: list[tuple[DataFrame, dt.date]],
    first_day: dt.date,
    rules: Rules = scd.TYPE2_RELATIONAL,
) -> DimensionStore:
    """As from_files, from tables."""
    store = DimensionStore(spark, path, rules)
    store.publish_first(first, first_day)
    for changes, day in later:
        store.publish(changes, day)
    return store


def type3_two_days(
    first: DataFrame,
    changes: DataFrame,
    day: dt.date,
    rules: scd.Type3Rules = scd.TYPE3_RELATIONAL,
) -> DataFrame:
    return scd.type3_merge(scd.type3_load(first, rules), changes, day, rules)


def type4_two_days(
    first: DataFrame,
    changes: DataFrame,
    first_day: dt.date,
    day: dt.date,
    rules: scd.Type4Rules = scd.TYPE4_RELATIONAL,
    close_open_history: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(current, history) after the first load and one batch of changes."""
    current, history = scd.type4_load(first, first_day, rules)
    return scd.type4_merge(
        current, history, changes, day, rules, close_open_history=close_open_history
    )
