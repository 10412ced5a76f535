"""Versioned dimensions as a property graph: node tables and an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import CUSTOMER_KEY
from tidemark.functions.times import stamp
from tidemark.operators.joins import hot_key_join


def main_nodes(rows: DataFrame, created_at: str | Column | None = None) -> DataFrame:
    """One node per key."""
    return rows.select(CUSTOMER_KEY).distinct().withColumn("created_at", stamp(created_at))


def _node_id(kind: str, *parts: str) -> Column:
    return F.concat_ws(":", F.lit(kind), *(F.col(p).cast("string") for p in parts))


def version_nodes(dimension: DataFrame) -> DataFrame:
    """One node per version, named by key and start."""
    named = dimension.withColumn("node_id", _node_id("version", CUSTOMER_KEY, "valid_from"))
    return named.drop(CUSTOMER_KEY)


def version_edges(dimension: DataFrame) -> DataFrame:
    """main → version."""
    return dimension.select(
        F.col(CUSTOMER_KEY).alias("src"),
        _node_id("version", CUSTOMER_KEY, "valid_from").alias("dst"),
        F.lit("HAS_VERSION").alias("type"),
    )


def current_nodes(current: DataFrame) -> DataFrame:
    return current.withColumn("node_id", _node_id("current", CUSTOMER_KEY)).drop(CUSTOMER_KEY)


def history_nodes(history: DataFrame) -> DataFrame:
    named = history.withColumn("node_id", _node_id("history", CUSTOMER_KEY, "valid_to"))
    return named.drop(CUSTOMER_KEY)


def current_and_history_edges(current: DataFrame, history: DataFrame) -> DataFrame:
    """main → current and main → history."""
    to_current = current.select(
        F.col(CUSTOMER_KEY).alias("src"),
        _node_id("current", CUSTOMER_KEY).alias("dst"),
        F.lit("HAS_CURRENT").alias("type"),
    )
    to_history = history.select(
        F.col(CUSTOMER_KEY).alias("src"),
        _node_id("history", CUSTOMER_KEY, "valid_to").alias("dst"),
        F.lit("HAS_HISTORY").alias("type"),
    )
    return to_current.unionByName(to_history)


def follow(nodes: DataFrame, edges: DataFrame, targets: DataFrame, kind: str) -> DataFrame:
    """main → target over one hop of edges of a kind.

    The edges of a node with very many targets are spread over tasks; target ids are
    unique, so the second join has no hot key.
    """
    hops = edges.filter(F.col("type") == kind).select(
        F.col("src").alias(CUSTOMER_KEY), F.col("dst").alias("node_id")
    )
    return hot_key_join(hops, nodes, CUSTOMER_KEY).join(targets, "node_id")


def open_versions(nodes: DataFrame, edges: DataFrame, versions: DataFrame) -> DataFrame:
    """main → version pairs whose version is open."""
    return follow(nodes, edges, versions.filter(F.col("is_current")), "HAS_VERSION")
