"""Averages per group, on one table or over a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import mean, number
from tidemark.operators.joins import hot_key_join
from tidemark.operators.sizing import measure

# Facts are counted per key ahead of a join if that leaves less than this share of them.
COUNTED_SHARE = 0.5


def group_averages(
    frame: DataFrame,
    groups: Sequence[str],
    measures: Mapping[str, str],
    *extra: Column,
    scale: int | None = None,
) -> DataFrame:
    """Average of each measure per group; null keys form a group of their own.

    ``measures`` maps a column to the name of its average. The same call serves a stream.
    """
    return frame.groupBy(*groups).agg(
        *(mean(F.col(c), scale).alias(name) for c, name in measures.items()), *extra
    )


def joined_averages(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    groups: Sequence[str],
    measures: Mapping[str, str],
    *extra: Column,
    kind: str = "double",
    scale: int | None = None,
    **limits: int,
) -> DataFrame:
    """Averages of dimension measures over ``facts ⋈ dimension``, per group.

    Three ways, told apart by measured sizes, with one result:

    * a dimension within the limits is broadcast; the facts are shuffled once, as partial
      averages per group;
    * beyond them the facts are first counted per key and fact-side group, if a sketch of the
      distinct ones says that this leaves less than half of the rows: a key with a third of
      all facts then enters the join as a handful of counted rows;
    * otherwise the facts are joined as they are, their hot keys spread.
    """
    fact_groups = [g for g in groups if g in facts.columns]
    dim_groups = [g for g in groups if g not in fact_groups]
    if key in groups:
        raise ValueError("the join key cannot be a group column here")
    wanted = [key, *fact_groups]
    rows = facts.filter(F.col(key).isNotNull()).select(*wanted)
    values = dimension.select(
        key, *dim_groups, *(number(F.col(m), kind).alias(m) for m in measures)
    )
    if measure(values).fits(**limits):
        return group_averages(
            rows.join(F.broadcast(values), key), groups, measures, *extra, scale=scale
        )
    if not counting_pays(rows, wanted):
        return group_averages(hot_key_join(rows, values, key), groups, measures, *extra, scale=scale)
    joined = rows.groupBy(*wanted).agg(F.count("*").alias("_rows")).join(values, key)
    return joined.groupBy(*groups).agg(
        *(_weighted(m, scale).alias(name) for m, name in measures.items()), *extra
    )


def counting_pays(rows: DataFrame, keys: Sequence[str], share: float = COUNTED_SHARE) -> bool:
    """Whether counting per key leaves less than ``share`` of the rows; from one pass that
    sends a sketch per task."""
    distinct = F.approx_count_distinct(F.xxhash64(*keys)).alias("keys")
    seen = rows.agg(distinct, F.count("*").alias("rows")).first()
    return seen["keys"] < share * seen["rows"]


def _weighted(measure: str, scale: int | None) -> Column:
    value, rows = F.col(measure), F.col("_rows")
    weight = F.sum(F.when(value.isNotNull(), rows))
    if scale is None:
        return F.sum(value.cast("double") * rows) / weight
    exact = F.sum(value.cast(f"decimal(18,{scale})") * rows.cast("decimal(18,0)"))
    return exact.cast("double") / weight
