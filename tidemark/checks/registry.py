"""Named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dates_as_text(frame: DataFrame) -> DataFrame:
    """Dates as ISO text, for comparing results of two engines."""
    return frame.select(
        *(
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f.name)
            for f in frame.schema.fields
        )
    )
