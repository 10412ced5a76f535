"""Raw files → bronze → silver → gold averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.constants import GROUPS, MEASURES
from tidemark.functions.times import stamp
from tidemark.operators.averages import joined_averages
from tidemark.operators.cleaning import clean_strings, distinct_rows
from tidemark.sources.files import read_csv, read_parquet, write_checked


def to_bronze(
    spark: SparkSession, csv_path: str, bronze: str, schema: str | None = None
) -> DataFrame:
    """A CSV table as parquet. Without a schema the types are inferred."""
    return write_checked(read_csv(spark, csv_path, schema, infer=schema is None), bronze)


def silver(bronze: DataFrame) -> DataFrame:
    """Cleaned text, each row once."""
    return distinct_rows(clean_strings(bronze))


def gold(
    results: DataFrame,
    athletes: DataFrame,
    as_of: str | Column | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Average height and weight of the athletes behind the results, per sport, medal,
    sex and the country of the result."""
    return joined_averages(
        results,
        athletes,
        "athlete_id",
        GROUPS,
        MEASURES,
        stamp(as_of).alias("timestamp"),
        scale=scale,
    )


def run(
    spark: SparkSession,
    landing: dict[str, str],
    lake: str,
    schemas: dict[str, str] | None = None,
    as_of: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """End to end: every landed table to bronze and silver, then the gold table.

    ``landing`` maps ``athlete_bio`` and ``athlete_event_results`` to their CSV paths.
    """
    for table, path in landing.items():
        to_bronze(spark, path, f"{lake}/bronze/{table}", (schemas or {}).get(table))
        cleaned = silver(read_parquet(spark, f"{lake}/bronze/{table}"))
        write_checked(cleaned, f"{lake}/silver/{table}")
    averages = gold(
        read_parquet(spark, f"{lake}/silver/athlete_event_results"),
        read_parquet(spark, f"{lake}/silver/athlete_bio"),
        as_of,
        scale,
    )
    return write_checked(averages, f"{lake}/gold/avg_stats")
