"""Cleaning of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import DRY_BELOW, HOT_ABOVE, WET_ABOVE
from tidemark.functions.numbers import is_number
from tidemark.functions.text import cleaned


def clean_strings(frame: DataFrame) -> DataFrame:
    """Every text column in lower case and trimmed, in one projection."""
    return frame.select(
        *(
            cleaned(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in frame.schema.fields
        )
    )


def distinct_rows(frame: DataFrame) -> DataFrame:
    """Whole-row distinct; copies collapse in each input task before the shuffle."""
    return frame.dropDuplicates()


def keep_numeric(frame: DataFrame, *columns: str, kind: str = "float") -> DataFrame:
    """Rows whose columns are present and numeric."""
    keep: Column = F.lit(True)
    for name in columns:
        keep = keep & is_number(F.col(name), kind)
    return frame.filter(keep)


def out_of_range(
    frame: DataFrame,
    temperature: str = "temperature",
    humidity: str = "humidity",
    hot: float = HOT_ABOVE,
    dry: float = DRY_BELOW,
    wet: float = WET_ABOVE,
) -> DataFrame:
    """Readings too hot, too dry or too wet."""
    t, h = F.col(temperature), F.col(humidity)
    return frame.filter((t > hot) | (h < dry) | (h > wet))
