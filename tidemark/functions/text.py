"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cleaned(column: Column) -> Column:
    """Lower case without leading and trailing spaces; tabs stay."""
    return F.trim(F.lower(column))


def blank_to_empty(column: Column) -> Column:
    """A CSV cell without text is an empty string, not null."""
    return F.coalesce(column, F.lit(""))
