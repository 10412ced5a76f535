"""Numbers held as text, and averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(column: Column, kind: str = "double") -> Column:
    """Text to number; text that is no number becomes null, under ANSI too."""
    return column.try_cast(kind)


def is_number(column: Column, kind: str = "float") -> Column:
    return number(column, kind).isNotNull()


def number_or_zero(column: Column, missing: Column | None = None) -> Column:
    """A missing value counts as 0; text that is no number becomes null.

    ``missing`` tells a missing value from a null one; without it every null is missing.
    """
    absent = column.isNull() if missing is None else missing
    return F.when(absent, F.lit(0.0)).otherwise(number(column))


def total(column: Column, scale: int | None = None) -> Column:
    """Sum; with ``scale`` every value is first rounded to that many digits and summed in
    exact decimals, so the row order cannot change the result."""
    if scale is None:
        return F.sum(column.cast("double"))
    return F.sum(column.cast(f"decimal(18,{scale})"))


def mean(column: Column, scale: int | None = None) -> Column:
    """Average; with ``scale`` from an exact sum of values rounded to that many digits."""
    if scale is None:
        return F.avg(column)
    return total(column, scale).cast("double") / F.count(column)
