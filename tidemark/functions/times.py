"""Event times."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import SECOND_PATTERN


def from_text(column: Column, pattern: str = SECOND_PATTERN) -> Column:
    """Text to timestamp; text that does not fit the pattern becomes null."""
    return F.try_to_timestamp(column, F.lit(pattern))


def from_epoch_text(column: Column) -> Column:
    """Epoch seconds, whole or with a fraction, held as text."""
    seconds = column.try_cast("double")
    return F.timestamp_micros(F.round(seconds * 1_000_000).try_cast("bigint"))


def event_time(column: Column, pattern: str = SECOND_PATTERN) -> Column:
    """Either spelling a sensor may send: pattern text or epoch seconds."""
    return F.coalesce(from_text(column, pattern), from_epoch_text(column))


def from_epoch_millis(column: Column) -> Column:
    return F.timestamp_millis(column)


def utc_wall_clock(column: Column) -> Column:
    """Timestamp to the zone-less wall clock in UTC, whatever the session zone is."""
    return F.convert_timezone(None, F.lit("UTC"), column)


def wall_clock(at: dt.datetime) -> Column:
    """A fixed zone-less time, the same under every session zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def stamp(as_of: str | Column | None = None) -> Column:
    """Load time: now, or the given time so that a run can be repeated."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")
