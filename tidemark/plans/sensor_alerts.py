"""Sensor messages → window averages → alerts by limits → alert messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas
from tidemark.constants import (
    ALERT_EVERY,
    ALERT_FIELDS,
    CONSOLE_ALERTS,
    WATERMARK_DELAY,
    WINDOW_LENGTH,
    WINDOW_SLIDE,
)
from tidemark.functions import messages
from tidemark.functions.times import event_time, stamp
from tidemark.operators.ranges import Bounds, match_rules
from tidemark.operators.windows import sensor_averages
from tidemark.streaming import runner

HALVES = (
    Bounds("avg_temp", "temperature_min", "temperature_max"),
    Bounds("avg_humidity", "humidity_min", "humidity_max"),
)


def readings(message_rows: DataFrame) -> DataFrame:
    """Sensor messages as rows; the time may be pattern text or epoch seconds."""
    rows = messages.decode(message_rows, schemas.SENSOR)
    return rows.withColumn("timestamp", event_time(F.col("timestamp")))


def alerts(
    rows: DataFrame,
    limits: DataFrame,
    time: str = "timestamp",
    length: str = WINDOW_LENGTH,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK_DELAY,
    scale: int | None = None,
) -> DataFrame:
    """One row per window and limit it violates."""
    averages = sensor_averages(rows, time, length, slide, watermark=watermark, scale=scale)
    return match_rules(averages, limits, HALVES)


def alert_messages(
    found: DataFrame, as_of: str | Column | None = None, key: Column | None = None
) -> DataFrame:
    """Alerts as messages under a random key."""
    timed = found.withColumn("alert_time", stamp(as_of))
    return messages.encode(timed, key, ALERT_FIELDS)


def job(
    message_rows: DataFrame,
    limits: DataFrame,
    checkpoint: str,
    to_bus: Callable[[DataStreamWriter], DataStreamWriter],
    console: bool = False,
    drain: bool = False,
) -> list[DataStreamWriter]:
    """Sensor messages to alert messages: the bus query and, if wanted, a console query.

    Each has a checkpoint and state of its own; start them with
    ``runner.run_until_one_ends``.
    """
    sent = alert_messages(alerts(readings(message_rows), limits))
    out = [to_bus(runner.writer(sent, f"{checkpoint}/bus", "append", ALERT_EVERY, drain))]
    if console:
        shown = runner.writer(sent, f"{checkpoint}/console", "append", ALERT_EVERY, drain)
        out.append(runner.to_console(shown, CONSOLE_ALERTS))
    return out
