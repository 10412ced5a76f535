"""Result messages joined with the athletes, as running averages per group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas
from tidemark.constants import AVERAGES_EVERY, GROUPS, MEASURES
from tidemark.functions import messages
from tidemark.functions.numbers import number
from tidemark.functions.times import stamp
from tidemark.operators.averages import group_averages
from tidemark.operators.cleaning import keep_numeric
from tidemark.streaming import runner
from tidemark.streaming.sinks import append_once, to_all


def publishable(results: DataFrame, key: str = "result_id") -> DataFrame:
    """Result rows as messages, keyed by the result or by the athlete."""
    return messages.encode(results, F.col(key))


def enriched(
    results: DataFrame,
    athletes: DataFrame,
    kind: str = "float",
    broadcast_results: bool = False,
) -> DataFrame:
    """Results with sex, height and weight of their athlete; athletes without numeric
    height and weight are left out.

    No hint is given for the athletes: every micro-batch is planned anew, and they are
    broadcast as long as the table is below Spark's threshold. Where the table is too
    large for that, ``broadcast_results`` sends the micro-batch to the athletes instead,
    so that they are not shuffled for every batch. Use it only on a stream with an intake
    limit, which bounds what is sent.
    """
    if broadcast_results and not results.isStreaming:
        raise ValueError("only a micro-batch is bounded enough to be broadcast")
    valid = keep_numeric(athletes, "height", "weight").select(
        "athlete_id",
        "sex",
        number(F.col("height"), kind).alias("height"),
        number(F.col("weight"), kind).alias("weight"),
    )
    left = F.broadcast(results) if broadcast_results else results
    return left.join(valid, "athlete_id").select(*GROUPS, *MEASURES)


def running_averages(
    message_rows: DataFrame,
    athletes: DataFrame,
    as_of: str | Column | None = None,
    kind: str = "float",
    scale: int | None = None,
    broadcast_results: bool = False,
) -> DataFrame:
    """Messages → results → enriched rows → averages per group.

    On a stream the groups are kept as state without a time bound, one entry per group;
    run it in update mode.
    """
    results = messages.decode(message_rows, schemas.EVENT_RESULT)
    return group_averages(
        enriched(results, athletes, kind, broadcast_results),
        GROUPS,
        MEASURES,
        stamp(as_of).alias("calculation_time"),
        scale=scale,
    )


def job(
    averages: DataFrame,
    checkpoint: str,
    publish: Callable[[DataFrame], None],
    read: Callable[[int], DataFrame],
    append: Callable[[DataFrame], None],
    drain: bool = False,
) -> DataStreamWriter:
    """Running averages to the message bus and to a table, from one computation.

    ``publish`` takes messages, ``read`` and ``append`` belong to the table, which thereby
    holds the history of the averages: each batch adds the groups it changed.
    """

    def to_bus(batch: DataFrame, number: int) -> None:
        publish(messages.encode(batch))

    sink = to_all(to_bus, append_once(read, append, GROUPS))
    out = runner.writer(averages, checkpoint, "update", AVERAGES_EVERY, drain)
    return runner.to_batches(out, sink)


def read_back(
    message_rows: DataFrame, encoded_twice: bool = True, strip: bool = False
) -> DataFrame:
    """Averages from their topic, also where the text was encoded twice.

    Double encoding is undone without loss. ``strip`` drops backslashes and outer quotes
    instead, for topics whose text is escaped but is no JSON string.
    """
    text = F.col("value").cast("string")
    if encoded_twice:
        plain = messages.strip_escapes(text) if strip else messages.inner_json(text)
        text = F.coalesce(plain, text)
    return messages.decode(message_rows, schemas.GROUP_AVERAGE, text)
