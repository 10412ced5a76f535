"""Trades: wire format → normalised → routed → statistics per window → messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas
from tidemark.constants import (
    CONSOLE_EVERY,
    CONSOLE_STATISTICS,
    PERCENTILE_ACCURACY,
    STATISTICS_EVERY,
    STATISTICS_FIELDS,
    WATERMARK_DELAY,
    WINDOW_LENGTH,
    WINDOW_SLIDE,
)
from tidemark.functions import messages
from tidemark.functions.numbers import number_or_zero
from tidemark.functions.times import from_epoch_millis
from tidemark.operators.routing import keep_listed, route_by_symbol
from tidemark.operators.windows import pane_statistics, trade_statistics, windowed
from tidemark.streaming import runner

# The wire keys differ in case only, so they are renamed by position. Price and quantity stay
# variants here: a variant tells a null from a missing key.
_WIRE = (
    "struct<event_type:string,event_time:bigint,symbol:string,trade_id:bigint,"
    "price:variant,quantity:variant,trade_time:bigint,buyer_market_maker:boolean,"
    "ignore:boolean,processing_timestamp:string>"
)


def _wire(message_rows: DataFrame) -> DataFrame:
    """Fields of wire messages, each text being parsed once.

    Text that is no JSON object, or that holds a key twice, gives a row of nulls. A missing
    price or quantity is 0, a null one stays null.
    """
    parsed = F.try_parse_json(F.col("value").cast("string"))
    data = F.try_variant_get(parsed, "$", f"struct<{schemas.RAW_TRADE}>").cast(_WIRE)
    rows = message_rows.select(F.inline(F.array(F.struct(data.alias("m")))))

    def amount(field: str) -> Column:
        text = F.try_variant_get(F.col(f"m.{field}"), "$", "string")
        missing = F.col("m").isNotNull() & F.col(f"m.{field}").isNull()
        return number_or_zero(text, missing).alias(field)

    fields = [f.name for f in rows.schema["m"].dataType.fields]
    return rows.select(
        *(amount(f) if f in ("price", "quantity") else F.col(f"m.{f}").alias(f) for f in fields)
    )


def normalised(message_rows: DataFrame) -> DataFrame:
    """Wire messages as named fields; price and quantity become numbers, 0 if missing."""
    return _wire(message_rows).drop("processing_timestamp")


def compact(message_rows: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """The short form of wire messages: symbol in lower case, price, quantity, trade time
    and the processing time the message may carry.

    Only listed symbols are kept, and only trades whose numbers can be read.
    """
    rows = _wire(message_rows).select(
        F.lower("symbol").alias("symbol"),
        "price",
        "quantity",
        F.coalesce("trade_time", F.lit(0)).alias("timestamp"),
        "processing_timestamp",
    )
    rows = rows.filter(
        F.col("symbol").isNotNull() & F.col("price").isNotNull() & F.col("quantity").isNotNull()
    )
    return rows if listed is None else keep_listed(rows, listed)


def decoded(message_rows: DataFrame) -> DataFrame:
    """Normalised trade messages with their event time as a timestamp."""
    rows = messages.decode(message_rows, schemas.TRADE)
    return rows.withColumn("trade_time", from_epoch_millis(F.col("trade_time")))


def decoded_compact(message_rows: DataFrame) -> DataFrame:
    """Compact trade messages with their time, given in milliseconds, as a timestamp."""
    rows = messages.decode(message_rows, schemas.COMPACT_TRADE)
    return rows.withColumn("trade_time", from_epoch_millis(F.col("timestamp"))).drop("timestamp")


def compact_statistics(
    message_rows: DataFrame,
    length: str = WINDOW_LENGTH,
    slide: str | None = None,
    accuracy: int = PERCENTILE_ACCURACY,
    scale: int | None = None,
) -> DataFrame:
    """The eight statistics per window of compact trade messages.

    Windows tumble unless ``slide`` is given; the watermark is one window long. On a stream
    run it in complete mode.
    """
    trades = decoded_compact(message_rows)
    return statistics(
        trades, length=length, slide=slide, watermark=length, accuracy=accuracy, scale=scale
    )


def statistics(
    trades: DataFrame,
    time: str = "trade_time",
    length: str = WINDOW_LENGTH,
    slide: str | None = WINDOW_SLIDE,
    watermark: str = WATERMARK_DELAY,
    accuracy: int = PERCENTILE_ACCURACY,
    scale: int | None = None,
    panes: bool = False,
) -> DataFrame:
    """The eight statistics per window; with ``panes`` by ``pane_statistics``, for windows that
    slide by a small part of their length."""
    if panes and slide:
        return pane_statistics(trades, time, length, slide, watermark=watermark, scale=scale)
    columns = trade_statistics(accuracy=accuracy, scale=scale)
    return windowed(trades, time, length, slide, *columns, watermark=watermark)


def statistics_messages(stats: DataFrame, key: Column | None = None) -> DataFrame:
    """Window statistics as messages under a random key."""
    return messages.encode(stats, key, STATISTICS_FIELDS)


def routed(message_rows: DataFrame) -> DataFrame:
    """Wire messages as normalised messages, each with the topic of its symbol."""
    rows = route_by_symbol(normalised(message_rows))
    fields = [c for c in rows.columns if c != "topic"]
    return rows.select(
        messages.random_key().alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        "topic",
    )


def routing_job(
    message_rows: DataFrame,
    checkpoint: str,
    to_bus: Callable[[DataStreamWriter], DataStreamWriter],
    drain: bool = False,
) -> DataStreamWriter:
    """Every trade to the topic of its symbol; the bus takes the topic from its column."""
    return to_bus(runner.writer(routed(message_rows), checkpoint, "append", drain=drain))


def statistics_job(
    message_rows: DataFrame,
    checkpoint: str,
    to_bus: Callable[[DataStreamWriter], DataStreamWriter],
    console: bool = False,
    drain: bool = False,
) -> list[DataStreamWriter]:
    """Normalised trade messages to window statistics, sent whenever a window changes."""
    found = statistics(decoded(message_rows))
    sent = statistics_messages(found)
    out = [to_bus(runner.writer(sent, f"{checkpoint}/bus", "update", STATISTICS_EVERY, drain))]
    if console:
        shown = runner.writer(found, f"{checkpoint}/console", "update", CONSOLE_EVERY, drain)
        out.append(runner.to_console(shown, CONSOLE_STATISTICS))
    return out
