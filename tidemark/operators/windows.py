"""Statistics per event-time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import PERCENTILE_ACCURACY, QUARTILES, WATERMARK_DELAY
from tidemark.functions.numbers import mean, total

# From this many windows per row on, rows are first summed into panes.
PANES_FROM = 4

# Size of the quantile sketch of a pane: ranks of merged quartiles are off by at most this share
# of the rows, with 99 % confidence.
SKETCH_SIZE = 350
SKETCH_RANK_ERROR = 0.01


def windowed(
    frame: DataFrame,
    time: str,
    length: str,
    slide: str | None = None,
    *aggregates: Column,
    watermark: str | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Aggregates per window, ``[start, end)`` aligned to the epoch.

    Without ``slide`` the windows tumble. On a stream a watermark must be given, or the
    windows would never close.
    """
    if frame.isStreaming:
        if watermark is None:
            raise ValueError("a windowed stream needs a watermark")
        frame = frame.withWatermark(time, watermark)
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return frame.groupBy(window, *groups).agg(*aggregates)


def sensor_averages(
    frame: DataFrame,
    time: str,
    length: str,
    slide: str | None = None,
    temperature: str = "temperature",
    humidity: str = "humidity",
    watermark: str | None = WATERMARK_DELAY,
    scale: int | None = None,
    stream_panes: bool = False,
) -> DataFrame:
    """Average temperature and humidity per window.

    On a table the averages go through panes where a row belongs to many windows. A stream
    does so only with ``stream_panes``, since its windows then come out later, see
    ``pane_averages``.
    """
    by_panes = stream_panes or not frame.isStreaming
    copies = windows_per_row(length, slide) if by_panes else 1.0
    if copies >= PANES_FROM and copies.is_integer():
        wanted = {temperature: "avg_temp", humidity: "avg_humidity"}
        return pane_averages(frame, time, length, slide, wanted, watermark, scale)
    return windowed(
        frame,
        time,
        length,
        slide,
        mean(F.col(temperature), scale).alias("avg_temp"),
        mean(F.col(humidity), scale).alias("avg_humidity"),
        watermark=watermark,
    )


def trade_statistics(
    price: str = "price",
    quantity: str = "quantity",
    accuracy: int = PERCENTILE_ACCURACY,
    scale: int | None = None,
) -> list[Column]:
    """The eight statistics of a window of trades, computed in one pass."""
    p, q = F.col(price), F.col(quantity)
    return [
        mean(p, scale).alias("avg_price"),
        F.min(p).alias("min_price"),
        F.max(p).alias("max_price"),
        F.stddev(p).alias("price_stddev"),
        F.count("*").alias("trade_count"),
        mean(q, scale).alias("avg_quantity"),
        total(q, scale).cast("double").alias("total_volume"),
        F.percentile_approx(p, QUARTILES, accuracy).alias("price_percentiles"),
    ]


def pane_averages(
    frame: DataFrame,
    time: str,
    length: str,
    slide: str,
    measures: dict[str, str],
    watermark: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Sliding averages without copying every row into each of its windows.

    Rows are summed once into panes of one slide; the panes, not the rows, then go to the
    ``length / slide`` windows they belong to. Same result as ``windowed`` with ``mean``
    while the work per row no longer grows with that ratio. ``measures`` maps a column to
    the name of its average.

    On a stream it runs in append mode, and a pane stays open until the last window over it
    may close: the watermark is held back by ``length`` less ``slide``. A row that comes late
    but within the watermark of any of its windows counts in all of them. State is a row per
    open pane, and a window comes out that much later than from ``windowed``.
    """
    partial, final = [], []
    for m, name in measures.items():
        partial += [total(F.col(m), scale).alias(f"_s_{m}"), F.count(m).alias(f"_n_{m}")]
        final.append((F.sum(f"_s_{m}").cast("double") / F.sum(f"_n_{m}")).alias(name))
    return _over_panes(frame, time, length, slide, watermark, partial).agg(*final)


def _over_panes(
    frame: DataFrame,
    time: str,
    length: str,
    slide: str,
    watermark: str | None,
    partial: Sequence[Column],
):
    """Panes of one slide with their partial aggregates, grouped by the windows over them."""
    if frame.isStreaming and watermark:
        held = _micros(watermark) + _micros(length) - _micros(slide)
        watermark = f"{held} microseconds"
    panes = windowed(frame, time, slide, None, *partial, watermark=watermark)
    return panes.groupBy(F.window("window", length, slide).alias("window"))


def pane_statistics(
    frame: DataFrame,
    time: str,
    length: str,
    slide: str,
    price: str = "price",
    quantity: str = "quantity",
    watermark: str | None = None,
    scale: int | None = None,
    sketch_size: int = SKETCH_SIZE,
) -> DataFrame:
    """The eight statistics of ``trade_statistics`` per sliding window, from panes.

    A pane keeps counts, sums, extremes, mean and squared deviations and a quantile sketch;
    windows merge them, so a row is touched once however many windows hold it. All but the
    quartiles are those of the rows; the quartiles are values whose ranks are off by at most
    SKETCH_RANK_ERROR. On a stream as in ``pane_averages``.
    """
    p, q = F.col(price).cast("double"), F.col(quantity)
    moments = F.struct(
        F.count(p).alias("n"), F.avg(p).alias("mean"), (F.var_pop(p) * F.count(p)).alias("squares")
    )
    partial = [
        F.count("*").alias("_rows"),
        moments.alias("_moments"),
        total(F.col(price), scale).alias("_sum"),
        F.min(price).alias("_min"),
        F.max(price).alias("_max"),
        F.count(q).alias("_nq"),
        total(q, scale).alias("_sum_q"),
        F.kll_sketch_agg_double(p, F.lit(sketch_size)).alias("_sketch"),
    ]
    merged = F.aggregate(
        F.collect_list("_moments"),  # one per pane of the window
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares")),
        _merged_moments,
    )
    grouped = _over_panes(frame, time, length, slide, watermark, partial).agg(
        F.sum("_rows").alias("trade_count"),
        merged.alias("_m"),
        F.sum("_sum").cast("double").alias("_sum"),
        F.min("_min").alias("min_price"),
        F.max("_max").alias("max_price"),
        F.sum("_nq").alias("_nq"),
        F.sum("_sum_q").cast("double").alias("total_volume"),
        F.kll_merge_agg_double("_sketch").alias("_sketch"),
    )
    ranks = F.array(*(F.lit(r) for r in QUARTILES))
    return grouped.select(
        "window",
        F.try_divide("_sum", F.col("_m.n")).alias("avg_price"),
        "min_price",
        "max_price",
        F.when(F.col("_m.n") > 1, F.sqrt(F.col("_m.squares") / (F.col("_m.n") - 1))).alias("price_stddev"),
        "trade_count",
        F.try_divide("total_volume", F.col("_nq")).alias("avg_quantity"),
        "total_volume",
        F.when(F.col("_m.n") > 0, F.kll_sketch_get_quantile_double("_sketch", ranks)).alias("price_percentiles"),
    )


def _merged_moments(a: Column, b: Column) -> Column:
    """Count, mean and squared deviations of two sets together."""
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + gap * b["n"] / n).alias("mean"),
        (a["squares"] + b["squares"] + gap * gap * a["n"] * b["n"] / n).alias("squares"),
    )
    return F.when(b["n"] == 0, a).otherwise(both)


def windows_per_row(length: str, slide: str | None) -> float:
    """How many windows hold a time."""
    return _micros(length) / _micros(slide) if slide else 1.0


def _micros(interval: str) -> int:
    """Microseconds of an interval; Spark reads the text, as it does for the windows."""
    query = "SELECT unix_micros(timestamp_seconds(0) + CAST(:i AS INTERVAL)) AS n"
    return SparkSession.active().sql(query, args={"i": interval}).first()["n"]
