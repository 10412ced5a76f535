"""Queries that run as streams: the waiting files are drained, the sink is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks import inputs
from tidemark.checks.batch import (
    ALERTS_SQL,
    AVERAGE,
    GOLD_SQL,
    SLIDING_SQL,
    STATISTICS_SQL,
    flat_statistics,
)
from tidemark.checks.registry import query, table
from tidemark.constants import GROUPS
from tidemark.functions import messages, times
from tidemark.operators import routing, windows
from tidemark.plans import enrichment, medallion, sensor_alerts, trades
from tidemark.session import scratch, stream_session
from tidemark.sources.files import stream_folder
from tidemark.streaming import runner, sinks


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    shape = table(spark, folder, name).schema
    return stream_folder(spark, folder, shape, f"{name}.parquet")


def _timed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a zoned time, as watermarks need it."""
    return _stream(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _drain_to_files(rows: DataFrame, path: str, *partitions: str) -> None:
    out = runner.writer(rows, f"{path}/checkpoint", "append", drain=True)
    runner.finish(runner.to_files(out, f"{path}/rows", *partitions).start())


def _drain_to_batches(rows: DataFrame, path: str, sink, mode: str = "update") -> None:
    out = runner.writer(rows, f"{path}/checkpoint", mode, drain=True)
    runner.finish(runner.to_batches(out, sink).start())


# Append mode emits a window once the watermark has passed its end.
CLOSED = "window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND"


@query(
    "stream_window",
    f"""
SELECT window_start, {AVERAGE.format("temperature")} AS avg_temp,
       {AVERAGE.format("humidity")} AS avg_humidity
FROM ({SLIDING_SQL.format(rows=inputs.READINGS_SQL)}) WHERE {CLOSED} GROUP BY 1""",
)
def stream_window(spark: SparkSession, folder: str) -> DataFrame:
    """Append mode with a watermark into files."""
    path, session = scratch(spark, "stream-window"), stream_session(spark)
    rows = inputs.readings(_timed_events(session, folder))
    found = windows.sensor_averages(rows, "ts", "1 hour", "30 minutes", scale=2)
    start = times.utc_wall_clock(F.col("window.start")).alias("window_start")
    _drain_to_files(found.select(start, "avg_temp", "avg_humidity"), path)
    return spark.read.parquet(f"{path}/rows")


@query(
    "stream_many_slides",
    f"""
WITH s AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')
                     - k * INTERVAL 1 HOUR AS window_start
           FROM ({inputs.READINGS_SQL}) CROSS JOIN range(24) AS shift(k))
SELECT window_start, {AVERAGE.format("temperature")} AS avg_temp,
       {AVERAGE.format("humidity")} AS avg_humidity
FROM s
WHERE window_start + INTERVAL 24 HOUR
      <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND
GROUP BY 1""",
)
def stream_many_slides(spark: SparkSession, folder: str) -> DataFrame:
    """Day-long windows every hour: hourly panes as state, then the windows over them."""
    path, session = scratch(spark, "stream-slides"), stream_session(spark)
    rows = inputs.readings(_timed_events(session, folder))
    found = windows.sensor_averages(rows, "ts", "24 hours", "1 hour", scale=2)
    start = times.utc_wall_clock(F.col("window.start")).alias("window_start")
    _drain_to_files(found.select(start, "avg_temp", "avg_humidity"), path)
    return spark.read.parquet(f"{path}/rows")


_LATE_PARTS = 4


@query(
    "stream_late_rows",
    f"""
WITH s AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')
                     - k * INTERVAL 1 HOUR AS window_start
           FROM ({inputs.READINGS_SQL}) CROSS JOIN range(24) AS shift(k))
SELECT window_start, {AVERAGE.format("temperature")} AS avg_temp,
       {AVERAGE.format("humidity")} AS avg_humidity
FROM s
WHERE window_start + INTERVAL 24 HOUR
      <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND - INTERVAL 23 HOUR
GROUP BY 1""",
)
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Four batches; a third of the rows of the last 20 hours of each comes with the next one,
    behind rows a week later. The query stops after two batches and goes on from its checkpoint.
    No late row is lost: the windows are those of the whole table."""
    path, session = scratch(spark, "stream-late"), stream_session(spark, 4)
    rows = inputs.readings(table(spark, folder, "events"))
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    part = (last - first) / _LATE_PARTS
    late = (F.abs(F.xxhash64("sensor_id", "ts")) % 3 == 0).cast("int") * F.expr("INTERVAL 20 HOURS")
    place = (F.unix_micros(F.col("ts") + late) - F.unix_micros(F.lit(first))) / (part.total_seconds() * 1e6)
    dealt = rows.withColumn("part", F.least(F.floor(place), F.lit(_LATE_PARTS - 1)))

    def arrive(*parts: int) -> None:
        for n in parts:  # one file each, in this order
            some = dealt.filter(F.col("part") == n).drop("part").coalesce(1)
            some.write.mode("append").parquet(f"{path}/in")

    start = times.utc_wall_clock(F.col("window.start")).alias("window_start")
    for parts in ((0, 1), (2, 3)):
        arrive(*parts)
        waiting = stream_folder(session, f"{path}/in", rows.schema, files_per_trigger=1)
        found = windows.sensor_averages(waiting, "ts", "24 hours", "1 hour", scale=2, stream_panes=True)
        _drain_to_files(found.select(start, "avg_temp", "avg_humidity"), path)
    return spark.read.parquet(f"{path}/rows")


@query("stream_window_stats", STATISTICS_SQL)
def stream_window_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Wire trades → normalised messages → update mode; the newest row of each window."""
    path, session = scratch(spark, "stream-stats"), stream_session(spark)
    sent = inputs.wire_messages(_stream(session, folder, "events"))
    normal = messages.encode(trades.normalised(sent))
    found = trades.statistics(
        trades.decoded(normal), length="1 hour", slide="30 minutes", accuracy=10_000, scale=2
    )
    flat = flat_statistics(found, times.utc_wall_clock(F.col("window.start")))
    _drain_to_batches(flat, path, sinks.batch_folders(f"{path}/log"))
    return sinks.latest(sinks.read_log(spark, f"{path}/log"), ["window_start"])


@query(
    "stream_tumbling_complete",
    f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS trade_count,
       {AVERAGE.format("value")} AS avg_price
FROM events GROUP BY 1""",
)
def stream_tumbling_complete(spark: SparkSession, folder: str) -> DataFrame:
    """Complete mode: the last batch holds every window."""
    path, session = scratch(spark, "stream-tumbling"), stream_session(spark)
    found = windows.windowed(
        _timed_events(session, folder),
        "ts",
        "1 hour",
        None,
        F.count("*").alias("trade_count"),
        (
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("value")
        ).alias("avg_price"),
        watermark="1 minute",
    )
    start = times.utc_wall_clock(F.col("window.start")).alias("window_start")
    rows = found.select(start, "trade_count", "avg_price")
    _drain_to_batches(rows, path, sinks.batch_folders(f"{path}/log"), "complete")
    return sinks.latest(sinks.read_log(spark, f"{path}/log"), ["window_start"])


@query("stream_alerts", f"SELECT * FROM ({ALERTS_SQL}) WHERE {CLOSED}")
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor messages → windows → alerts → alert messages, decoded from the sink."""
    path, session = scratch(spark, "stream-alerts"), stream_session(spark)
    events = inputs.readings(_stream(session, folder, "events"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "ts")
    sent = events.select(
        F.to_json(
            F.struct(
                "sensor_id",
                (micros / F.lit(1e6)).cast("string").alias("timestamp"),
                "temperature",
                "humidity",
            )
        ).alias("value")
    )
    found = sensor_alerts.alerts(
        sensor_alerts.readings(sent),
        inputs.few_limits(session, folder),
        length="1 hour",
        slide="30 minutes",
        scale=2,
    )
    _drain_to_files(sensor_alerts.alert_messages(found), path)
    shape = (
        "window struct<start:timestamp,end:timestamp>, avg_temp double, "
        "avg_humidity double, code string, message string"
    )
    alerts = messages.decode(session.read.parquet(f"{path}/rows"), shape)
    start = times.utc_wall_clock(F.col("window.start")).alias("window_start")
    return alerts.select(start, "avg_temp", "avg_humidity", "code", "message")


ENRICHED_SQL = GOLD_SQL.replace(
    "ON r.athlete_id = a.athlete_id)",
    "ON r.athlete_id = a.athlete_id WHERE TRY_CAST(a.height AS FLOAT) IS NOT NULL "
    "AND TRY_CAST(a.weight AS FLOAT) IS NOT NULL)",
)


def _enriched(spark: SparkSession, folder: str, parts: list[list[int]], count: int) -> DataFrame:
    """Results as messages in ``count`` files → stream ⋈ athletes → running averages → message
    log and table log from one computation. The query is started anew for each list of parts
    and takes one file per batch; the newest row of each group comes back."""
    path, session = scratch(spark, "stream-enrich"), stream_session(spark)
    messages_ = enrichment.publishable(inputs.results(session, folder))
    dealt = messages_.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(count)))
    log = f"{path}/table"
    columns = f"{schemas.GROUP_AVERAGE}, batch_id bigint"
    session.createDataFrame([], columns).write.partitionBy("batch_id").parquet(log)

    def there(number: int) -> DataFrame:
        held = session.read.schema(columns).parquet(log)
        return held.filter(F.col("batch_id") == number)

    def append(rows: DataFrame) -> None:
        rows.write.mode("append").partitionBy("batch_id").parquet(log)

    def publish(sent: DataFrame) -> None:
        sent.write.mode("append").parquet(f"{path}/averages")

    for some in parts:
        for part in some:
            rows = dealt.filter(F.col("part") == part).drop("part").coalesce(1)
            rows.write.mode("append").parquet(f"{path}/topic")
        sent = stream_folder(session, f"{path}/topic", schemas.ENVELOPE, files_per_trigger=1)
        averages = enrichment.running_averages(
            sent, inputs.athletes(session, folder), kind="double", scale=2
        )
        out = enrichment.job(averages, f"{path}/checkpoint", publish, there, append, drain=True)
        runner.finish(out.start())
    newest = sinks.latest(sinks.read_log(spark, log), GROUPS)
    return newest.select(*GROUPS, "avg_height", "avg_weight")


@query("stream_enrich", ENRICHED_SQL)
def stream_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """All messages at once."""
    return _enriched(spark, folder, [[0]], 1)


@query("stream_enrich_restart", ENRICHED_SQL)
def stream_enrich_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches with a stop and a restart between them: averages go on from the state."""
    return _enriched(spark, folder, [[0, 1], [2]], 3)


@query(
    "stream_route",
    f"""
SELECT 'topic_' || symbol AS topic, count(*) AS messages
FROM ({inputs.TRADES_SQL}) WHERE symbol IS NOT NULL GROUP BY 1""",
)
def stream_route(spark: SparkSession, folder: str) -> DataFrame:
    """Each message to the folder of its symbol."""
    path, session = scratch(spark, "stream-route"), stream_session(spark)
    rows = trades.normalised(inputs.wire_messages(_stream(session, folder, "events")))
    _drain_to_files(routing.route_by_symbol(rows), path, "topic")
    return (
        spark.read.parquet(f"{path}/rows").groupBy("topic").agg(F.count("*").alias("messages"))
    )


@query(
    "stream_route_map",
    f"""
SELECT d.topic, lower(t.symbol) AS symbol, count(*) AS messages,
       CAST(sum(CAST(t.price AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM ({inputs.TRADES_SQL}) t JOIN ({inputs.DESTINATIONS_SQL}) d ON t.symbol = d.symbol
GROUP BY ALL""",
)
def stream_route_map(spark: SparkSession, folder: str) -> DataFrame:
    """Compact trades of configured symbols to their configured topics."""
    path, session = scratch(spark, "stream-map"), stream_session(spark)
    rows = trades.compact(inputs.wire_messages(_stream(session, folder, "events")))
    routed = routing.route_by_table(rows, inputs.destinations(session, folder))
    _drain_to_files(routed, path, "topic")
    return (
        spark.read.parquet(f"{path}/rows")
        .groupBy("topic", "symbol")
        .agg(
            F.count("*").alias("messages"),
            F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total_price"),
        )
    )


@query("stream_read_back", GOLD_SQL)
def stream_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Averages from a topic whose text was encoded twice, drained once."""
    path, session = scratch(spark, "stream-back"), stream_session(spark)
    averages = medallion.gold(
        inputs.results(session, folder), inputs.athletes(session, folder), scale=2
    )
    once = messages.encode(averages.withColumnRenamed("timestamp", "calculation_time"))
    quoted = F.replace("value", F.lit('"'), F.lit('\\"'))
    twice = F.concat(F.lit('"'), quoted, F.lit('"'))
    once.select("key", twice.alias("value")).write.parquet(f"{path}/topic")
    rows = enrichment.read_back(stream_folder(session, f"{path}/topic", schemas.ENVELOPE))
    _drain_to_files(rows.drop("calculation_time"), path)
    return spark.read.parquet(f"{path}/rows")


# --- whole jobs -------------------------------------------------------------------------

_MINUTES = """
SELECT *, time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '1970-01-01')
          - k * INTERVAL 30 SECOND AS window_start
FROM ({rows}) CROSS JOIN (VALUES (0), (1)) AS shift(k)"""


@query(
    "stream_alert_job",
    f"""
SELECT w.window_start, round(w.avg_temp, 6) AS avg_temp, l.code, l.message, 36 AS key_chars
FROM (SELECT window_start, avg(temperature) AS avg_temp, avg(humidity) AS avg_humidity
      FROM ({_MINUTES.format(rows=inputs.READINGS_SQL)}) GROUP BY 1) w
JOIN ({inputs.FEW_LIMITS_SQL}) l
  ON (w.avg_temp > l.temperature_min AND w.avg_temp < l.temperature_max)
  OR (w.avg_humidity > l.humidity_min AND w.avg_humidity < l.humidity_max)
WHERE w.window_start + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND""",
)
def stream_alert_job(spark: SparkSession, folder: str) -> DataFrame:
    """The alert job as it is shipped, its bus being a folder."""
    path, session = scratch(spark, "alert-job"), stream_session(spark)
    events = inputs.readings(_stream(session, folder, "events"))
    sent = events.select(
        F.to_json(
            F.struct(
                "sensor_id",
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
                "temperature",
                "humidity",
            )
        ).alias("value")
    )
    (query_,) = sensor_alerts.job(
        sent,
        inputs.few_limits(session, folder),
        f"{path}/checkpoint",
        lambda out: runner.to_files(out, f"{path}/bus"),
        drain=True,
    )
    runner.finish(query_.start())
    held = session.read.parquet(f"{path}/bus")
    shape = "window struct<start:timestamp,end:timestamp>, avg_temp double, code string, message string"
    alerts = held.select(F.length("key").alias("key_chars"), F.from_json("value", shape).alias("m"))
    return alerts.select(
        times.utc_wall_clock(F.col("m.window.start")).alias("window_start"),
        F.round("m.avg_temp", 6).alias("avg_temp"), "m.code", "m.message", "key_chars",
    )


@query(
    "stream_routing_job",
    f"""
SELECT 'topic_' || symbol AS topic, count(*) AS messages, sum(trade_id) AS ids,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM ({inputs.TRADES_SQL}) WHERE symbol IS NOT NULL GROUP BY 1""",
)
def stream_routing_job(spark: SparkSession, folder: str) -> DataFrame:
    """The routing job as it is shipped, its bus being a folder per topic."""
    path, session = scratch(spark, "routing-job"), stream_session(spark)
    sent = inputs.wire_messages(_stream(session, folder, "events"))
    out = trades.routing_job(
        sent, f"{path}/checkpoint", lambda w: runner.to_files(w, f"{path}/bus", "topic"), drain=True
    )
    runner.finish(out.start())
    held = session.read.parquet(f"{path}/bus")
    back = held.select("topic", F.from_json("value", schemas.TRADE).alias("t"))
    return back.groupBy("topic").agg(
        F.count("*").alias("messages"),
        F.sum("t.trade_id").cast("decimal(38,0)").alias("ids"),
        F.sum(F.col("t.price").cast("decimal(18,2)")).cast("double").alias("total_price"),
    )


@query(
    "stream_statistics_job",
    f"""
SELECT window_start, min(price) AS min_price, max(price) AS max_price, count(*) AS trade_count,
       round(sum(quantity), 6) AS total_volume, quantile_disc(price, 0.5) AS p50
FROM ({_MINUTES.format(rows=f"SELECT *, make_timestamp_ms(trade_time) AS ts FROM ({inputs.TRADES_SQL})")})
GROUP BY 1""",
)
def stream_statistics_job(spark: SparkSession, folder: str) -> DataFrame:
    """The statistics job as it is shipped; the newest message of each window."""
    path, session = scratch(spark, "statistics-job"), stream_session(spark)
    normal = messages.encode(trades.normalised(inputs.wire_messages(_stream(session, folder, "events"))))
    (query_,) = trades.statistics_job(
        normal,
        f"{path}/checkpoint",
        lambda out: runner.to_batches(out, sinks.batch_folders(f"{path}/bus")),
        drain=True,
    )
    runner.finish(query_.start())
    shape = (
        "window struct<start:timestamp,end:timestamp>, min_price double, max_price double, "
        "trade_count bigint, total_volume double, price_percentiles array<double>"
    )
    held = sinks.read_log(spark, f"{path}/bus")
    rows = held.select("batch_id", F.from_json("value", shape).alias("m")).select("batch_id", "m.*")
    start = times.utc_wall_clock(F.col("window.start")).alias("window_start")
    flat = rows.select(
        "batch_id", start, "min_price", "max_price", "trade_count",
        F.round("total_volume", 6).alias("total_volume"), F.col("price_percentiles")[1].alias("p50"),
    )
    return sinks.latest(flat, ["window_start"])
