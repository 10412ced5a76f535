"""Queries on tables."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks import inputs
from tidemark.checks.registry import dates_as_text, query, table
from tidemark.functions import messages, times
from tidemark.functions.numbers import mean, number
from tidemark.operators import cleaning, ranges, report, routing, windows
from tidemark.plans import enrichment, medal_report, medallion, sensor_alerts, trades
from tidemark.session import scratch, stream_session
from tidemark.sources import files

AVERAGE = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE) / count({0})"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


# --- averages over a join ---------------------------------------------------------------

GOLD_SQL = f"""
WITH a AS ({inputs.ATHLETES_SQL}), r AS ({inputs.RESULTS_SQL}),
j AS (SELECT r.sport, r.medal, a.sex, r.country_noc,
             TRY_CAST(a.height AS DOUBLE) AS height, TRY_CAST(a.weight AS DOUBLE) AS weight
      FROM r JOIN a ON r.athlete_id = a.athlete_id)
SELECT sport, medal, sex, country_noc, {AVERAGE.format("height")} AS avg_height,
       {AVERAGE.format("weight")} AS avg_weight
FROM j GROUP BY ALL"""


@query("gold_avg_stats", GOLD_SQL)
def gold_avg_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = medallion.gold(
        inputs.results(spark, folder), inputs.athletes(spark, folder), scale=2
    )
    return rows.drop("timestamp")


@query(
    "medallion_end_to_end",
    f"""
WITH a AS (SELECT DISTINCT athlete_id, lower(sex) AS sex, lower(height) AS height,
                  lower(weight) AS weight FROM ({inputs.ATHLETES_SQL})),
r AS (SELECT DISTINCT athlete_id, result_id, lower(sport) AS sport, lower(medal) AS medal,
             lower(country_noc) AS country_noc FROM ({inputs.RESULTS_SQL})),
j AS (SELECT r.sport, r.medal, a.sex, r.country_noc,
             TRY_CAST(a.height AS DOUBLE) AS height, TRY_CAST(a.weight AS DOUBLE) AS weight
      FROM r JOIN a ON r.athlete_id = a.athlete_id)
SELECT sport, medal, sex, country_noc, {AVERAGE.format("height")} AS avg_height,
       {AVERAGE.format("weight")} AS avg_weight
FROM j GROUP BY ALL""",
)
def medallion_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    """Landed CSV files through bronze and silver to gold."""
    lake = scratch(spark, "lake")
    landing = {"athlete_bio": inputs.athletes, "athlete_event_results": inputs.results}
    for name, rows in landing.items():
        rows(spark, folder).write.option("header", True).csv(f"{lake}/landing/{name}")
    paths = {name: f"{lake}/landing/{name}" for name in landing}
    ddl = {
        "athlete_bio": schemas.ATHLETE_BIO,
        "athlete_event_results": schemas.EVENT_RESULT,
    }
    return medallion.run(spark, paths, lake, ddl, scale=2).drop("timestamp")


@query(
    "enriched_running_averages",
    f"""
WITH a AS ({inputs.ATHLETES_SQL}), r AS ({inputs.RESULTS_SQL}),
j AS (SELECT r.sport, r.medal, a.sex, r.country_noc,
             CAST(a.height AS DOUBLE) AS height, CAST(a.weight AS DOUBLE) AS weight
      FROM r JOIN a ON r.athlete_id = a.athlete_id
      WHERE TRY_CAST(a.height AS FLOAT) IS NOT NULL AND TRY_CAST(a.weight AS FLOAT) IS NOT NULL)
SELECT sport, medal, sex, country_noc, {AVERAGE.format("height")} AS avg_height,
       {AVERAGE.format("weight")} AS avg_weight
FROM j GROUP BY ALL""",
)
def enriched_running_averages(spark: SparkSession, folder: str) -> DataFrame:
    """Table → messages → rows → enriched averages, as one batch."""
    sent = enrichment.publishable(inputs.results(spark, folder))
    rows = enrichment.running_averages(
        sent, inputs.athletes(spark, folder), kind="double", scale=2
    )
    return rows.drop("calculation_time")


def _rounded(rows: DataFrame) -> DataFrame:
    averages = {c: F.round(F.col(c) + 1e-9, 6) for c in ("avg_height", "avg_weight")}
    return rows.withColumns(averages)


# The small addend keeps both engines off ties.
_ROUNDED = "round(avg_height + 1e-9, 6) AS avg_height, round(avg_weight + 1e-9, 6) AS avg_weight"


@query("gold_avg_default", f"SELECT sport, medal, sex, country_noc, {_ROUNDED} FROM ({GOLD_SQL})")
def gold_avg_default(spark: SparkSession, folder: str) -> DataFrame:
    """The averages as they are by default, of doubles."""
    rows = medallion.gold(inputs.results(spark, folder), inputs.athletes(spark, folder))
    return _rounded(rows.drop("timestamp"))


@query(
    "running_averages_default",
    f"""
WITH a AS ({inputs.ATHLETES_SQL}), r AS ({inputs.RESULTS_SQL}),
j AS (SELECT r.sport, r.medal, a.sex, r.country_noc,
             CAST(a.height AS DOUBLE) AS height, CAST(a.weight AS DOUBLE) AS weight
      FROM r JOIN a ON r.athlete_id = a.athlete_id
      WHERE TRY_CAST(a.height AS FLOAT) IS NOT NULL AND TRY_CAST(a.weight AS FLOAT) IS NOT NULL)
SELECT sport, medal, sex, country_noc, round(avg(height) + 1e-9, 6) AS avg_height,
       round(avg(weight) + 1e-9, 6) AS avg_weight
FROM j GROUP BY ALL""",
)
def running_averages_default(spark: SparkSession, folder: str) -> DataFrame:
    sent = enrichment.publishable(inputs.results(spark, folder))
    rows = enrichment.running_averages(sent, inputs.athletes(spark, folder), kind="double")
    return _rounded(rows.drop("calculation_time"))


# --- files ------------------------------------------------------------------------------


@query("landing_inferred", "SELECT * FROM supplier")
def landing_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """CSV → bronze with inferred types, written and read back."""
    path = scratch(spark, "landing")
    table(spark, folder, "supplier").write.option("header", True).csv(f"{path}/csv")
    bronze = medallion.to_bronze(spark, f"{path}/csv", f"{path}/bronze")
    return bronze.withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


@query(
    "csv_customers",
    f"""
SELECT customer_id, full_name, email, phone, city, coalesce(address, '') AS address, status,
       CAST(sign_up_date AS VARCHAR) AS sign_up_date, age, subscription_type
FROM ({inputs.FIRST_SQL})""",
)
def csv_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A customer snapshot through CSV: an empty cell comes back as an empty text."""
    path = scratch(spark, "customers")
    inputs.first_day(spark, folder).write.option("header", True).csv(path)
    rows = files.read_customers(spark, path)
    return dates_as_text(rows.withColumn("customer_id", F.col("customer_id").cast("bigint")))


@query("csv_limits", f"SELECT * FROM ({inputs.MANY_LIMITS_SQL})")
def csv_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Alert limits through CSV: text on arrival, blank limits as null."""
    path = scratch(spark, "limits")
    inputs.many_limits(spark, folder).write.option("header", True).csv(path)
    return files.read_limits(spark, path)


# --- cleaning ---------------------------------------------------------------------------


@query(
    "silver_clean_distinct",
    """
SELECT DISTINCT trim(lower('  ' || upper(p_name) || ' ')) AS p_name,
       trim(lower(p_brand)) AS p_brand, trim(lower(p_type)) AS p_type,
       CASE WHEN p_size > 25 THEN NULL ELSE trim(lower('Small ')) END AS note
FROM part""",
)
def silver_clean_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return medallion.silver(
        table(spark, folder, "part").selectExpr(
            "'  ' || upper(p_name) || ' ' AS p_name",
            "p_brand",
            "p_type",
            "CASE WHEN p_size > 25 THEN NULL ELSE 'Small ' END AS note",
        )
    )


@query(
    "silver_clean_documents",
    """
SELECT DISTINCT trim(lower(text), ' ') AS text, trim(lower(lang), ' ') AS lang,
       trim(lower(source), ' ') AS source, n_chars
FROM documents""",
)
def silver_clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts, cleaned; copies from one source collapse."""
    return medallion.silver(
        table(spark, folder, "documents").select("text", "lang", "source", "n_chars")
    )


@query(
    "valid_numeric",
    f"""
SELECT athlete_id, CAST(height AS DOUBLE) AS height, CAST(weight AS DOUBLE) AS weight
FROM ({inputs.ATHLETES_SQL})
WHERE TRY_CAST(height AS FLOAT) IS NOT NULL AND TRY_CAST(weight AS FLOAT) IS NOT NULL""",
)
def valid_numeric(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaning.keep_numeric(inputs.athletes(spark, folder), "height", "weight")
    return rows.select(
        "athlete_id",
        number(F.col("height")).alias("height"),
        number(F.col("weight")).alias("weight"),
    )


@query(
    "threshold_filter",
    f"""
SELECT sensor_id, ts, temperature, humidity FROM ({inputs.READINGS_SQL})
WHERE temperature > 40 OR humidity < 20 OR humidity > 80""",
)
def threshold_filter(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.out_of_range(inputs.readings(_events(spark, folder)))


# --- messages and times -----------------------------------------------------------------


@query(
    "json_decode",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)
def json_decode(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder).select(F.col("event_id").cast("string").alias("key"), F.col("props").alias("value"))
    found = messages.decode_keyed(rows, "k int")
    return found.select(F.col("key").cast("bigint").alias("event_id"), "k")


@query(
    "json_decode_tolerant",
    """
SELECT CASE WHEN event_type IN ('error', 'view') THEN 'none'
            ELSE CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN event_type IN ('click', 'error', 'view') THEN 'none'
            ELSE json_extract_string(props, '$.k') END AS k
FROM events""",
)
def json_decode_tolerant(spark: SparkSession, folder: str) -> DataFrame:
    """A wrong field, text that is no JSON and a null message become nulls."""
    good = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(',"k":'))
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    value = (
        F.when(kind == "click", F.concat(good, F.lit('"many"}')))
        .when(kind == "error", F.lit("no json"))
        .when(kind == "view", F.lit(None))
        .otherwise(F.concat(good, k, F.lit("}")))
    )
    rows = messages.decode(_events(spark, folder).select(value.alias("value")), "id bigint, k int")
    return rows.select(
        F.coalesce(F.col("id").cast("string"), F.lit("none")).alias("event_id"),
        F.coalesce(F.col("k").cast("string"), F.lit("none")).alias("k"),
    )


@query(
    "json_encode",
    f"""
SELECT CAST(result_id AS VARCHAR) AS key,
  '{{"edition":"' || edition || '","edition_id":' || edition_id
  || ',"country_noc":"' || country_noc || '","sport":"' || sport || '","event":"' || event
  || '","result_id":' || result_id || ',"athlete":"' || athlete || '","athlete_id":'
  || athlete_id || ',"pos":"' || pos || '"'
  || CASE WHEN medal IS NULL THEN '' ELSE ',"medal":"' || medal || '"' END
  || ',"isTeamSport":"' || "isTeamSport" || '"}}' AS value
FROM ({inputs.RESULTS_SQL})""",
)
def json_encode(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.publishable(inputs.results(spark, folder))


@query(
    "json_encode_window",
    """
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, min(value) AS lo,
                  max(value) AS hi, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(n AS VARCHAR) AS key,
  '{"window":{"start":"' || strftime(s, '%Y-%m-%dT%H:%M:%S.000') || '","end":"'
  || strftime(s + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.000') || '"},"min_price":'
  || CAST(lo AS VARCHAR) || ',"max_price":' || CAST(hi AS VARCHAR)
  || ',"trade_count":' || n || '}' AS value
FROM w""",
)
def json_encode_window(spark: SparkSession, folder: str) -> DataFrame:
    stats = windows.windowed(
        _events(spark, folder),
        "ts",
        "1 hour",
        None,
        F.min("value").alias("min_price"),
        F.max("value").alias("max_price"),
        F.count("*").alias("trade_count"),
    )
    fields = ["window", "min_price", "max_price", "trade_count"]
    return messages.encode(stats, F.col("trade_count"), fields)


@query(
    "json_unescape",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS stripped,
       CAST(json_extract_string(props, '$.k') AS INT) AS inner_value
FROM events""",
)
def json_unescape(spark: SparkSession, folder: str) -> DataFrame:
    """Messages encoded twice, undone both ways."""
    twice = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('\\"')), F.lit('"'))
    rows = _events(spark, folder).select("event_id", twice.alias("value"))
    rows = rows.select(
        "event_id",
        F.from_json(messages.strip_escapes(F.col("value")), "k int").alias("a"),
        F.from_json(messages.inner_json(F.col("value")), "k int").alias("b"),
    )
    return rows.select("event_id", F.col("a.k").alias("stripped"), F.col("b.k").alias("inner_value"))


@query("epoch_millis", "SELECT event_id, date_trunc('millisecond', ts) AS at FROM events")
def epoch_millis(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder).select("event_id", inputs.epoch_millis().alias("ms"))
    at = times.utc_wall_clock(times.from_epoch_millis(F.col("ms")))
    return rows.select("event_id", at.alias("at"))


@query(
    "parse_timestamp",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                      WHEN event_type = 'click' THEN date_trunc('millisecond', ts)
                      ELSE date_trunc('second', ts) END AS at
FROM events""",
)
def parse_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """Pattern text, epoch seconds with a fraction, and text that is no time."""
    rows = _events(stream_session(spark), folder)
    text = (
        F.when(F.col("event_type") == "error", F.lit("yesterday"))
        .when(
            F.col("event_type") == "click",
            (inputs.epoch_millis() / F.lit(1000.0)).cast("string"),
        )
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    at = times.utc_wall_clock(times.event_time(F.col("text")))
    return rows.select("event_id", text.alias("text")).select("event_id", at.alias("at"))


@query(
    "random_keys",
    """
SELECT o_orderstatus AS status, count(*) AS messages, count(*) AS keys, 36 AS key_chars
FROM orders GROUP BY 1""",
)
def random_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Messages under random keys, all of them different."""
    sent = messages.encode(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"))
    held = messages.decode_keyed(sent, "o_orderstatus string")
    return held.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("messages"),
        F.count_distinct("key").alias("keys"),
        F.max(F.length("key")).alias("key_chars"),
    )


@query(
    "load_time",
    "SELECT DISTINCT o_custkey AS customer_id, TIMESTAMP '2024-06-01 12:00:00' AS load_time, "
    "true AS stamped_now FROM orders",
)
def load_time(spark: SparkSession, folder: str) -> DataFrame:
    """A given load time, and whether the one taken by default lies in this run."""
    begin = F.lit(dt.datetime.now() - dt.timedelta(minutes=5))
    keys = table(spark, folder, "orders").select(F.col("o_custkey").alias("customer_id")).distinct()
    now = times.stamp()
    return keys.select(
        "customer_id",
        times.utc_wall_clock(times.stamp(F.lit("2024-06-01T12:00:00Z").cast("timestamp"))).alias("load_time"),
        ((now > begin) & (now < begin + F.expr("INTERVAL 1 DAY"))).alias("stamped_now"),
    )


# --- trades -----------------------------------------------------------------------------


@query(
    "trade_normalise",
    f"""
SELECT event_type, event_time, coalesce(symbol, 'none') AS symbol, trade_id, price, quantity,
       trade_time, buyer_market_maker, "ignore" FROM ({inputs.TRADES_SQL})""",
)
def trade_normalise(spark: SparkSession, folder: str) -> DataFrame:
    rows = trades.normalised(inputs.wire_messages(_events(spark, folder)))
    return rows.withColumn("symbol", F.coalesce("symbol", F.lit("none")))


@query(
    "trade_compact",
    f"""
SELECT lower(symbol) AS symbol, price, quantity, trade_time AS timestamp
FROM ({inputs.TRADES_SQL})
WHERE symbol IN (SELECT symbol FROM ({inputs.DESTINATIONS_SQL}))""",
)
def trade_compact(spark: SparkSession, folder: str) -> DataFrame:
    sent = inputs.wire_messages(_events(spark, folder))
    rows = trades.compact(sent, inputs.destinations(spark, folder))
    return rows.drop("processing_timestamp")


@query(
    "route_counts",
    f"""
SELECT 'topic_' || symbol AS topic, count(*) AS messages
FROM ({inputs.TRADES_SQL}) WHERE symbol IS NOT NULL GROUP BY 1""",
)
def route_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = trades.normalised(inputs.wire_messages(_events(spark, folder)))
    routed = routing.route_by_symbol(rows)
    return routed.groupBy("topic").agg(F.count("*").alias("messages"))


@query(
    "route_by_map",
    f"""
SELECT t.trade_id, lower(t.symbol) AS symbol, d.topic
FROM ({inputs.TRADES_SQL}) t JOIN ({inputs.DESTINATIONS_SQL}) d ON t.symbol = d.symbol""",
)
def route_by_map(spark: SparkSession, folder: str) -> DataFrame:
    rows = trades.normalised(inputs.wire_messages(_events(spark, folder)))
    routed = routing.route_by_table(rows, inputs.destinations(spark, folder))
    return routed.select("trade_id", "symbol", "topic")


# --- windows ----------------------------------------------------------------------------

# Starts of the two one-hour windows, half an hour apart, that hold a time.
SLIDING_SQL = """
SELECT *, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01')
          - k * INTERVAL 30 MINUTE AS window_start
FROM ({rows}) CROSS JOIN (VALUES (0), (1)) AS shift(k)"""


def _with_bounds(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *columns,
    )


@query(
    "window_sliding",
    f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
       {AVERAGE.format("temperature")} AS avg_temp, {AVERAGE.format("humidity")} AS avg_humidity
FROM ({SLIDING_SQL.format(rows=inputs.READINGS_SQL)}) GROUP BY 1, 2""",
)
def window_sliding(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.readings(_events(spark, folder))
    found = windows.sensor_averages(rows, "ts", "1 hour", "30 minutes", scale=2)
    return _with_bounds(found, "avg_temp", "avg_humidity")


@query(
    "window_many_slides",
    f"""
WITH s AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')
                     - k * INTERVAL 1 HOUR AS window_start
           FROM ({inputs.READINGS_SQL}) CROSS JOIN range(24) AS shift(k))
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end,
       {AVERAGE.format("temperature")} AS avg_temp, {AVERAGE.format("humidity")} AS avg_humidity
FROM s GROUP BY 1, 2""",
)
def window_many_slides(spark: SparkSession, folder: str) -> DataFrame:
    """Day-long windows every hour, from hourly panes."""
    rows = inputs.readings(_events(spark, folder))
    found = windows.sensor_averages(rows, "ts", "24 hours", "1 hour", scale=2)
    return _with_bounds(found, "avg_temp", "avg_humidity")


@query(
    "window_tumbling",
    f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS trade_count, {AVERAGE.format("value")} AS avg_price
FROM events GROUP BY 1, 2""",
)
def window_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    found = windows.windowed(
        _events(spark, folder),
        "ts",
        "1 hour",
        None,
        F.count("*").alias("trade_count"),
        mean(F.col("value"), 2).alias("avg_price"),
    )
    return _with_bounds(found, "trade_count", "avg_price")


STATISTICS_SQL = f"""
SELECT window_start, {AVERAGE.format("price")} AS avg_price, min(price) AS min_price,
       max(price) AS max_price, round(stddev_samp(price), 6) AS price_stddev,
       count(*) AS trade_count, {AVERAGE.format("quantity")} AS avg_quantity,
       CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_volume,
       quantile_disc(price, 0.25) AS p25, quantile_disc(price, 0.5) AS p50,
       quantile_disc(price, 0.75) AS p75
FROM ({SLIDING_SQL.format(rows=f"SELECT *, make_timestamp_ms(trade_time) AS ts FROM ({inputs.TRADES_SQL})")})
GROUP BY 1"""


def flat_statistics(found: DataFrame, start) -> DataFrame:
    return found.select(
        start.alias("window_start"),
        "avg_price",
        "min_price",
        "max_price",
        F.round("price_stddev", 6).alias("price_stddev"),
        "trade_count",
        "avg_quantity",
        "total_volume",
        *(F.col("price_percentiles")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))),
    )


@query("window_stats", STATISTICS_SQL)
def window_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Wire trades → event time → all statistics per sliding window."""
    rows = trades.normalised(inputs.wire_messages(_events(spark, folder)))
    at = times.utc_wall_clock(times.from_epoch_millis(F.col("trade_time")))
    found = trades.statistics(
        rows.withColumn("trade_time", at),
        length="1 hour",
        slide="30 minutes",
        accuracy=10_000,
        scale=2,
    )
    return flat_statistics(found, F.col("window.start"))


_DAY_WINDOWS = f"""
SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 1 HOUR AS window_start
FROM (SELECT *, make_timestamp_ms(trade_time) AS ts FROM ({inputs.TRADES_SQL})) CROSS JOIN range(24) AS shift(k)"""


@query(
    "window_stats_many_slides",
    f"""
SELECT window_start, {AVERAGE.format("price")} AS avg_price, min(price) AS min_price,
       max(price) AS max_price, round(stddev_samp(price), 6) AS price_stddev,
       count(*) AS trade_count, {AVERAGE.format("quantity")} AS avg_quantity,
       CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_volume, 3 AS quartiles
FROM ({_DAY_WINDOWS}) GROUP BY 1""",
)
def window_stats_many_slides(spark: SparkSession, folder: str) -> DataFrame:
    """Day-long windows every hour from hourly panes; how far the quartiles are off is a test."""
    rows = trades.normalised(inputs.wire_messages(_events(spark, folder)))
    at = times.utc_wall_clock(times.from_epoch_millis(F.col("trade_time")))
    found = trades.statistics(
        rows.withColumn("trade_time", at), length="24 hours", slide="1 hour", scale=2, panes=True
    )
    exact = ("avg_price", "min_price", "max_price", "trade_count", "avg_quantity", "total_volume")
    return found.select(
        F.col("window.start").alias("window_start"),
        *exact,
        F.round("price_stddev", 6).alias("price_stddev"),
        F.size("price_percentiles").alias("quartiles"),
    )


@query(
    "compact_trade_stats",
    f"""
SELECT window_start, {AVERAGE.format("price")} AS avg_price, min(price) AS min_price,
       max(price) AS max_price, round(stddev_samp(price), 6) AS price_stddev,
       count(*) AS trade_count, {AVERAGE.format("quantity")} AS avg_quantity,
       CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_volume,
       quantile_disc(price, 0.25) AS p25, quantile_disc(price, 0.5) AS p50,
       quantile_disc(price, 0.75) AS p75
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, make_timestamp_ms(trade_time)) AS window_start
      FROM ({inputs.TRADES_SQL}) WHERE symbol IN (SELECT symbol FROM ({inputs.DESTINATIONS_SQL})))
GROUP BY 1""",
)
def compact_trade_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Wire trades → compact messages of listed symbols → statistics per hour."""
    sent = inputs.wire_messages(_events(spark, folder))
    short = messages.encode(trades.compact(sent, inputs.destinations(spark, folder)))
    found = trades.compact_statistics(short, "1 hour", accuracy=10_000, scale=2)
    return flat_statistics(found, times.utc_wall_clock(F.col("window.start")))


@query(
    "percentiles",
    """
SELECT event_type, quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS p50,
       quantile_disc(value, 0.75) AS p75 FROM events GROUP BY 1""",
)
def percentiles(spark: SparkSession, folder: str) -> DataFrame:
    stats = windows.trade_statistics("value", "user_id", accuracy=1_000_000)
    wanted = [c for c in stats if "price_percentiles" in str(c)]
    rows = _events(spark, folder).groupBy("event_type").agg(*wanted)
    names = ("p25", "p50", "p75")
    return rows.select(
        "event_type", *(F.col("price_percentiles")[i].alias(n) for i, n in enumerate(names))
    )


@query(
    "percentiles_shipped",
    """
SELECT event_type, true AS p25, true AS p50, true AS p75, true AS q25, true AS q50, true AS q75
FROM events GROUP BY 1""",
)
def percentiles_shipped(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the quartiles at the shipped accuracy, of rows and of merged panes, have ranks
    within their stated error."""
    events = _events(spark, folder).withColumn("quantity", F.lit(1))
    rows = events.groupBy("event_type").agg(*windows.trade_statistics("value", "quantity"))
    rows = rows.select("event_type", F.col("price_percentiles").alias("p"))
    panes = windows.pane_statistics(
        events.withColumn("price", F.col("value")), "ts", "36500 days", "7300 days"
    )
    q = panes.orderBy("window").first()["price_percentiles"]  # the window of all events
    value, shares = F.col("value"), (0.25, 0.5, 0.75)

    def within(share: float, at: Column, error: float) -> Column:
        below, upto = (F.avg(hit.cast("double")) for hit in (value < at, value <= at))
        off = F.lit(error) + 1 / F.count(value)  # a rank is a whole number of rows
        return (below <= share + off) & (upto >= share - off)

    slack = windows.SKETCH_RANK_ERROR
    every = events.agg(
        *(within(s, F.lit(q[i]), slack).alias(f"q{int(100 * s)}") for i, s in enumerate(shares))
    ).first()
    by_type = events.join(F.broadcast(rows), "event_type").groupBy("event_type").agg(
        *(within(s, F.col("p")[i], 0.01).alias(f"p{int(100 * s)}") for i, s in enumerate(shares))
    )
    return by_type.withColumns({name: F.lit(every[name]) for name in ("q25", "q50", "q75")})


@query(
    "stddev_by_type",
    """
SELECT event_type, round(stddev_samp(value), 6) AS price_stddev, min(value) AS min_price,
       max(value) AS max_price, CAST(sum(user_id) AS DOUBLE) AS total_volume
FROM events GROUP BY 1""",
)
def stddev_by_type(spark: SparkSession, folder: str) -> DataFrame:
    stats = windows.trade_statistics("value", "user_id", scale=2)
    rows = _events(spark, folder).groupBy("event_type").agg(*stats)
    return rows.select(
        "event_type",
        F.round("price_stddev", 6).alias("price_stddev"),
        "min_price",
        "max_price",
        "total_volume",
    )


# --- alerts -----------------------------------------------------------------------------

ALERTS_SQL = f"""
SELECT w.window_start, w.avg_temp, w.avg_humidity, l.code, l.message
FROM (SELECT window_start, {AVERAGE.format("temperature")} AS avg_temp,
             {AVERAGE.format("humidity")} AS avg_humidity
      FROM ({SLIDING_SQL.format(rows=inputs.READINGS_SQL)}) GROUP BY 1) w
JOIN ({inputs.FEW_LIMITS_SQL}) l
  ON (w.avg_temp > l.temperature_min AND w.avg_temp < l.temperature_max)
  OR (w.avg_humidity > l.humidity_min AND w.avg_humidity < l.humidity_max)"""


@query("alerts_range_join", ALERTS_SQL)
def alerts_range_join(spark: SparkSession, folder: str) -> DataFrame:
    found = sensor_alerts.alerts(
        inputs.readings(_events(spark, folder)),
        inputs.few_limits(spark, folder),
        "ts",
        "1 hour",
        "30 minutes",
        scale=2,
    )
    return found.select(
        F.col("window.start").alias("window_start"), "avg_temp", "avg_humidity", "code", "message"
    )


@query(
    "alerts_many_rules",
    f"""
SELECT l.code, count(*) AS alerts, min(e.sensor_id) AS first_sensor,
       max(e.temperature) AS max_temp
FROM ({inputs.READINGS_SQL}) e JOIN ({inputs.MANY_LIMITS_SQL}) l
  ON (e.temperature > l.temperature_min AND e.temperature < l.temperature_max)
  OR (e.humidity > l.humidity_min AND e.humidity < l.humidity_max)
GROUP BY 1""",
)
def alerts_many_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every reading against a long rule table, summed up per rule."""
    halves = (
        ranges.Bounds("temperature", "temperature_min", "temperature_max"),
        ranges.Bounds("humidity", "humidity_min", "humidity_max"),
    )
    return ranges.match_rules(
        inputs.readings(_events(spark, folder)),
        inputs.many_limits(spark, folder),
        halves,
        totals=ranges.Totals(
            "code", "alerts", {"first_sensor": "sensor_id"}, {"max_temp": "temperature"}
        ),
    )


# --- report -----------------------------------------------------------------------------

REPORT_TIME = dt.datetime(2024, 6, 1, 12, 0, 0)


@query(
    "count_by_value",
    "SELECT o_orderstatus AS value, count(*) AS count FROM orders "
    "WHERE o_orderstatus IN ('F', 'O') GROUP BY 1",
)
def count_by_value(spark: SparkSession, folder: str) -> DataFrame:
    return report.count_by_value(table(spark, folder, "orders"), "o_orderstatus", ("F", "O"))


@query(
    "report_log",
    """
WITH c AS (SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1)
SELECT CASE value WHEN 'O' THEN 8 WHEN 'F' THEN 9 ELSE 10 END::BIGINT AS id, value,
       n AS count, TIMESTAMP '2024-06-01 12:00:00' AS created_at FROM c""",
)
def report_log(spark: SparkSession, folder: str) -> DataFrame:
    values = ("O", "F", "P")
    counts = report.count_by_value(table(spark, folder, "orders"), "o_orderstatus", values)
    return report.log_rows(counts, REPORT_TIME, values, last_id=7)


@query(
    "report_table",
    """
WITH c AS (SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1)
SELECT CASE value WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END::BIGINT + 3 * run AS id, value,
       n AS count, TIMESTAMP '2024-06-01 12:00:00' + run * INTERVAL 1 DAY AS created_at
FROM c CROSS JOIN (VALUES (0), (1)) AS runs(run)""",
)
def report_table(spark: SparkSession, folder: str) -> DataFrame:
    """Create if absent, append on two days; the repeated second run adds nothing."""
    path = scratch(spark, "report")
    name = f"report_{os.path.basename(path).rpartition('-')[2]}"
    orders = table(spark, folder, "orders")
    for day in (0, 1, 1):
        medal_report.create_log(spark, name, path)
        medal_report.append_counts(
            spark, name, orders, "o_orderstatus",
            REPORT_TIME + dt.timedelta(days=day), ("O", "F", "P"),
        )
    rows = spark.read.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return rows


@query(
    "latest_row_fresh",
    """
SELECT event_id, ts, epoch_us(TIMESTAMP '2024-01-30 23:57:42') - epoch_us(ts) < 30000000 AS fresh
FROM events ORDER BY event_id DESC LIMIT 1""",
)
def latest_row_fresh(spark: SparkSession, folder: str) -> DataFrame:
    """The newest event, and whether it was fresh at a given time."""
    at = dt.datetime(2024, 1, 30, 23, 57, 42)
    log = _events(spark, folder).select("event_id", "ts")
    return report.freshness(log, at, by="event_id", time="ts")
