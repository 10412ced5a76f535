"""The driver's tables in the shape of the jobs' inputs.

Each input is a list of SQL expressions that Spark and the checking SQL both read, so the
two sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks.registry import table


def _select(columns: dict[str, str], source: str, where: str = "") -> str:
    body = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return f"SELECT {body} FROM {source}" + (f" WHERE {where}" if where else "")


def _frame(rows: DataFrame, columns: dict[str, str], where: str = "") -> DataFrame:
    rows = rows.filter(where) if where else rows
    return rows.selectExpr(*(f"{text} AS {name}" for name, text in columns.items()))


# Athletes and results ------------------------------------------------------------------

_ATHLETE = {
    "athlete_id": "c_custkey",
    "sex": "c_mktsegment",
    "height": "CASE WHEN c_nationkey = 3 THEN '176-180' WHEN c_nationkey = 4 THEN NULL "
    "ELSE CAST(c_acctbal AS STRING) END",
    "weight": "CASE WHEN c_nationkey = 5 THEN 'n/a' "
    "ELSE CAST(c_nationkey AS STRING) || '.5' END",
    "country_noc": "'N' || CAST(c_nationkey AS STRING)",
}
_RESULT = {
    "edition": "'Games ' || CAST(year(o_orderdate) AS STRING)",
    "edition_id": "CAST(year(o_orderdate) AS INT)",
    "country_noc": "'Y' || CAST(year(o_orderdate) AS STRING)",
    "sport": "o_orderpriority",
    "event": "o_orderpriority || ' final'",
    "result_id": "o_orderkey",
    "athlete": "'athlete ' || CAST(o_custkey AS STRING)",
    "athlete_id": "CAST(o_custkey AS INT)",
    "pos": "CAST(o_orderkey % 8 + 1 AS STRING)",
    "medal": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END",
    "isTeamSport": "CASE WHEN o_totalprice > 250000 THEN 'True' ELSE 'False' END",
}
ATHLETES_SQL = _select(_ATHLETE, "customer")
RESULTS_SQL = _select(_RESULT, "orders")


def athletes(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(table(spark, folder, "customer"), _ATHLETE)


def results(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(table(spark, folder, "orders"), _RESULT)


def results_from(orders: DataFrame) -> DataFrame:
    return _frame(orders, _RESULT)


# Sensor readings -----------------------------------------------------------------------

_READING = {
    "sensor_id": "CAST(user_id AS INT)",
    "ts": "ts",
    "temperature": "value",
    "humidity": "CAST(user_id % 100 AS DOUBLE)",
}
READINGS_SQL = _select(_READING, "events")

_FEW_LIMITS = {
    "temperature_min": "CAST(n_nationkey * 4 AS DOUBLE)",
    "temperature_max": "CASE WHEN n_regionkey = 1 THEN NULL "
    "ELSE CAST(n_nationkey * 4 + 6 AS DOUBLE) END",
    "humidity_min": "CASE WHEN n_regionkey = 2 THEN NULL "
    "ELSE CAST(n_nationkey * 4 AS DOUBLE) END",
    "humidity_max": "CAST(n_nationkey * 4 + 5 AS DOUBLE)",
    "code": "CAST(n_nationkey AS STRING)",
    "message": "n_name",
}
FEW_LIMITS_SQL = _select(_FEW_LIMITS, "nation")

_MANY_LIMITS = {
    "temperature_min": "(p_retailprice - 900) * 4.9E0",
    "temperature_max": "CASE WHEN p_size = 50 THEN NULL "
    "ELSE (p_retailprice - 900) * 4.9E0 + p_size / 1.0E2 END",
    "humidity_min": "CASE WHEN p_size = 1 THEN NULL ELSE (p_retailprice - 900) * 1.0E0 END",
    "humidity_max": "(p_retailprice - 900) * 1.0E0 + p_size / 5.0E1",
    "code": "CAST(p_partkey AS STRING)",
    "message": "p_name",
}
MANY_LIMITS_SQL = _select(_MANY_LIMITS, "part")


def readings(events: DataFrame) -> DataFrame:
    return _frame(events, _READING)


def few_limits(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(table(spark, folder, "nation"), _FEW_LIMITS)


def many_limits(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(table(spark, folder, "part"), _MANY_LIMITS)


# Trades --------------------------------------------------------------------------------


def epoch_millis(time: str = "ts"):
    """Milliseconds since the epoch of a zone-less time."""
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", zero, F.col(time))


def wire_messages(events: DataFrame) -> DataFrame:
    """Events as trades in wire format: views lack a price, signups a quantity, errors
    have no symbol."""
    millis = epoch_millis()
    symbol = F.when(F.col("event_type") == "error", F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.upper("event_type"), F.lit('"'))
    )
    price = F.when(F.col("event_type") == "view", F.lit("")).otherwise(
        F.concat(F.lit('"p":"'), F.col("value"), F.lit('",'))
    )
    quantity = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(
        F.concat(F.lit('"q":"'), F.col("user_id"), F.lit('",'))
    )
    value = F.concat(
        F.lit('{"e":"trade","E":'), millis, F.lit(',"s":'), symbol,
        F.lit(',"t":'), F.col("event_id"), F.lit(","), price, quantity,
        F.lit('"T":'), millis, F.lit(',"m":true,"M":false}'),
    )
    return events.select(F.col("event_id").cast("string").alias("key"), value.alias("value"))


TRADES_SQL = """
SELECT 'trade' AS event_type, epoch_us(ts) // 1000 AS event_time,
       CASE WHEN event_type = 'error' THEN NULL ELSE upper(event_type) END AS symbol,
       event_id AS trade_id,
       CASE WHEN event_type = 'view' THEN 0.0::DOUBLE ELSE value END AS price,
       CASE WHEN event_type = 'signup' THEN 0.0::DOUBLE ELSE user_id::DOUBLE END AS quantity,
       epoch_us(ts) // 1000 AS trade_time, true AS buyer_market_maker, false AS ignore
FROM events"""


def destinations(spark: SparkSession, folder: str) -> DataFrame:
    """(symbol, topic) for every event type but views."""
    types = table(spark, folder, "events").select("event_type").distinct()
    return types.filter("event_type <> 'view'").select(
        F.upper("event_type").alias("symbol"),
        F.concat(F.lit("currency_"), F.col("event_type")).alias("topic"),
    )


DESTINATIONS_SQL = """
SELECT DISTINCT upper(event_type) AS symbol, 'currency_' || event_type AS topic
FROM events WHERE event_type <> 'view'"""


# Customers of two days -----------------------------------------------------------------

_FIRST = {
    "customer_id": "c_custkey",
    "full_name": "c_name",
    "email": "CASE WHEN c_nationkey = 7 THEN '' "
    "ELSE lower(replace(c_name, '#', '.')) || '@mail.example' END",
    "phone": "'+' || CAST(c_nationkey AS STRING) || '-' || CAST(c_custkey AS STRING)",
    "city": "'city ' || CAST(c_nationkey AS STRING)",
    "address": "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL "
    "ELSE CAST(c_custkey AS STRING) || ' ' || c_mktsegment || ' street' END",
    "status": "CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END",
    "sign_up_date": "DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT)",
    "age": "CAST(18 + c_custkey % 60 AS INT)",
    "subscription_type": "c_mktsegment",
}
_LATER = {
    **_FIRST,
    "full_name": "CASE WHEN c_nationkey = 1 THEN upper(c_name) ELSE c_name END",
    "email": f"CASE WHEN c_nationkey IN (2, 3) THEN 'new@mail.example' ELSE {_FIRST['email']} END",
    "phone": f"CASE WHEN c_nationkey = 5 THEN NULL ELSE {_FIRST['phone']} END",
    "city": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'new city' "
    f"ELSE {_FIRST['city']} END",
    "address": "CASE WHEN c_nationkey = 8 THEN 'first street' WHEN c_nationkey = 9 THEN NULL "
    f"ELSE {_FIRST['address']} END",
    "status": f"CASE WHEN c_nationkey = 10 THEN 'closed' ELSE {_FIRST['status']} END",
    "sign_up_date": "CASE WHEN c_nationkey IN (2, 11) THEN DATE '2023-05-01' "
    f"ELSE {_FIRST['sign_up_date']} END",
    "age": f"CASE WHEN c_nationkey = 12 THEN 99 ELSE {_FIRST['age']} END",
    "subscription_type": "CASE WHEN c_nationkey = 13 THEN 'GOLD' ELSE c_mktsegment END",
}
_ADDED = {
    "customer_id": "-1 - s_suppkey",
    "full_name": "s_name",
    "email": "lower(s_name) || '@mail.example'",
    "phone": "CAST(s_nationkey AS STRING)",
    "city": "'city ' || CAST(s_nationkey AS STRING)",
    "address": "CASE WHEN s_nationkey < 5 THEN NULL ELSE 'quay' END",
    "status": "'active'",
    "sign_up_date": "DATE '2024-05-01' + CAST(s_suppkey % 30 AS INT)",
    "age": "CAST(20 + s_nationkey AS INT)",
    "subscription_type": "'SUPPLIER'",
}
_IN_LATER_FILE = "c_acctbal >= -500"
_THIRD = {
    **_LATER,
    "email": f"CASE WHEN c_nationkey IN (2, 6) THEN 'third@mail.example' ELSE {_LATER['email']} END",
    "city": _FIRST["city"],
}
_ADDED_THIRD = {
    **_ADDED,
    "email": f"CASE WHEN s_nationkey < 10 THEN 'later@mail.example' ELSE {_ADDED['email']} END",
}
_IN_THIRD_FILE = "c_acctbal >= 0"

FIRST_SQL = _select(_FIRST, "customer")
CHANGES_SQL = (
    f"{_select(_LATER, 'customer', _IN_LATER_FILE)} UNION ALL {_select(_ADDED, 'supplier')}"
)

THIRD_SQL = (
    f"{_select(_THIRD, 'customer', _IN_THIRD_FILE)} UNION ALL {_select(_ADDED_THIRD, 'supplier')}"
)


def first_day(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(table(spark, folder, "customer"), _FIRST)


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """The second day's file: changed and unchanged customers, some absent, and every
    supplier as a new customer."""
    later = _frame(table(spark, folder, "customer"), _LATER, _IN_LATER_FILE)
    return later.unionByName(_frame(table(spark, folder, "supplier"), _ADDED))


def third_day(spark: SparkSession, folder: str) -> DataFrame:
    """The third day's file: some customers change again, some back, fewer are in it."""
    third = _frame(table(spark, folder, "customer"), _THIRD, _IN_THIRD_FILE)
    return third.unionByName(_frame(table(spark, folder, "supplier"), _ADDED_THIRD))
