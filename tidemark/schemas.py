"""Schemas of the inputs and messages, as DDL text. All fields are nullable.

Fixed values: names and types belong to the message and file formats.
"""

from __future__ import annotations

ENVELOPE = "key string, value string"

ATHLETE_BIO = (
    "athlete_id int, sex string, height string, weight string, country_noc string"
)

EVENT_RESULT = (
    "edition string, edition_id int, country_noc string, sport string, event string, "
    "result_id bigint, athlete string, athlete_id int, pos string, medal string, "
    "isTeamSport string"
)

# One schema for writing and for reading the averages back.
GROUP_AVERAGE = (
    "sport string, medal string, sex string, country_noc string, "
    "avg_height double, avg_weight double, calculation_time timestamp"
)

SENSOR = "sensor_id int, timestamp string, temperature double, humidity double"

ALERT_LIMITS = (
    "humidity_min double, humidity_max double, temperature_min double, "
    "temperature_max double, code string, message string"
)

# Price and quantity as they come, text or number.
RAW_TRADE = (
    "e string, E bigint, s string, t bigint, p variant, q variant, T bigint, "
    "m boolean, M boolean, processing_timestamp string"
)

TRADE = (
    "event_type string, event_time bigint, symbol string, trade_id bigint, "
    "price double, quantity double, trade_time bigint, buyer_market_maker boolean, "
    "ignore boolean"
)

COMPACT_TRADE = (
    "symbol string, price double, quantity double, timestamp bigint, "
    "processing_timestamp string"
)

SYMBOL_TOPIC = "symbol string, topic string"

CUSTOMER = (
    "customer_id int, full_name string, email string, phone string, city string, "
    "address string, status string, sign_up_date date, age int, "
    "subscription_type string"
)

REPORT_LOG = "id bigint, value string, count bigint, created_at timestamp_ntz"
