"""Thresholds, windows, formats and field lists the results depend on."""

from __future__ import annotations

# Message formats
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
TOPIC_PREFIX = "topic_"
SYMBOL_TOPICS = (
    ("BTCUSDT", "currency_btcusdt"),
    ("ETHUSDT", "currency_ethusdt"),
    ("XRPUSDT", "currency_xrpusdt"),
)

GROUPS = ("sport", "medal", "sex", "country_noc")
MEASURES = {"height": "avg_height", "weight": "avg_weight"}
ALERT_FIELDS = ("window", "avg_temp", "avg_humidity", "code", "message", "alert_time")
STATISTICS_FIELDS = (
    "window",
    "avg_price",
    "min_price",
    "max_price",
    "price_stddev",
    "trade_count",
    "avg_quantity",
    "total_volume",
    "price_percentiles",
)

# Sensor limits: hot above, dry below, wet above
HOT_ABOVE = 40
DRY_BELOW = 20
WET_ABOVE = 80

# Event-time windows
WINDOW_LENGTH = "1 minute"
WINDOW_SLIDE = "30 seconds"
WATERMARK_DELAY = "10 seconds"

# Triggers of the streaming jobs
ALERT_EVERY = "10 seconds"
AVERAGES_EVERY = "10 seconds"
STATISTICS_EVERY = "60 seconds"
CONSOLE_EVERY = "30 seconds"
CONSOLE_ALERTS = 10
CONSOLE_STATISTICS = 50

# Window statistics
QUARTILES = [0.25, 0.5, 0.75]
PERCENTILE_ACCURACY = 100

# Report log
MEDALS = ("Bronze", "Silver", "Gold")
FRESH_SECONDS = 30

# Customer dimension
CUSTOMER_KEY = "customer_id"
CUSTOMER_FIELDS = (
    "customer_id",
    "full_name",
    "email",
    "phone",
    "city",
    "address",
    "status",
    "sign_up_date",
    "age",
    "subscription_type",
)
SIX_FIELDS = ("email", "phone", "city", "address", "status", "subscription_type")
