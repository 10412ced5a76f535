"""Message decoding and encoding, times, trades."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import messages, times
from tidemark.operators import routing
from tidemark.plans import enrichment, sensor_alerts, trades


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_decode_good_and_bad_messages(spark):
    got = messages.decode(
        values(spark, '{"a":1,"b":"x"}', '{"a":"bad","b":"y"}', "nope", None), "a int, b string"
    )
    assert [tuple(r) for r in got.collect()] == [(1, "x"), (None, "y"), (None, None), (None, None)]


def test_decode_reads_binary_values(spark):
    binary = values(spark, '{"a":1}').select(F.col("value").cast("binary").alias("value"))
    assert messages.decode(binary, "a int").first()["a"] == 1


def test_a_filter_on_decoded_fields_does_not_parse_again(spark):
    got = messages.decode(values(spark, '{"a":1,"b":2}'), "a int, b int").filter("a = 1 and b = 2")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_encode_and_decode_return_the_row(spark):
    data = [(1, "x", None, 2.5), (2, 'q"\\', True, None)]
    frame = spark.createDataFrame(data, "id int, s string, b boolean, d double")
    sent = messages.encode(frame, F.col("id"))
    assert rows(sent)[0] == ("1", '{"id":1,"s":"x","d":2.5}')  # nulls are left out
    assert rows(messages.decode(sent, "id int, s string, b boolean, d double")) == rows(frame)


def test_keys_may_be_json(spark):
    sent = spark.createDataFrame([('"a-1"', '{"n":1}'), ("7", None), (None, "x")], schemas.ENVELOPE)
    got = messages.decode_keyed(sent, "n int")
    assert [tuple(r) for r in got.collect()] == [("a-1", 1), ("7", None), (None, None)]


def test_random_keys_differ(spark):
    sent = messages.encode(spark.range(50))
    assert sent.select("key").distinct().count() == 50


def test_unescape_both_ways(spark):
    twice = r'"{\"name\":\"a \\\"b\\\"\"}"'
    plain = r'"{\"name\":\"ab\"}"'
    frame = values(spark, twice, plain)
    stripped = [r[0] for r in frame.select(messages.strip_escapes(F.col("value"))).collect()]
    assert stripped[1] == '{"name":"ab"}'
    inner = frame.select(messages.inner_json(F.col("value")).alias("value"))
    assert rows(messages.decode(inner, "name string")) == [('a "b"',), ("ab",)]


def test_event_times(spark):
    frame = spark.createDataFrame(
        [("2024-01-01 10:00:00",), ("1.7330000005E9",), ("1733000000",), ("soon",), (None,)], "t string"
    )
    got = frame.select(times.utc_wall_clock(times.event_time(F.col("t")))).collect()
    base = dt.datetime(2024, 11, 30, 20, 53, 20)
    assert [r[0] for r in got] == [
        dt.datetime(2024, 1, 1, 10), base + dt.timedelta(milliseconds=500), base, None, None,
    ]


def test_sensor_readings_accept_both_times(spark):
    got = sensor_alerts.readings(
        values(
            spark,
            '{"sensor_id":1,"timestamp":1733000000.5,"temperature":41,"humidity":10}',
            '{"sensor_id":2,"timestamp":"2024-11-30 20:53:20","temperature":1.5,"humidity":2}',
        )
    )
    assert got.filter("timestamp is null").count() == 0
    assert got.schema["timestamp"].dataType.simpleString() == "timestamp"


WIRE = '{"e":"trade","E":5,"s":"BTCUSDT","t":7,"p":"1.5","q":"2","T":1733000000123,"m":true,"M":false}'


def test_wire_trades(spark):
    frame = values(spark, WIRE, '{"s":"ETHUSDT","T":1}', '{"s":"XRPUSDT","p":"abc","q":"1"}')
    first, missing, bad = trades.normalised(frame).collect()
    assert tuple(first) == ("trade", 5, "BTCUSDT", 7, 1.5, 2.0, 1733000000123, True, False)
    assert (missing["price"], missing["quantity"], missing["trade_time"]) == (0.0, 0.0, 1)
    assert bad["price"] is None


def test_wire_text_is_parsed_once(spark):
    frame = values(spark, WIRE)
    listed = spark.createDataFrame([("btcusdt", "a")], schemas.SYMBOL_TOPIC)
    for made in (trades.normalised(frame), trades.compact(frame, listed), trades.routed(frame)):
        optimized = made._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("parseJson") == 1 and "from_json" not in optimized


def test_odd_wire_texts(spark):
    odd = ["not json", "[1]", "7", "null", None, '{"p":"1","p":"2"}']
    nothing = trades.normalised(values(spark, *odd))
    assert {tuple(r) for r in nothing.collect()} == {(None,) * 9}
    assert trades.compact(values(spark, *odd)).count() == 0
    frame = values(
        spark, '{"p":null,"q":2.50,"m":true,"M":false}', '{"p":"x","q":{"a":1},"E":"abc"}', "{}"
    )
    got = rows(trades.normalised(frame), "price", "quantity", "event_time")
    assert got == [(0.0, 0.0, None), (None, 2.5, None), (None, None, None)]


def test_compact_trades(spark):
    listed = spark.createDataFrame([("btcusdt", "a"), ("XRPUSDT", "b")], schemas.SYMBOL_TOPIC)
    frame = values(spark, WIRE, '{"s":"ETHUSDT","T":1}', '{"s":"XRPUSDT","p":"abc"}', '{"p":"1"}')
    got = trades.compact(frame, listed)
    assert rows(got) == [("btcusdt", 1.5, 2.0, 1733000000123, None)]
    stamped = values(spark, '{"s":"BTCUSDT","p":"1","q":"2","processing_timestamp":"now"}')
    assert rows(trades.compact(stamped)) == [("btcusdt", 1.0, 2.0, 0, "now")]
    null = values(spark, '{"s":"BTCUSDT","p":null,"q":"1"}', '{"s":"BTCUSDT","q":"1"}')
    assert rows(trades.compact(null), "price") == [(0.0,)]  # missing counts as 0, null does not
    assert rows(trades.normalised(null), "price") == [(0.0,), (None,)]
    every = trades.compact(frame)
    assert rows(every, "symbol", "timestamp") == [("btcusdt", 1733000000123), ("ethusdt", 1)]


def test_statistics_over_compact_trades(spark):
    start = 1733000040000  # a full minute
    sent = [("a", 1.0, 2.0, start), ("a", 3.0, 4.0, start + 59_999), ("b", 9.0, 1.0, start + 60_000)]
    frame = spark.createDataFrame([(*t, None) for t in sent], schemas.COMPACT_TRADE)
    got = trades.compact_statistics(messages.encode(frame), "1 minute")
    assert rows(got, "avg_price", "trade_count", "total_volume") == [(2.0, 2, 6.0), (9.0, 1, 1.0)]
    sliding = trades.compact_statistics(messages.encode(frame), "1 minute", "30 seconds")
    assert sliding.agg(F.sum("trade_count")).first()[0] == 6


def test_statistics_messages_hold_all_fields(spark):
    rows_ = trades.decoded(messages.encode(trades.normalised(values(spark, WIRE))))
    sent = trades.statistics_messages(trades.statistics(rows_))
    shape = "window struct<start:timestamp,end:timestamp>, trade_count bigint, price_percentiles array<double>"
    back = messages.decode(sent, shape).collect()
    assert len(back) == 2 and back[0]["price_percentiles"] == [1.5, 1.5, 1.5]


def test_averages_are_read_back_with_the_schema_they_were_written_with(spark):
    frame = spark.createDataFrame(
        [("judo", None, "f", "UKR", 1.5, 2.5, dt.datetime(2024, 1, 1))], schemas.GROUP_AVERAGE
    )
    sent = messages.encode(frame)
    assert rows(enrichment.read_back(sent, encoded_twice=False)) == rows(frame)
    quoted = F.concat(F.lit('"'), F.replace("value", F.lit('"'), F.lit('\\"')), F.lit('"'))
    assert rows(enrichment.read_back(sent.select(quoted.alias("value")))) == rows(frame)
    assert rows(enrichment.read_back(sent.select(quoted.alias("value")), strip=True)) == rows(frame)
    odd = frame.withColumn("sport", F.lit('"long" jump \\ run'))
    inner = messages.encode(odd).select(F.to_json(F.struct("value")).alias("value"))
    inner = inner.select(F.expr("substr(value, 10, length(value) - 10)").alias("value"))
    assert rows(enrichment.read_back(inner)) == rows(odd)


def test_rows_without_a_symbol_do_not_meet_the_checks_of_the_table(spark):
    frame = values(spark, WIRE, '{"s":null,"T":1}', '{"p":"1"}')
    listed = spark.createDataFrame([("btcusdt", "a")], schemas.SYMBOL_TOPIC)
    routed = routing.route_by_table(trades.normalised(frame), listed)
    assert rows(routed, "symbol", "topic") == [("btcusdt", "a")]
