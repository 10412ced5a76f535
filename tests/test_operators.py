"""Operators against small fixtures and brute force."""

import datetime as dt
import math
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidemark.functions.numbers import is_number, mean, number_or_zero
from tidemark.operators import averages, cleaning, joins, ranges, report, routing, sizing, windows

# --- cleaning -----------------------------------------------------------------------------


def test_clean_trims_spaces_only_and_keeps_other_types(spark):
    data = [("  Ab C ", 1), ("\tX", 2), (None, 3)]
    frame = spark.createDataFrame(data, "name string, n int")
    assert rows(cleaning.clean_strings(frame)) == sorted(
        [("ab c", 1), ("\tx", 2), (None, 3)], key=repr
    )


def test_clean_then_distinct_is_idempotent(spark):
    data = [(" A", None), ("a ", None), ("a", 1), ("b", 1)]
    frame = spark.createDataFrame(data, "name string, n int")
    once = cleaning.distinct_rows(cleaning.clean_strings(frame))
    twice = cleaning.distinct_rows(cleaning.clean_strings(once))
    assert rows(once) == rows(twice) == sorted([("a", None), ("a", 1), ("b", 1)], key=repr)


def test_numbers_as_text(spark):
    frame = spark.createDataFrame(
        [("180", "70"), ("176-180", "70"), ("", "70"), (None, "70"), ("1.5e2", "x"), ("181.5", "7")],
        "height string, weight string",
    )
    assert rows(cleaning.keep_numeric(frame, "height", "weight")) == [("180", "70"), ("181.5", "7")]
    flags = frame.select(is_number(F.col("height")), number_or_zero(F.col("height")))
    assert [tuple(r) for r in flags.collect()] == [
        (True, 180.0), (False, None), (False, None), (False, 0.0), (True, 150.0), (True, 181.5),
    ]


def test_thresholds(spark):
    data = [(1, 40.0, 50.0), (2, 40.1, 50.0), (3, 30.0, 19.9), (4, 30.0, 80.1), (5, None, 20.0)]
    frame = spark.createDataFrame(data, "id int, temperature double, humidity double")
    assert rows(cleaning.out_of_range(frame), "id") == [(2,), (3,), (4,)]


# --- joins --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key, a third are copies of one row, some have none."""
    data = [(1, i) for i in range(300)] + [(2, 0)] * 300
    data += [(k % 50, -k) for k in range(200)] + [(None, i) for i in range(100)]
    return spark.createDataFrame(data, "k int, v int").repartition(3)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(k, f"t{k}") for k in range(40)], "k int, t string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_join_equals_the_plain_join(hot, table, how):
    got = joins.hot_key_join(hot, table, "k", how, hot_rows=100, salts=4)
    want = hot.join(table, "k", how)
    assert rows(got, *want.columns) == rows(want)


def test_hot_keys_are_spread(spark, hot):
    salted = hot.withColumn("s", joins.row_salt(hot, 4)).filter("k = 2")
    assert salted.select("s").distinct().count() > 1  # exact copies, different partitions


def test_lookup_broadcasts_only_a_measured_small_table(hot, table):
    small = joins.lookup_join(hot, table, "k")
    large = joins.lookup_join(hot, table, "k", max_rows=10)
    assert "ResolvedHint (strategy=broadcast)" in plan(small) or "BroadcastHash" in plan(small)
    assert "_salt" in plan(large)
    assert rows(small) == rows(large, *small.columns)


def test_measure_counts_rows_and_bytes(spark):
    frame = spark.createDataFrame([("x" * 100, [1, 2])], "a string, b array<int>")
    size = sizing.measure(frame)
    assert size.rows == 1 and size.bytes > 100
    assert not size.fits(max_bytes=50) and not size.fits(max_rows=0) and size.fits()
    assert sizing.measure(frame.limit(0)) == sizing.Size(0, 0)


# --- averages -----------------------------------------------------------------------------


@pytest.mark.parametrize("way", ["broadcast", "counted", "joined"])
@pytest.mark.parametrize("scale", [None, 2])
def test_joined_averages_equal_join_then_average(spark, scale, way, monkeypatch):
    limits = {} if way == "broadcast" else {"max_rows": 0}
    monkeypatch.setattr(averages, "COUNTED_SHARE", 0.5)
    monkeypatch.setattr(averages, "counting_pays", lambda rows, keys: way == "counted")
    rng = random.Random(7)
    facts = spark.createDataFrame(
        [(1 if rng.random() < 0.4 else rng.randrange(20), rng.choice(["a", "b", None]))
         for _ in range(500)],
        "id int, sport string",
    )
    people = spark.createDataFrame(
        [(k, rng.choice(["f", "m"]), rng.choice([None, "n/a", str(round(rng.random(), 2))]))
         for k in range(18)],
        "id int, sex string, height string",
    )
    got = averages.joined_averages(
        facts, people, "id", ["sport", "sex"], {"height": "h"}, scale=scale, **limits
    )
    plain = facts.join(people.withColumn("height", F.expr("try_cast(height as double)")), "id")
    want = averages.group_averages(plain, ["sport", "sex"], {"height": "h"}, scale=scale)
    a, b = rows(got), rows(want)
    assert [r[:2] for r in a] == [r[:2] for r in b]
    for x, y in zip(a, b):
        assert (x[2] is None) == (y[2] is None)
        assert x[2] is None or math.isclose(x[2], y[2], rel_tol=1e-12)


def test_the_way_of_joined_averages_follows_the_sizes(spark):
    many = spark.range(4000).selectExpr("id % 7 AS id", "cast(id % 3 AS string) AS sport")
    each = spark.range(4000).selectExpr("id", "cast(id % 3 AS string) AS sport")
    people = spark.range(4000).selectExpr("id", "'f' AS sex", "'1.5' AS height")

    def exchanges(facts, **limits):
        found = averages.joined_averages(facts, people, "id", ["sport", "sex"], {"height": "h"}, **limits)
        physical = found._jdf.queryExecution().executedPlan().toString()
        optimized = found._jdf.queryExecution().optimizedPlan().toString()
        return physical.count("Exchange hashpartitioning"), "_rows" in optimized, "_salt" in optimized

    assert exchanges(many) == (1, False, False)  # broadcast: partial averages only
    assert averages.counting_pays(many, ["id", "sport"]) and not averages.counting_pays(each, ["id"])
    assert exchanges(many, max_rows=0)[1:] == (True, False)
    assert exchanges(each, max_rows=0)[1:] == (False, True)


def test_hot_keys_come_from_a_sketch(spark, hot, table):
    text = plan(joins.hot_key_join(hot, table, "k", hot_rows=100, salts=4))
    assert "approx_top_k" in text


# --- windows ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def readings(spark):
    start = dt.datetime(2024, 1, 1)
    rng = random.Random(3)
    data = [
        (start + dt.timedelta(seconds=rng.randrange(3600)), rng.randrange(100) / 4, i % 7 + 0.5)
        for i in range(400)
    ]
    data += [(start + dt.timedelta(seconds=30), None, 1.0)]
    return spark.createDataFrame(data, "ts timestamp_ntz, temperature double, humidity double")


def test_a_row_on_a_boundary_starts_the_window(spark):
    at = dt.datetime(2024, 1, 1, 0, 1)
    frame = spark.createDataFrame([(at, 1.0, 1.0)], "ts timestamp_ntz, temperature double, humidity double")
    found = windows.sensor_averages(frame, "ts", "1 minute", "30 seconds")
    assert rows(found.select("window.start")) == [(dt.datetime(2024, 1, 1, 0, 0, 30),), (at,)]


def test_counts_of_tumbling_and_sliding_windows(readings):
    n = F.count("*").alias("n")
    tumbling = windows.windowed(readings, "ts", "1 minute", None, n)
    sliding = windows.windowed(readings, "ts", "1 minute", "30 seconds", n)
    assert tumbling.agg(F.sum("n")).first()[0] == readings.count()
    assert sliding.agg(F.sum("n")).first()[0] == 2 * readings.count()


def test_panes_equal_windows(readings):
    wanted = {"temperature": "avg_temp", "humidity": "avg_humidity"}
    panes = windows.pane_averages(
        readings, "ts", "10 minutes", "30 seconds", wanted, scale=2
    )
    plain = windows.windowed(
        readings,
        "ts",
        "10 minutes",
        "30 seconds",
        *(mean(F.col(m), 2).alias(name) for m, name in wanted.items()),
    )
    assert rows(panes) == rows(plain)
    many = windows.sensor_averages(readings, "ts", "10 minutes", "30 seconds", scale=2)
    assert rows(many) == rows(plain)
    assert windows.windows_per_row("1 minute", "30 seconds") == 2
    assert windows.windows_per_row("1 day", "1 hour") == 24
    assert windows.windows_per_row("1 hour", None) == 1
    assert windows.windows_per_row("1 week", "1 day") == 7
    assert windows.windows_per_row("1 hour 30 minutes", "500 milliseconds") == 10_800


def test_pane_statistics_equal_windows(spark):
    random.seed(4)
    sent = [(1_700_000_000 + random.randrange(6 * 3600), 1e9 + random.gauss(0, 3), random.randrange(9))
            for _ in range(6000)] + [(1_700_050_000, None, None), (1_700_060_000, 5.0, None)]
    frame = spark.createDataFrame(sent, "t long, price double, quantity long")
    frame = frame.withColumn("t", F.timestamp_seconds("t")).repartition(5)
    got = windows.pane_statistics(frame, "t", "2 hours", "10 minutes", scale=2)
    want = windows.windowed(frame, "t", "2 hours", "10 minutes", *windows.trade_statistics(scale=2))
    assert got.columns == want.columns
    exact = ["window", "avg_price", "min_price", "max_price", "trade_count", "avg_quantity", "total_volume"]
    assert rows(got, *exact) == rows(want, *exact)
    near = {r["window"]: r["price_stddev"] for r in want.collect()}
    by_window = {r["window"]: r for r in got.collect()}
    for window, row in by_window.items():
        if near[window] is None:
            assert row["price_stddev"] is None
            continue
        assert row["price_stddev"] == pytest.approx(near[window], rel=1e-6)
        low, high = (int(row["window"][i].timestamp()) for i in (0, 1))
        inside = sorted(p for t, p, _ in sent if low <= t < high and p is not None)
        for share, value in zip((0.25, 0.5, 0.75), row["price_percentiles"]):
            ranks = [i / len(inside) for i, p in enumerate(inside) if p == value]
            slack = windows.SKETCH_RANK_ERROR + 1 / len(inside)
            assert min(ranks) - slack <= share <= max(ranks) + slack
    text = plan(got)
    assert "Expand" not in text.split("== Physical Plan ==")[1].split("HashAggregate")[-1]


def test_statistics_of_one_row(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1), 2.0, 3.0)], "ts timestamp_ntz, price double, quantity double")
    row = windows.windowed(frame, "ts", "1 minute", None, *windows.trade_statistics()).first()
    assert row["price_stddev"] is None and row["trade_count"] == 1
    assert row["price_percentiles"] == [2.0, 2.0, 2.0] and row["total_volume"] == 3.0


# --- range join ---------------------------------------------------------------------------

LIMITS = "tmin double, tmax double, hmin double, hmax double, code string"
HALVES = (ranges.Bounds("t", "tmin", "tmax"), ranges.Bounds("h", "hmin", "hmax"))
WAYS = [
    pytest.param({}, id="list"),
    pytest.param({"list_rows": 0}, id="cells"),
    pytest.param({"list_rows": 0, "max_rows": 0, "hot_rows": 5}, id="cells-shuffled"),
]


@pytest.mark.parametrize("way", WAYS)
def test_bounds_are_open_and_nulls_never_match(spark, way):
    readings = spark.createDataFrame([(1, 10.0, 50.0), (2, 15.0, 50.0), (3, None, 55.0)], "id int, t double, h double")
    limits = spark.createDataFrame(
        [
            (10.0, 20.0, None, 60.0, "low bound"),
            (10.0, 15.0, None, None, "high bound"),
            (5.0, 30.0, 40.0, 60.0, "both"),
            (None, 99.0, 54.0, 56.0, "one half"),
            (20.0, 10.0, None, None, "empty"),
        ],
        LIMITS,
    )
    got = ranges.match_rules(readings, limits, HALVES, **way)
    assert rows(got, "id", "code") == [
        (1, "both"), (2, "both"), (2, "low bound"), (3, "both"), (3, "one half"),
    ]


@pytest.mark.parametrize("way", WAYS)
def test_range_join_equals_brute_force(spark, way):
    rng = random.Random(11)
    inf, nan = math.inf, math.nan
    odd = [None, inf, -inf, nan, 0.0, 1e300, -1e300, 2.0**39, 2.0**40]

    def value():
        return rng.choice(odd) if rng.random() < 0.2 else rng.uniform(-100, 100)

    def pair():
        if rng.random() < 0.3:
            return value(), value()
        low = rng.choice([rng.uniform(-100, 100), float(rng.randrange(-8, 8))])
        return low, low + rng.choice([2.0**-30, 1e-3, 0.5, 1.0, 8.0, 50.0, 1e13, inf])

    readings = [(i, value(), value()) for i in range(120)] + [(0, 1.5, 2.5)] * 5
    limits = [(*pair(), *pair(), f"r{i}") for i in range(80)]

    def less(a, b):  # Spark's order: NaN is the largest number and equals itself
        if a is None or b is None or (a != a):
            return False
        return True if b != b else a < b

    want = []
    for i, t, h in readings:
        for tmin, tmax, hmin, hmax, code in limits:
            if (less(tmin, t) and less(t, tmax)) or (less(hmin, h) and less(h, hmax)):
                want.append((i, code))
    got = ranges.match_rules(
        spark.createDataFrame(readings, "id int, t double, h double"),
        spark.createDataFrame(limits, LIMITS),
        HALVES,
        **way,
    )
    assert rows(got, "id", "code") == sorted(want, key=repr)


@pytest.mark.parametrize("way", WAYS)
def test_bounds_that_are_one_double_still_match(spark, way):
    big = 2**54
    readings = spark.createDataFrame([(big + 1, 0), (big + 3, 0), (-(2**62) - 1, 0)], "t bigint, h bigint")
    limits = spark.createDataFrame(
        [(big, big + 2, "a"), (-(2**62) - 2, -(2**62), "b"), (5, 5, "empty")],
        "tmin bigint, tmax bigint, code string",
    )
    got = ranges.match_rules(readings, limits, HALVES[:1], **way)
    assert rows(got, "t", "code") == [(-(2**62) - 1, "b"), (big + 1, "a")]


def test_stream_levels_give_the_same_pairs(spark, tmp_path):
    rng = random.Random(5)
    wide = [1e-6, 0.3, 7.0, 300.0, 1e6, 1e30, math.inf]
    readings = [(i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(60)]
    limits = []
    for i in range(90):
        t, h = rng.uniform(-50, 50), rng.choice([None, rng.uniform(-50, 50)])
        limits.append((t, t + rng.choice(wide), h, 60.0, f"r{i}"))
    table = spark.createDataFrame(limits, LIMITS)
    source = spark.createDataFrame(readings, "id int, t double, h double")
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    out = ranges.match_rules(stream, table, HALVES).writeStream.format("parquet")
    out = out.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
    out.start(str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got, "id", "code") == rows(ranges.match_rules(source, table, HALVES, list_rows=100), "id", "code")


@pytest.mark.parametrize("halves", [1, 2])
def test_totals_of_rules_equal_those_of_pairs(spark, halves):
    """Counted in many small pieces, with hot, missing and odd values and rules of one group."""
    rng = random.Random(3)
    odd = [None, math.inf, -math.inf, math.nan, 0.0, -0.0, 1e300]

    def value():
        return rng.choice(odd) if rng.random() < 0.1 else round(rng.uniform(-20, 20), 1)

    readings = [(i, value(), rng.choice([5.0, float(rng.randrange(9)), value()])) for i in range(400)]
    limits = []
    for i in range(150):
        t, h = value(), value()
        limits.append((
            t, t if t is None else t + rng.choice([0.1, 3.0, 30.0]), h, rng.choice([value(), math.inf]),
            rng.choice([None, f"r{i % 90}"]),
        ))
    readings = spark.createDataFrame(readings, "id int, t double, h double")
    limits = spark.createDataFrame(limits, LIMITS)
    totals = ranges.Totals("code", "n", {"first": "id"}, {"last": "id", "top": "t"})
    way = {"list_rows": 0, "totals": totals}
    pairs = ranges.match_rules(readings, limits, HALVES[:halves], **way)
    counted = ranges.match_rules(readings, limits, HALVES[:halves], most_pairs=0, **way)
    cut = ranges.rule_totals(
        readings, limits, HALVES[:halves], totals, piece_values=7, sweep_rows=20, max_rows=0
    )
    want = repr(rows(pairs))  # NaN is not equal to itself
    assert "r1" in want and repr(rows(counted)) == want and repr(rows(cut)) == want


def test_many_rules_are_totalled_without_their_pairs(spark):
    """Every reading is within every rule: 400 million pairs."""
    readings = spark.range(20_000).selectExpr("CAST(id AS INT) AS id", "rand(1) AS t", "rand(2) AS h")
    limits = spark.range(20_000).selectExpr(
        "-1.0 - id AS tmin", "2.0D AS tmax", "-1.0D AS hmin", "2.0 + id AS hmax", "CAST(id % 3 AS STRING) AS code"
    )
    totals = ranges.Totals("code", "n", {"first": "id"})
    found = ranges.match_rules(readings, limits, HALVES, totals=totals)
    assert "SortMergeJoin [_half" not in plan(found) and "_look" not in plan(found)
    assert rows(found) == [("0", 6667 * 20_000, 0), ("1", 6667 * 20_000, 0), ("2", 6666 * 20_000, 0)]


def test_no_rules_give_no_alerts(spark):
    readings = spark.createDataFrame([(1, 1.0, 1.0)], "id int, t double, h double")
    limits = spark.createDataFrame([(None, 1.0, 5.0, 2.0, "x")], LIMITS)
    found = ranges.match_rules(readings, limits, HALVES, list_rows=0)
    assert found.count() == 0 and found.columns == ["id", "t", "h", *limits.columns]


def test_long_rule_lists_use_an_equi_join(spark):
    readings = spark.createDataFrame([(1, 1.0, 1.0)], "id int, t double, h double")
    limits = spark.createDataFrame([(0.0, 2.0, None, None, "x")], LIMITS)
    text = plan(ranges.match_rules(readings, limits, HALVES, list_rows=0, max_rows=0))
    assert "NestedLoop" not in text and "Cartesian" not in text


# --- routing ------------------------------------------------------------------------------


def test_a_symbol_has_one_topic(spark):
    trades = spark.createDataFrame([("BTC", 1)], "symbol string, n int")
    pairs = [("BTC", "a"), ("btc", "b"), (None, "c")]
    twice = spark.createDataFrame(pairs, "symbol string, topic string")
    with pytest.raises(Exception, match="not unique"):
        routing.route_by_table(trades, twice).collect()
    same = spark.createDataFrame([("BTC", "a"), ("btc", "a"), (None, "c")], "symbol string, topic string")
    assert rows(routing.route_by_table(trades, same), "topic", "n") == [("a", 1)]
    last = routing.destination_table(spark, pairs[:2])
    assert rows(routing.route_by_table(trades, last), "topic", "n") == [("b", 1)]


def test_routing(spark, tmp_path):
    trades = spark.createDataFrame([("BTC", 1), ("btc", 2), (None, 3), ("DOGE", 4)], "symbol string, n int")
    table = spark.createDataFrame([("BTC", "currency_btc")], "symbol string, topic string")
    assert rows(routing.route_by_symbol(trades), "topic", "n") == [
        ("topic_BTC", 1), ("topic_DOGE", 4), ("topic_btc", 2),
    ]
    assert rows(routing.route_by_table(trades, table), "symbol", "topic", "n") == [
        ("btc", "currency_btc", 1), ("btc", "currency_btc", 2),
    ]
    assert rows(routing.keep_listed(trades, table), "n") == [(1,), (2,)]
    assert ("BTCUSDT", "currency_btcusdt") in rows(routing.destination_table(spark))
    routing.write_by_topic(routing.route_by_symbol(trades), str(tmp_path / "out"))
    assert (tmp_path / "out" / "topic=topic_BTC").is_dir()


# --- report -------------------------------------------------------------------------------


def test_report_counts_ids_and_freshness(spark):
    medals = spark.createDataFrame([("Gold",), ("Gold",), ("Silver",), (None,), ("x",)], "medal string")
    counts = report.count_by_value(medals, "medal")
    assert rows(counts) == [("Gold", 2), ("Silver", 1)]
    at = dt.datetime(2024, 1, 1, 12)
    log = report.log_rows(counts, at, last_id=10)
    assert rows(log, "id", "value", "count") == [(12, "Silver", 1), (13, "Gold", 2)]
    for seconds, fresh in ((29.9, True), (30, False), (31, False)):
        row = report.freshness(log, at + dt.timedelta(seconds=seconds)).first()
        assert (row["value"], row["fresh"]) == ("Gold", fresh)


def test_no_python_in_the_plans(spark):
    from conftest import SMALL

    from tidemark.checks import QUERIES

    for name in ("gold_avg_stats", "scd2_relational", "alerts_many_rules", "trade_compact"):
        text = plan(QUERIES[name](spark, SMALL))
        assert "Python" not in text and "Pandas" not in text
        assert "Cartesian" not in text and "NestedLoop" not in text
