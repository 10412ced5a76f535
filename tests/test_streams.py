"""Streams: late rows, restart, repeated batches, two sinks, stopping."""

import datetime as dt
import json
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import messages
from tidemark.operators import windows
from tidemark.plans import enrichment, sensor_alerts, trades
from tidemark.session import stream_session
from tidemark.sources.files import stream_folder
from tidemark.streaming import runner, sinks

READING = "ts timestamp, temperature double, humidity double"


@pytest.fixture(scope="module")
def session(spark):
    return stream_session(spark, 2)


def put(session, folder, number, *times):
    """One file with a reading of 1 degree at each time."""
    data = [(dt.datetime(2024, 1, 1, *t), 1.0, 2.0) for t in times]
    path = folder / f"f{number}"
    session.createDataFrame(data, READING).coalesce(1).write.json(str(path))


def drained(session, folder, out, **given):
    stream = stream_folder(
        session, f"{folder}/*", READING, "*.json", "json", files_per_trigger=1
    )
    found = windows.windowed(
        stream, "ts", "1 minute", None, F.count("*").alias("n"), watermark="10 seconds"
    ).select("window.start", "n")
    writer = runner.writer(found, f"{out}/checkpoint", drain=True, **given)
    runner.finish(runner.to_files(writer, f"{out}/rows").start())
    return {r[0].minute: r[1] for r in session.read.parquet(f"{out}/rows").collect()}


def test_late_rows_are_dropped_one_batch_after_the_watermark(session, tmp_path):
    ahead, filler, late, closing = [(0, 0, 5), (0, 5, 0)], [(0, 5, 1)], [(0, 0, 50)], [(0, 9, 0)]
    for name, files, first_window in (
        ("dropped", (ahead, filler, late, closing), 1),
        ("counted", (ahead, late, filler, closing), 2),  # judged by the batch before
    ):
        for number, at in enumerate(files):
            put(session, tmp_path / name, number, *at)
            time.sleep(1.1)  # files are taken by modification time
        got = drained(session, tmp_path / name, tmp_path / f"{name}-out")
        assert got == {0: first_window, 5: 2}


def test_panes_on_a_stream_take_late_rows_of_any_open_window(session, tmp_path):
    """A row that only some of its windows still take is lost to the others on a plain stream;
    panes keep it for all of them, over a stop and a restart."""
    def put_at(number, *minutes):
        sent = [dt.datetime(2024, 1, 1, 0, m) for m in minutes]
        frame = session.createDataFrame([(1, t, float(t.minute), 1.0) for t in sent],
                                        "sensor_id int, ts timestamp, temperature double, humidity double")
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1)

    def drain(name, **given):
        shape = session.read.parquet(f"{tmp_path}/in").schema
        stream = stream_folder(session, f"{tmp_path}/in", shape, files_per_trigger=1)
        found = windows.sensor_averages(stream, "ts", "8 minutes", "1 minute", **given)
        found = found.select("window.start", "avg_temp")
        writer = runner.writer(found, f"{tmp_path}/{name}/checkpoint", drain=True)
        runner.finish(runner.to_files(writer, f"{tmp_path}/{name}/rows").start())
        return dict(map(tuple, session.read.parquet(f"{tmp_path}/{name}/rows").collect()))

    put_at(0, 1, 2, 10)
    put_at(1, 11, 4)  # 4 is late: of its windows those that start at 2 and later are open
    drain("panes", stream_panes=True), drain("plain")
    put_at(2, 12, 6)
    put_at(3, 59)
    panes, plain = drain("panes", stream_panes=True), drain("plain")
    table = session.read.parquet(f"{tmp_path}/in")
    every = windows.sensor_averages(table, "ts", "8 minutes", "1 minute").select("window.start", "avg_temp")
    truth = {k: v for k, v in map(tuple, every.collect()) if k < dt.datetime(2024, 1, 1, 0, 43)}
    assert {k: v for k, v in panes.items() if k in truth} == truth
    assert any(plain.get(k) != v for k, v in truth.items())


def test_restart_repeats_nothing(session, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    put(session, folder, 0, (0, 0, 5), (0, 0, 6), (0, 2, 0))
    assert drained(session, folder, out) == {0: 2}
    assert drained(session, folder, out) == {0: 2}
    put(session, folder, 1, (0, 2, 30), (0, 8, 0))
    assert drained(session, folder, out) == {0: 2, 2: 2}


def test_a_windowed_stream_needs_a_watermark(session, tmp_path):
    folder = tmp_path / "in"
    put(session, folder, 0, (0, 0, 5))
    stream = stream_folder(session, f"{folder}/*", READING, "*.json", "json")
    with pytest.raises(ValueError, match="watermark"):
        windows.windowed(stream, "ts", "1 minute", None, F.count("*"))


def test_every_query_needs_a_checkpoint(spark):
    with pytest.raises(ValueError, match="checkpoint"):
        runner.writer(spark.range(1), "")


def test_a_repeated_batch_is_not_appended_twice(spark, tmp_path):
    path = str(tmp_path / "table")
    shape = "g string, v double, batch_id bigint"
    spark.createDataFrame([], shape).write.parquet(path)

    def there(number):
        return spark.read.schema(shape).parquet(path).filter(F.col("batch_id") == number)

    sink = sinks.append_once(there, lambda d: d.write.mode("append").parquet(path), ["g"])
    batch = spark.createDataFrame([("a", 1.0), (None, 2.0), ("c", 3.0)], "g string, v double")
    sink(batch.filter("v < 3"), 0)  # a write that broke off after two groups
    sink(batch, 0)
    sink(batch.limit(0), 1)
    sink(batch.filter("g = 'a'").withColumn("v", F.lit(9.0)), 2)
    log = spark.read.parquet(path)
    assert log.count() == 4
    assert rows(sinks.latest(log, ["g"])) == sorted([("a", 9.0), (None, 2.0), ("c", 3.0)], key=repr)


def test_batch_folders_replace_a_repeated_batch(spark, tmp_path):
    sink = sinks.batch_folders(str(tmp_path))
    sink(spark.range(3), 0)
    sink(spark.range(5), 0)
    assert sinks.read_log(spark, str(tmp_path)).count() == 5


def test_one_computation_for_all_sinks(spark):
    seen = []
    sink = sinks.to_all(
        lambda d, n: seen.append((n, d.count(), d.is_cached)),
        lambda d, n: seen.append((n, d.count(), d.is_cached)),
    )
    sink(spark.range(4), 7)
    sink(spark.range(0), 8)  # empty: skipped
    assert seen == [(7, 4, True), (7, 4, True)]

    def broken(batch, number):
        raise RuntimeError("sink is down")

    with pytest.raises(RuntimeError):
        sinks.to_all(broken)(spark.range(1), 9)


def test_running_averages_over_batches(session, tmp_path):
    folder = tmp_path / "topic"
    athletes = session.createDataFrame(
        [(1, "f", "170", "60", "UKR"), (2, "f", "180", "70", "UKR"), (3, "f", "n/a", "1", "UKR")],
        schemas.ATHLETE_BIO,
    )
    for number, people in enumerate(([1, 3], [2], [])):
        data = [
            (str(i), json.dumps({"sport": "judo", "country_noc": "UKR", "athlete_id": i}))
            for i in people
        ] + [("x", "broken")]
        path = str(folder / f"f{number}")
        session.createDataFrame(data, schemas.ENVELOPE).coalesce(1).write.parquet(path)
    stream = stream_folder(session, f"{folder}/*", schemas.ENVELOPE, files_per_trigger=1)
    averages = enrichment.running_averages(stream, athletes, "2024-01-01 00:00:00")
    log = str(tmp_path / "log")
    writer = runner.writer(averages, str(tmp_path / "check"), "update", drain=True)
    runner.finish(runner.to_batches(writer, sinks.to_all(sinks.batch_folders(log))).start())
    history = sinks.read_log(session, log)
    assert rows(history, "avg_height") == [(170.0,), (175.0,)]  # one row per changed batch
    newest = sinks.latest(history, ["sport", "medal", "sex", "country_noc"])
    assert rows(newest, "sport", "medal", "avg_height", "avg_weight") == [("judo", None, 175.0, 65.0)]


def test_alert_stream_equals_the_batch_without_open_windows(session, tmp_path):
    folder = tmp_path / "in"
    put(session, folder, 0, (0, 0, 5), (0, 1, 10), (0, 5, 0), (0, 9, 0))
    limits = session.createDataFrame([(None, None, 0.5, 1.5, "1", "warm")], schemas.ALERT_LIMITS)
    stream = stream_folder(session, f"{folder}/*", READING, "*.json", "json")
    table = session.read.schema(READING).json(f"{folder}/*")
    out = runner.writer(
        sensor_alerts.alert_messages(sensor_alerts.alerts(stream, limits, "ts")),
        str(tmp_path / "check"),
        drain=True,
    )
    runner.finish(runner.to_files(out, str(tmp_path / "rows")).start())
    shape = "window struct<start:timestamp,end:timestamp>, code string"
    got = messages.decode(session.read.parquet(str(tmp_path / "rows")), shape)
    closed_by = dt.datetime(2024, 1, 1, 0, 8, 50)
    want = sensor_alerts.alerts(table, limits, "ts").filter(F.col("window.end") <= F.lit(closed_by))
    assert rows(got.select("window.start", "code")) == rows(want.select("window.start", "code"))
    assert got.count() == 6


def test_panes_on_a_stream_equal_the_batch(session, tmp_path):
    folder = tmp_path / "in"
    put(session, folder, 0, (0, 0, 5), (0, 1, 10), (0, 1, 40), (0, 5, 0))
    put(session, folder, 1, (0, 5, 20), (0, 20, 0))
    stream = stream_folder(session, f"{folder}/*", READING, "*.json", "json", 1)
    found = windows.sensor_averages(stream, "ts", "4 minutes", "30 seconds")
    out = runner.writer(found, str(tmp_path / "check"), drain=True)
    runner.finish(runner.to_files(out, str(tmp_path / "rows")).start())
    table = session.read.schema(READING).json(f"{folder}/*")
    whole = windows.sensor_averages(table, "ts", "4 minutes", "30 seconds")
    closed_by = F.lit(dt.datetime(2024, 1, 1, 0, 19, 50))
    want = whole.filter(F.col("window.end") <= closed_by)
    assert rows(session.read.parquet(str(tmp_path / "rows"))) == rows(want)
    assert want.count() > 10


def test_long_rule_lists_work_on_a_stream(session, tmp_path):
    folder = tmp_path / "in"
    put(session, folder, 0, (0, 0, 5), (0, 1, 10), (0, 5, 0), (0, 9, 0))
    limits = session.createDataFrame(
        [(None, None, 0.5, 1.5, f"{i}", "warm") for i in range(70)]
        + [(1.0, 3.0, 0.5, 1.5, "both", "")],
        schemas.ALERT_LIMITS,
    )
    stream = stream_folder(session, f"{folder}/*", READING, "*.json", "json")
    found = sensor_alerts.alerts(stream, limits, "ts").select("window.start", "code")
    out = runner.writer(found, str(tmp_path / "check"), drain=True)
    runner.finish(runner.to_files(out, str(tmp_path / "rows")).start())
    got = session.read.parquet(str(tmp_path / "rows"))
    assert got.count() == 6 * 71 and got.distinct().count() == 6 * 71


@pytest.mark.parametrize("sent_to_athletes", [False, True])
def test_both_ways_of_the_static_join_agree(session, tmp_path, sent_to_athletes):
    folder = tmp_path / "topic"
    data = [(str(i), json.dumps({"sport": "judo", "athlete_id": i % 3})) for i in range(9)]
    session.createDataFrame(data, schemas.ENVELOPE).write.parquet(str(folder))
    athletes = session.createDataFrame(
        [(i, "f", str(170 + i), "60", "UKR") for i in range(3)], schemas.ATHLETE_BIO
    )
    stream = stream_folder(session, str(folder), schemas.ENVELOPE)
    averages = enrichment.running_averages(
        stream, athletes, "2024-01-01 00:00:00", broadcast_results=sent_to_athletes
    )
    log, topic = str(tmp_path / "log"), str(tmp_path / "averages")
    columns = f"{schemas.GROUP_AVERAGE}, batch_id bigint"
    session.createDataFrame([], columns).write.parquet(log)
    out = enrichment.job(
        averages,
        str(tmp_path / "check"),
        publish=lambda sent: sent.write.mode("append").parquet(topic),
        read=lambda n: session.read.parquet(log).filter(F.col("batch_id") == n),
        append=lambda rows_: rows_.write.mode("append").parquet(log),
        drain=True,
    )
    runner.finish(out.start())
    assert rows(session.read.parquet(log), "avg_height", "avg_weight") == [(171.0, 60.0)]
    back = enrichment.read_back(session.read.parquet(topic), encoded_twice=False)
    assert rows(back, "sport", "avg_height") == [("judo", 171.0)]
    with pytest.raises(ValueError, match="micro-batch"):
        enrichment.enriched(session.read.parquet(str(folder)), athletes, broadcast_results=True)


def test_alert_job_writes_messages_and_console(session, tmp_path):
    folder = tmp_path / "in"
    data = [
        (json.dumps({"sensor_id": 1, "timestamp": f"2024-01-01 00:0{m}:00", "temperature": 41.0,
                     "humidity": 50.0}),)
        for m in (0, 5, 9)
    ]
    session.createDataFrame(data, "value string").write.parquet(str(folder))
    limits = session.createDataFrame([(None, None, 40.0, 300.0, "104", "hot")], schemas.ALERT_LIMITS)
    stream = stream_folder(session, str(folder), "value string")
    out = str(tmp_path / "alerts")
    jobs = sensor_alerts.job(
        stream, limits, str(tmp_path / "check"),
        lambda w: runner.to_files(w, out), console=True, drain=True,
    )
    assert len(jobs) == 2
    for query in [j.start() for j in jobs]:
        runner.finish(query)
    sent = session.read.parquet(out)
    assert sent.count() == 4 and sent.columns == ["key", "value"]
    first = json.loads(sent.first()["value"])
    assert set(first) == {"window", "avg_temp", "avg_humidity", "code", "message", "alert_time"}


def test_trade_jobs_route_and_summarise(session, tmp_path):
    wire = [
        (json.dumps({"e": "trade", "s": s, "t": i, "p": str(i), "q": "1", "T": 1704067200000 + i}),)
        for i, s in enumerate(["BTC", "BTC", "ETH", None])
    ]
    session.createDataFrame(wire, "value string").write.parquet(str(tmp_path / "raw"))
    raw = stream_folder(session, str(tmp_path / "raw"), "value string")
    topics = str(tmp_path / "topics")
    runner.finish(
        trades.routing_job(
            raw, str(tmp_path / "c1"), lambda w: runner.to_files(w, topics, "topic"), drain=True
        ).start()
    )
    routed = session.read.parquet(topics)
    assert rows(routed.groupBy("topic").count()) == [("topic_BTC", 2), ("topic_ETH", 1)]
    btc = stream_folder(session, f"{topics}/topic=topic_BTC", schemas.ENVELOPE)
    stats = str(tmp_path / "stats")
    (job,) = trades.statistics_job(
        btc, str(tmp_path / "c2"),
        lambda w: runner.to_batches(w, sinks.batch_folders(stats)), drain=True,
    )
    runner.finish(job.start())
    values = [json.loads(r["value"]) for r in session.read.parquet(stats).collect()]
    assert {(v["trade_count"], v["avg_price"], v["total_volume"]) for v in values} == {(2, 0.5, 2.0)}


def test_all_queries_stop_when_one_fails(session, tmp_path):
    folder = tmp_path / "in"
    put(session, folder, 0, (0, 0, 5))
    stream = stream_folder(session, f"{folder}/*", READING, "*.json", "json")

    def broken(batch, number):
        raise RuntimeError("sink is down")

    good = runner.to_console(runner.writer(stream, str(tmp_path / "a"), every="1 second"), 1)
    bad = runner.to_batches(runner.writer(stream, str(tmp_path / "b")), broken)
    with pytest.raises(Exception, match="sink is down"):
        runner.run_until_one_ends(session, [good, bad])
    assert session.streams.active == []


def test_a_stream_is_not_broadcast_to_its_lookup_table(spark, tmp_path):
    """Plans of the micro-batches: the table is broadcast while small, the rows never are."""
    from tidemark.operators.joins import lookup_join

    spark.range(1000).selectExpr("id % 3 AS k", "id AS n").write.parquet(str(tmp_path / "in"))
    many = spark.range(50_000).selectExpr("id % 3 AS k", "cast(id AS string) AS t")
    many.write.parquet(str(tmp_path / "table"))  # few rows from a file larger than the stream's
    table = spark.read.parquet(str(tmp_path / "table")).groupBy("k").agg(F.max("t").alias("t"))
    stream = spark.readStream.schema("k long, n long").parquet(str(tmp_path / "in"))
    out = lookup_join(stream, table, "k").writeStream.format("parquet").trigger(availableNow=True)
    query = out.option("checkpointLocation", str(tmp_path / "check")).start(str(tmp_path / "out"))
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    assert "BuildRight" in text and "BuildLeft" not in text and "SortMergeJoin" not in text
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.where("t IN ('9999', '49999', '9998', '9997')").count() == got.count() == 1000
