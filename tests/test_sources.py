"""Files, settings, connection options, report table."""

import datetime as dt

import pytest
from conftest import rows

from tidemark import schemas
from tidemark.config import BusSettings, DatabaseSettings, JobSettings
from tidemark.plans import medal_report, medallion
from tidemark.session import scratch, sized_for
from tidemark.sources import bus, files, jdbc


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_customers_csv(spark, tmp_path, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_customers(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def check_customers(spark, tmp_path):
    head = ",".join(f.split()[0] for f in schemas.CUSTOMER.split(", "))
    good = tmp_path / "good.csv"
    good.write_text(f"{head}\n1,Ann,,p,c,,active,2023-01-01,30,basic\n")
    row = files.read_customers(spark, str(good)).first()
    assert (row["email"], row["address"], row["age"]) == ("", "", 30)
    turned = tmp_path / "turned.csv"  # columns are taken by name
    turned.write_text(
        ",".join(reversed(head.split(","))) + "\nbasic,30,2023-01-01,active,,c,p,e,Ann,1\n"
    )
    row = files.read_customers(spark, str(turned)).first()
    assert (row["customer_id"], row["full_name"], row["age"]) == (1, "Ann", 30)
    for name, line in {
        "text": "x,Ann,e,p,c,a,active,2023-01-01,30,basic",
        "date": "1,Ann,e,p,c,a,active,soon,30,basic",
        "day": "1,Ann,e,p,c,a,active,2020-13-45,30,basic",
        "no-date": "1,Ann,e,p,c,a,active,,30,basic",
        "blank": "1,Ann,e,p,c,a,active,2023-01-01,,basic",
    }.items():
        bad = tmp_path / f"{name}.csv"
        bad.write_text(f"{head}\n{line}\n")
        with pytest.raises(Exception, match="cannot be"):
            files.read_customers(spark, str(bad)).collect()


def test_limits_csv(spark, tmp_path):
    path = tmp_path / "limits.csv"
    path.write_text(
        "id,humidity_min,humidity_max,temperature_min,temperature_max,code,message\n"
        "1,0,40,,,101,dry\n2,,,30,x,104,hot\n"
    )
    got = files.read_limits(spark, str(path))
    assert rows(got) == sorted(
        [(0.0, 40.0, None, None, "101", "dry"), (None, None, 30.0, None, "104", "hot")], key=repr
    )


def test_a_header_with_other_names_is_an_error(spark, tmp_path):
    path = tmp_path / "bio.csv"
    path.write_text("athlete_id,height,sex,weight,country_noc\n1,180,m,80,UKR\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(path), schemas.ATHLETE_BIO).collect()


def test_written_layers_are_checked(spark, tmp_path):
    path = str(tmp_path / "t")
    back = files.write_checked(spark.range(10).toDF("n"), path)
    assert back.count() == 10
    files.write_checked(spark.range(3).toDF("n"), path)  # overwrites
    assert spark.read.parquet(path).count() == 3


def test_medallion_from_csv(spark, tmp_path):
    (tmp_path / "bio.csv").write_text(
        "athlete_id,sex,height,weight,country_noc\n1,Male,180,80,UKR\n1,male ,180,80,UKR\n"
        "2,Female,170,,POL\n"
    )
    (tmp_path / "results.csv").write_text(
        "athlete_id,sport,medal,country_noc\n1,Judo,Gold,UKR\n1,Judo,,UKR\n2,Judo,Gold,POL\n"
        "9,Judo,Gold,POL\n"
    )
    landing = {
        "athlete_bio": str(tmp_path / "bio.csv"),
        "athlete_event_results": str(tmp_path / "results.csv"),
    }
    got = medallion.run(spark, landing, str(tmp_path / "lake"), as_of="2024-01-01 00:00:00")
    at = dt.datetime(2024, 1, 1)
    assert rows(got) == sorted(
        [
            ("judo", "gold", "male", "ukr", 180.0, 80.0, at),
            ("judo", None, "male", "ukr", 180.0, 80.0, at),
            ("judo", "gold", "female", "pol", 170.0, None, at),
        ],
        key=repr,
    )


def test_report_table(spark):
    medals = spark.createDataFrame([("Gold",), ("Silver",)], "medal string")
    medal_report.create_log(spark, "medal_log")
    medal_report.create_log(spark, "medal_log")
    at = dt.datetime(2024, 1, 1, 12)
    assert not medal_report.is_fresh(spark, "medal_log", at)
    medal_report.append_counts(spark, "medal_log", medals, "medal", at)
    medal_report.append_counts(spark, "medal_log", medals, "medal", at)  # repeated run
    medal_report.append_counts(spark, "medal_log", medals, "medal", at + dt.timedelta(minutes=1))
    assert rows(spark.table("medal_log"), "id", "value") == [
        (2, "Silver"), (3, "Gold"), (5, "Silver"), (6, "Gold"),
    ]
    assert medal_report.is_fresh(spark, "medal_log", at + dt.timedelta(seconds=80))
    assert not medal_report.is_fresh(spark, "medal_log", at + dt.timedelta(seconds=90))
    spark.sql("DROP TABLE medal_log")


def test_settings_have_no_default_secrets(tmp_path):
    env = {
        "TIDEMARK_BUS_SERVERS": "broker:9092",
        "TIDEMARK_BUS_USERNAME": "u",
        "TIDEMARK_BUS_PASSWORD": "secret",
        "TIDEMARK_BUS_OFFSETS_PER_TRIGGER": "50",
        "TIDEMARK_TOPICS_RAW": "raw",
        "OTHER": "x",
    }
    settings = JobSettings.from_env(env)
    assert settings.bus.offsets_per_trigger == 50 and settings.topics == {"raw": "raw"}
    assert settings.database is None and "secret" not in repr(settings)
    assert BusSettings.of({"servers": ["a:1", "b:2"]}).servers == "a:1,b:2"
    assert BusSettings.of({"servers": "a"}).password is None
    with pytest.raises(KeyError):
        BusSettings.of({})
    with pytest.raises(KeyError):
        DatabaseSettings.of({"url": "jdbc:x"})
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "job.yaml"
    path.write_text(yaml.safe_dump({"bus": {"servers": ["a", "b"]}, "topics": {"raw": "r"}}))
    assert JobSettings.from_yaml(str(path)).bus.servers == "a,b"


def test_bus_options():
    settings = BusSettings(servers="b:1", username="u", password="p", offsets_per_trigger=500)
    options = bus.source_options(settings, "t", "earliest")
    assert options["subscribe"] == "t" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "500" and options["failOnDataLoss"] == "false"
    assert 'username="u"' in options["kafka.sasl.jaas.config"]
    assert "kafka.sasl.jaas.config" not in bus.connection(BusSettings(servers="b:1"))
    with pytest.raises(ValueError):
        bus.source_options(settings, "t", "middle")


class Options(dict):
    """Records reader options."""

    def option(self, name, value):
        self[name] = value
        return self


def test_jdbc_options():
    settings = DatabaseSettings(url="jdbc:x", driver="d", user="u", password="p")
    assert jdbc.connection(settings) == {"url": "jdbc:x", "driver": "d", "user": "u", "password": "p"}
    assert jdbc.batch_query("t", 7) == "select * from t where batch_id = 7"
    got = jdbc.split(Options(), "id", 1, 99, 8)
    assert got == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "99", "numPartitions": 8}


def test_partitions_follow_the_input():
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sized_for(1)[name] == "1"
    assert sized_for(2**40)[name] == "4096"
    assert sized_for(100 * 2**40)[name] == "100000"


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch(spark, "x") != scratch(spark, "x")
