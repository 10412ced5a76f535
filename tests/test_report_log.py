"""The report log takes single values of one time, and earlier times."""

import datetime as dt
import uuid

from tidemark.plans import medal_report


def test_values_of_one_time_and_a_backfill(spark):
    table = f"report_{uuid.uuid4().hex}"
    medal_report.create_log(spark, table)
    frame = spark.createDataFrame([("Bronze",), ("Silver",), ("Silver",)], "medal string")
    late, early = dt.datetime(2024, 5, 2, 9), dt.datetime(2024, 5, 1, 9)
    for time, value in ((late, "Bronze"), (late, "Silver"), (late, "Silver"), (early, "Bronze"), (early, "Silver")):
        medal_report.append_counts(spark, table, frame, "medal", time, [value])
    rows = spark.table(table).orderBy("id").collect()
    assert [(r.value, r["count"], r.created_at) for r in rows] == [
        ("Bronze", 1, late), ("Silver", 2, late), ("Bronze", 1, early), ("Silver", 2, early),
    ]
    assert [r.id for r in rows] == [1, 2, 3, 4]
    spark.sql(f"DROP TABLE {table}")
