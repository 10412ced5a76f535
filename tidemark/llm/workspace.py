"""Tables between the steps of an operator, in the folder that all executors share.

Lineage is cut by written tables, so a lost executor repeats one step at most. The folder of
a run is removed but for the result once the result is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch

#: Bytes of text that one block holds on average. A block is the unit of work of the
#: operators that send something back to the texts; it must fit into one task.
BLOCK_BYTES = 4 << 20

#: Buckets of one table, the most that Spark allows as it is set up. Beyond them a bucket
#: holds several keys, sorted apart by the grouping.
MOST_BUCKETS = 100_000


class Workspace:
    """One run's tables below the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch(spark, name)
        self.tables: list[str] = []

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        """Writes the rows and reads them back."""
        path = f"{self.root}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def bucketed(self, frame: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
        """As ``keep``, laid out by ``key``: grouping by it later needs no shuffle."""
        buckets = min(buckets, MOST_BUCKETS)
        table = f"tidemark_{name}_{uuid.uuid4().hex}"
        (
            frame.repartition(buckets, key)
            .write.bucketBy(buckets, key)
            .option("path", f"{self.root}/{name}")
            .format("parquet")
            .saveAsTable(table)
        )
        self.tables.append(table)
        self.drop_shuffles()
        return self.spark.table(table)

    def drop_shuffles(self) -> None:
        """The shuffle files of a plan go once the driver has collected the plan itself."""
        self.spark.sparkContext._jvm.System.gc()

    def remove(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        system.delete(path, True)

    def finish(self, frame: DataFrame) -> DataFrame:
        """Writes the result, removes every other table of the run."""
        result = self.keep(frame, "result")
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in system.listStatus(path):
            if status.getPath().getName() != "result":
                system.delete(status.getPath(), True)
        return result


def block_count(texts: DataFrame, text: str, block_bytes: int) -> int:
    """Blocks that the texts need; one row comes to the driver."""
    size = F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 32)
    total = texts.agg(size.alias("n")).first()["n"] or 0
    return max(1, -(-int(total) // block_bytes))


def blocked(
    work: Workspace,
    documents: DataFrame,
    key: str,
    text: str,
    block_bytes: int = BLOCK_BYTES,
    extra: tuple[str, ...] = (),
) -> tuple[DataFrame, int]:
    """(block, id, text, extra columns) laid out by block, by a hash of id and text."""
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"), *extra)
    count = block_count(rows, "text", block_bytes)
    block = F.pmod(F.xxhash64("id", "text"), F.lit(count)).cast("int")
    rows = rows.withColumn("block", block)
    return work.bucketed(rows, "block", count, "blocks"), count
