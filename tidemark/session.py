"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


PARTITION_BYTES = 256 * 1024 * 1024
MOST_PARTITIONS = 100_000
MOST_STATE_PARTITIONS = 1_000


def sized_for(input_bytes: int) -> dict[str, str]:
    """Settings for an amount of input: reads and shuffles in pieces of 256 MiB.

    Shuffles start with enough pieces for all of it and adaptive execution joins small
    ones. Beyond 100,000 pieces the bookkeeping costs more than larger pieces do.
    """
    pieces = min(max(-(-input_bytes // PARTITION_BYTES), 1), MOST_PARTITIONS)
    return {
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(pieces),
    }


def build_session(
    app: str, master: str | None = None, input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """A session with the package's settings; dotted names go in ``settings``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sizes = sized_for(input_bytes) if input_bytes else {}
    for name, value in {**SETTINGS, **sizes, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams; the caller's settings stay as they are.

    The number of state partitions is fixed by the first checkpoint. Unless given it
    follows the cluster's parallelism up to 1,000, since each one writes files for every
    micro-batch. State lives in RocksDB, off the heap.
    """
    sibling = spark.newSession()
    parallelism = min(spark.sparkContext.defaultParallelism, MOST_STATE_PARTITIONS)
    partitions = state_partitions or parallelism
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    sibling.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return sibling


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
