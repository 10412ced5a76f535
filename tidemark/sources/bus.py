"""Messages on a Kafka bus: (key, value) rows, in batch and as a stream.

Needs Spark's Kafka connector on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidemark.config import BusSettings

LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def connection(settings: BusSettings) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": settings.servers}
    if settings.username:
        options["kafka.security.protocol"] = settings.protocol
        options["kafka.sasl.mechanism"] = settings.mechanism
        options["kafka.sasl.jaas.config"] = (
            f'{LOGIN_MODULE} required username="{settings.username}" '
            f'password="{settings.password}";'
        )
    return options


def source_options(
    settings: BusSettings, topic: str, start: str = "latest"
) -> dict[str, str]:
    """Options of a stream source; ``start`` is ``earliest`` to replay the topic."""
    if start not in ("earliest", "latest"):
        raise ValueError("start is earliest or latest")
    return {
        **connection(settings),
        "subscribe": topic,
        "startingOffsets": start,
        "maxOffsetsPerTrigger": str(settings.offsets_per_trigger),
        "failOnDataLoss": "false",
    }


def read_stream(
    spark: SparkSession, settings: BusSettings, topic: str, start: str = "latest"
) -> DataFrame:
    options = source_options(settings, topic, start)
    return spark.readStream.format("kafka").options(**options).load()


def read_batch(spark: SparkSession, settings: BusSettings, topic: str) -> DataFrame:
    """The whole topic as a table."""
    reader = spark.read.format("kafka").options(**connection(settings))
    return reader.option("subscribe", topic).option("startingOffsets", "earliest").load()


def write_batch(messages: DataFrame, settings: BusSettings, topic: str | None = None) -> None:
    """(key, value) rows to ``topic``, or each to the topic in its ``topic`` column."""
    writer = messages.write.format("kafka").options(**connection(settings))
    if topic:
        writer = writer.option("topic", topic)
    writer.save()


def write_stream(
    messages: DataFrame, settings: BusSettings, topic: str | None = None
) -> DataStreamWriter:
    """A stream writer to the bus; it still needs a mode and a checkpoint."""
    writer = messages.writeStream.format("kafka").options(**connection(settings))
    return writer.option("topic", topic) if topic else writer
