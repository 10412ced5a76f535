"""CSV and parquet tables, layer writes with a check, and file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.text import blank_to_empty


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, infer: bool = False
) -> DataFrame:
    """CSV with a header.

    With a schema the file is read once, and a header with other names is an error; with
    ``infer`` Spark reads it a first time for the types; with neither all is text.
    """
    reader = spark.read.option("header", True)
    if schema:
        return reader.schema(schema).option("enforceSchema", False).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """A customer snapshot, its columns taken by name.

    A missing or malformed number or date ends the load, whether ANSI is on or off; an
    empty text cell is an empty string.
    """
    raw = read_csv(spark, path)
    columns = []
    for field in T.StructType.fromDDL(schemas.CUSTOMER):
        text = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            column = blank_to_empty(text)
        else:
            told = F.concat(F.lit(f"{field.name} cannot be "), F.coalesce(text, F.lit("missing")))
            failed = F.raise_error(told).cast(field.dataType)
            column = F.coalesce(text.try_cast(field.dataType), failed)
        columns.append(column.alias(field.name))
    return raw.select(*columns)


def read_limits(spark: SparkSession, path: str) -> DataFrame:
    """Alert limits: text on arrival, numbers where they are numbers, blank means unused."""
    wanted = T.StructType.fromDDL(schemas.ALERT_LIMITS)
    raw = read_csv(spark, path)
    return raw.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_checked(frame: DataFrame, path: str) -> DataFrame:
    """Overwrite a layer's table and read it back.

    The rows are counted while they are written; a read-back with another count or other
    columns is an error. Nothing is computed twice.
    """
    seen = Observation()
    frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    back = frame.sparkSession.read.parquet(path)
    shape = [(f.name, f.dataType) for f in frame.schema.fields]
    if shape != [(f.name, f.dataType) for f in back.schema.fields]:
        raise RuntimeError(f"{path} was read back with other columns")
    rows = back.count()
    if rows != seen.get["rows"]:
        raise RuntimeError(f"{path} holds {rows} rows, {seen.get['rows']} were written")
    return back


def stream_folder(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    name: str = "*.parquet",
    kind: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream over the files of a folder; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(kind).option("pathGlobFilter", name)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)
