"""Measured sizes. A side is broadcast only when its rows and bytes are known to be small."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024

# A key with more rows than this is spread over this many tasks.
HOT_ROWS = 5_000_000
SALTS = 32

_TEXT = (T.StringType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(
        self, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
    ) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _TEXT):
        return F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(16)
    if isinstance(field.dataType, _NESTED):
        return F.coalesce(F.length(F.to_json(F.struct(column))), F.lit(0)) + F.lit(32)
    return F.lit(8)


def size_columns(frame: DataFrame) -> list[Column]:
    """Aggregates rows and bytes of a table."""
    width = F.lit(16)
    for field in frame.schema.fields:
        width = width + _width(field)
    return [
        F.count("*").alias("rows"),
        F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes"),
    ]


def measure(frame: DataFrame) -> Size:
    """Rows and bytes of a table in one distributed pass; one row reaches the driver."""
    row = frame.agg(*size_columns(frame)).first()
    return Size(row["rows"], row["bytes"])
