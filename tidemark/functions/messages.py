"""JSON messages: key and value as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def random_key() -> Column:
    return F.expr("uuid()")


def encode(
    frame: DataFrame, key: Column | None = None, fields: Sequence[str] | None = None
) -> DataFrame:
    """Rows to (key, value); value is a JSON object without the null fields."""
    body = F.struct(*(fields or frame.columns))
    return frame.select(
        (random_key() if key is None else key.cast("string")).alias("key"),
        F.to_json(body).alias("value"),
    )


def decode(frame: DataFrame, schema: str, value: str | Column = "value") -> DataFrame:
    """Message text to the fields of ``schema``.

    A field of the wrong type becomes null, text that is no JSON gives a row of nulls.
    """
    text = F.col(value) if isinstance(value, str) else value
    return unpack(frame, F.from_json(text.cast("string"), schema))


def decode_keyed(frame: DataFrame, schema: str) -> DataFrame:
    """Key and fields of messages whose key is JSON too, such as a quoted id.

    A key that is no JSON stays as it is.
    """
    key = F.col("key").cast("string")
    data = F.from_json(F.col("value").cast("string"), schema)
    rows = frame.select(F.coalesce(inner_json(key), key).alias("key"), data.alias("data"))
    return rows.select("key", F.inline(F.array("data")))


def unpack(frame: DataFrame, data: Column) -> DataFrame:
    """The fields of a struct as columns, the struct being computed once per row.

    As a plain projection, every later filter on a field would parse the text again.
    """
    return frame.select(F.inline(F.array(data)))


def strip_escapes(text: Column) -> Column:
    """Undo double encoding by dropping every backslash and one quote at each end.

    Values that hold escaped characters lose them; ``inner_json`` keeps them.
    """
    plain = F.regexp_replace(text, r"\\", "")
    return F.regexp_replace(plain, '^"|"$', "")


def inner_json(text: Column) -> Column:
    """Undo double encoding without loss: the text inside a JSON string."""
    return F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v")
