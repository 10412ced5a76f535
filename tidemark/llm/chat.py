"""Conversations as training text, by Spark expressions only.

Turns are collected as structs, sorted, and neighbours of one role become one block:

    <|role|>user<|text|>first turn<|text|>second turn<|end|>

A mark starts with ``<|``. Texts and roles never do: where they hold ``<``, any number of
backslashes and ``|``, one backslash is put in, and taken out when reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_turns(
    turns: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learnt: str = ASSISTANT,
) -> DataFrame:
    """One row per conversation: ``key``, n_blocks, formatted and loss_spans (array of start
    and end in code points: each text of the role ``learnt``, in order).

    A null text or role counts as empty. Turns go by number, null first; turns of one number
    by role, then text, and repeated rows stay as repeated turns. Rows without a key are one
    conversation with a null key. An empty table gives no rows; other columns are not read.
    """
    rows = turns.select(
        F.col(key).alias("key"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("raw"),
    ).select("key", "turn", "role", escape(F.col("raw")).alias("text"), "raw")
    # where each text starts: what stands before it are whole pieces of earlier turns
    order = Window.partitionBy("key").orderBy("turn", "role", "raw")
    first = F.lag("role").over(order).isNull()
    begins = first | (F.lag("role").over(order) != F.col("role"))
    head = F.concat(
        F.when(first, F.lit("")).otherwise(F.lit(END)), F.lit(ROLE), escape(F.col("role")), F.lit(TEXT)
    )
    rows = rows.withColumn("begins", begins).withColumn(
        "head", F.when(F.col("begins"), head).otherwise(F.lit(TEXT))
    )
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("head") + F.char_length("text")
    rows = rows.withColumn("end", F.sum(size).over(upto))
    collected = rows.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "raw", "end", "begins", "text"))).alias("turns")
    )
    starts = F.filter(
        F.transform("turns", lambda t, i: F.when(t["begins"], i + 1)), lambda i: i.isNotNull()
    )
    collected = collected.select("key", "turns", starts.alias("starts"))

    def block(start: Column, i: Column) -> Column:
        after = F.coalesce(F.get("starts", i + 1), F.size("turns") + 1)
        texts = F.transform(F.slice("turns", start, after - start), lambda t: t["text"])
        name = escape(F.get("turns", start - 1)["role"])
        return F.concat(F.lit(ROLE), name, F.lit(TEXT), F.array_join(texts, TEXT), F.lit(END))

    own = F.filter("turns", lambda t: t["role"] == F.lit(learnt))
    span = lambda t: F.struct(
        (t["end"] - F.char_length(t["text"])).alias("start"), t["end"].alias("end")
    )
    return collected.select(
        F.col("key").alias(key),
        F.size("starts").cast("long").alias("n_blocks"),
        F.array_join(F.transform("starts", block), "").alias("formatted"),
        F.transform(own, span).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) that a formatted conversation holds."""
    blocks = F.slice(
        F.split(formatted, r"<\|end\|>\n"), 1, F.greatest(F.size(F.split(formatted, r"<\|end\|>\n")) - 1, F.lit(0))
    )

    def turns(block: Column) -> Column:
        parts = F.split(block, r"<\|text\|>")
        role = unescape(F.substring(F.get(parts, 0), len(ROLE) + 1, 1 << 30))
        return F.transform(
            F.slice(parts, 2, F.size(parts)),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
        "",
    )
