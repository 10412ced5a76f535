"""Quality rules as a cascade that stops at the first rejection, by Spark expressions only.

On a sample of rows each rule's cost (seconds, with the counts that it goes by) and selectivity
(share of rows it rejects) are measured; rules then stand in order of rejection per cost. The
order changes how much work is done and never the verdict, since a row is kept only if no rule
rejects it.

The sample is a written table of the rows with the least hashes of their keys, cut ahead of all
measures. A rule is timed on the sample repeated many times over, less the time of the same
job without a rule, so that starting a job counts for nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.workspace import Workspace

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: Rows of the sample that the order of the rules is chosen on, and how often they are repeated
#: to time a rule.
SAMPLE_ROWS = 2_000
SAMPLE_PARTS = 8
REPEATS = 2

#: Columns that rules may go by, beside ``text``.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` must be a boolean column over ``text`` and the measures that the rule
    ``needs``; null counts as false."""

    name: str
    rejects: Column
    needs: tuple[str, ...] = MEASURES


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def repeated_words(words: Column) -> Column:
    """Words within runs of three words that occur twice or more in the text."""

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def places(keyed: Column) -> Column:
        again = F.transform(
            keyed,
            lambda x, i: F.when(
                (F.get(keyed, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(keyed, F.greatest(i - 1, F.lit(0)))["h"] == x["h"])),
                x["i"],
            ),
        )
        return F.sort_array(F.filter(again, lambda i: i.isNotNull()))

    def of_hashes(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(
            F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)
        ).otherwise(let(let(keyed, places), covered))

    def of_words(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(runs, of_hashes))

    return let(words, of_words)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def measures(text: Column) -> Column:
    """Struct of the counts that the rules go by."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(
                F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")
            )).alias("lines"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    return let(words_of(text), of_words)


def measure(name: str) -> Column:
    """One measure of the column ``text`` alone."""
    words, lines = words_of(F.col("text")), F.filter(
        F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )
    if name == "n_words":
        value = F.size(words)
    elif name == "word_chars":
        value = F.char_length(F.array_join(words, ""))
    elif name == "n_symbols":
        value = F.regexp_count("text", F.lit(SYMBOLS))
    elif name == "n_lines":
        value = F.size(lines)
    elif name == "n_dup_lines":
        value = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    else:
        value = repeated_words(words)
    return value.cast("long").alias(name)


def measured(documents: DataFrame, key: str, text: str) -> DataFrame:
    rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("m", measures(F.col("text")))
    return rows.select(
        "key", "text", "m.n_words", "m.word_chars", "m.n_symbols",
        F.col("m.lines.n").cast("long").alias("n_lines"),
        F.col("m.lines.again").cast("long").alias("n_dup_lines"), "m.n_repeat_words",
    )


def base_rules() -> list[Rule]:
    return [
        Rule("few words", F.col("n_words") < 50, ("n_words",)),
        Rule("repeated words", 100 * F.col("n_repeat_words") > 50 * F.col("n_words"), ("n_words", "n_repeat_words")),
    ]


def default_rules() -> list[Rule]:
    """Limits that prose stays well below."""
    capitals = F.regexp_count("text", F.lit("[A-Z]"))
    marks = F.regexp_count("text", F.lit("[!?]"))
    lines = (100 * F.col("n_dup_lines") > 50 * F.col("n_lines")) & (F.col("n_dup_lines") > 4)
    return [
        *base_rules(),
        Rule("symbols", 100 * F.col("n_symbols") > 20 * F.col("n_words"), ("n_words", "n_symbols")),
        Rule("repeated lines", lines, ("n_lines", "n_dup_lines")),
        Rule("word length", F.col("word_chars") > 30 * F.col("n_words"), ("n_words", "word_chars")),
        Rule("capitals", 100 * capitals > 60 * F.col("word_chars"), ("word_chars",)),
        Rule("calls", 100 * marks > 80 * F.col("n_words"), ("n_words",)),
    ]


def sampled(documents: DataFrame, key: str, text: str, rows: int) -> DataFrame:
    """At most ``rows`` texts, those of the least hashes of key and text. A filter whose
    share follows the number of rows leaves few to sort."""
    total = max(1, documents.count())
    name = F.xxhash64(F.col(key), F.col(text))
    share = min(1.0, 4.0 * rows / total + 200 / total)
    some = documents.select(F.coalesce(F.col(text), F.lit("")).alias("text"), name.alias("h"))
    if share < 1:
        some = some.where(F.pmod("h", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    some = some.orderBy(F.pmod("h", F.lit(1 << 30)), "h").limit(rows).select("text")
    return some.repartition(SAMPLE_PARTS)


def ordered(sample: DataFrame, rules: list[Rule], repeats: int = REPEATS) -> list[Rule]:
    """The rules by rejection per cost on a sample, which has the columns of the rules or else
    the texts; one row per rule comes to the driver."""
    if len(rules) < 2:
        return list(rules)
    again = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("_again"))
    if "text" in sample.columns:  # those that a rule does not go by are pruned
        again = again.select("*", *(measure(n) for n in MEASURES if n not in sample.columns))

    def timed(rejects: Column) -> tuple[int, int, float]:
        counts = again.agg(F.sum(F.coalesce(rejects, F.lit(False)).cast("int")).alias("n"), F.count("*").alias("all"))
        counts.first()  # compiled and read once
        begin = time.perf_counter()
        seen = counts.first()
        return seen["n"] or 0, max(1, seen["all"]), time.perf_counter() - begin

    _, _, idle = timed(F.col("_again") < 0)
    standing = []
    for place, rule in enumerate(rules):
        rejected, total, took = timed(rule.rejects)
        standing.append((-(rejected / total) / max(took - idle, 1e-3), place))
    return [rules[place] for _, place in sorted(standing)]


def first_rejection(rules: list[Rule]) -> Column:
    """Name of the first rule in order that rejects a row, null if none; later rules are not
    worked out for it."""
    if not rules:
        return F.lit(None).cast("string")
    out = F
    for rule in rules:
        out = out.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name))
    return out


def cascade(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rejected_by. A measure is worked out by the first rule that needs it, and only for
    rows that no earlier rule has rejected."""
    known: set[str] = set()
    rows = rows.withColumn("rejected_by", F.lit(None).cast("string"))
    still = F.col("rejected_by").isNull()
    for rule in rules:
        fresh = [n for n in rule.needs if n not in known]
        known.update(fresh)
        rows = rows.withColumns({n: F.when(still, measure(n)) for n in fresh})
        hit = still & F.coalesce(rule.rejects, F.lit(False))
        rows = rows.withColumn("rejected_by", F.when(hit, F.lit(rule.name)).otherwise(F.col("rejected_by")))
    return rows.drop(*known)


def judge(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rules: list[Rule] | None = None,
    sample_rows: int = SAMPLE_ROWS,
    with_measures: bool = True,
) -> DataFrame:
    """One row per document: ``key``, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, rejected_by (a rule that rejects it, null if none) and kept.

    Without ``with_measures`` the measures are left out of the result and worked out only as far
    as the cascade goes for a row; with them each row has all of them, and the rules are judged
    in their order on top.

    Null texts count as empty: no words, no lines. Repeated rows are judged each, a null key is
    kept, an empty table gives no rows. Extra columns are not read. Which of several rejecting
    rules is named depends on the measured order; ``kept`` does not.
    """
    rules = default_rules() if rules is None else rules
    work = Workspace(documents.sparkSession, "rules")
    sample = work.keep(sampled(documents, key, text, sample_rows), "sample")
    try:
        chosen = ordered(sample, rules)
    finally:
        work.remove("sample")
    if with_measures:
        rows = measured(documents, key, text)
        judged = rows.withColumn("rejected_by", first_rejection(chosen))
    else:
        rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        judged = cascade(rows, chosen)
    counts = MEASURES if with_measures else ()
    return judged.select(
        F.col("key").alias(key), *counts, "rejected_by", F.col("rejected_by").isNull().alias("kept")
    )
