"""The corpus pipeline: operators of ``tidemark.llm`` as stages, one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. doc_id is the key of ``documents``; rows that share
one are taken for one document where documents are chosen. All stages but the last return the
columns of ``documents``. A null or empty text passes every stage until the packing, where it
is one piece of its end alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import crf, nbsvm, packing, shingles, suffixes
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.registry import query, table
from tidemark.llm.workspace import Workspace

__all__ = ["ORACLES", "ORACLE_SQL", "QUERIES", "STAGES", "run"]

#: Least chance of being good that a document is kept for.
LEAST_CHANCE = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, learnt from all labelled documents; rejected documents go."""
    model = nbsvm.fit(docs, table(spark, sf_dir, "labels"), F.lit(False))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")  # keeps a column named score
    return nbsvm.score(rows, model).where(F.col("score") >= LEAST_CHANCE).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join; the document of the smallest key stays of each class."""
    classes = shingles.join(docs)
    first = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.select(F.col("doc_id").alias("kept")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["kept"]), "left_semi")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup; later copies of 100 bytes go, and characters that a cut parts.
    Documents of which nothing is left go."""
    rest = F.struct(*(c for c in docs.columns if c not in ("doc_id", "text"))).alias("_rest")
    cut = suffixes.remove_repeats(docs.select("doc_id", "text", rest), columns=("_rest",))
    text = F.when(F.size("spans") > 0, whole_characters(F.col("kept"))).otherwise(
        F.decode("kept", "utf-8")
    )
    cut = cut.where((F.col("n_bytes") == 0) | (F.octet_length("kept") > 0))
    cut = cut.select("doc_id", text.alias("text"), "_rest")
    given = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return cut.select(*(given.get(c, F.col("_rest")[c]).alias(c) for c in docs.columns))


def whole_characters(kept):
    """Text of bytes in which a cut may have parted characters; the parts are left out, as are
    replacement characters."""
    return F.replace(F.make_valid_utf8(kept.cast("string")), F.lit("\ufffd"), F.lit(""))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII; every span is replaced by its kind."""
    field = crf.fit(crf.labelled_windows(docs))
    hidden = crf.redact(docs, field)
    return hidden.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing into sequences of 2048 tokens; one row per piece."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("suffix-array dedup", cut_repeats),
    ("PII", hide_personal_data),
    ("packing", pack),
]

#: No stage but the join can be said in SQL; tests/llm/test_pipeline.py holds it against plain code.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``. Tables of stages that are done, or that a failure
    leaves behind, are removed."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    held = None
    try:
        for place, (_, stage) in enumerate(STAGES):
            docs = work.keep(stage(spark, docs, sf_dir), f"stage-{place}")
            if held is not None:
                work.remove(held)
            held = f"stage-{place}"
    except BaseException:
        if held is not None:
            work.remove(held)
        raise
    return docs
