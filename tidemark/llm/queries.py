"""The dealt operators with production parameters over their whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import (
    bm25, bpe, chat, crf, ctw, nbsvm, packing, periods, prefixes, resample, rules, shingles, suffixes,
)
from tidemark.llm.registry import ORACLES, QUERIES, query, remainder_is_zero, table

__all__ = ["ORACLES", "QUERIES"]


@query("op1_ctw_score")
def op1_ctw_score(spark, folder):
    documents = table(spark, folder, "documents")
    return ctw.score(documents, remainder_is_zero("doc_id", 10))


@query("op10_byte_bpe")
def op10_byte_bpe(spark, folder):
    documents = table(spark, folder, "documents")
    return bpe.encode(documents, bpe.default_vocabulary(), digest_only=True)


@query("op4_nnls_packing")
def op4_nnls_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), packing.default_tokenizer())


@query("op3_bwt_dedup")
def op3_bwt_dedup(spark, folder):
    cut = suffixes.remove_repeats(table(spark, folder, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op7_signature_tree_join")
def op7_signature_tree_join(spark, folder):
    return shingles.join(table(spark, folder, "documents"))


@query("op5_chat_format")
def op5_chat_format(spark, folder):
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    formatted = chat.format_turns(given.unionByName(odd)).select(
        "conv_id", "n_blocks", "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


QUALITY_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), runs AS (
  SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM runs) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n
  FROM again, (VALUES (0), (1), (2)) AS v(j) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, t, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)
), b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR 100 * n_symbols > 20 * n_words
            OR (100 * n_dup_lines > 50 * n_lines AND n_dup_lines > 4)
            OR word_chars > 30 * n_words
            OR 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 60 * word_chars
            OR 100 * (length(t) - length(regexp_replace(t, '[!?]', '', 'g'))) > 80 * n_words) AS kept
FROM b
"""


@query("op9_quality_cascade", QUALITY_SQL)
def op9_quality_cascade(spark, folder):
    judged = rules.judge(table(spark, folder, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "kept",
    )


DOCUMENT_SEARCH_SQL = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term
  FROM documents
), q AS (
  SELECT doc_id AS query_id, term, count(*) AS qn FROM w WHERE doc_id % 20 = 0 GROUP BY ALL
), l AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
s AS (SELECT (SELECT count(*) FROM documents) AS docs,
             (SELECT count(*) FROM w) * 1.0 / (SELECT count(*) FROM documents) AS mean),
p AS (SELECT doc_id, term, count(*) AS tf FROM w
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
d AS (SELECT term, count(*) AS df FROM p GROUP BY term),
scored AS (
  SELECT query_id, doc_id,
         round(sum(qn * ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2
                   / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 9) AS score
  FROM q JOIN p USING (term) JOIN d USING (term) JOIN l USING (doc_id), s GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored
)
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10
"""


@query("op2_document_search", DOCUMENT_SEARCH_SQL)
def op2_document_search(spark, folder):
    documents = table(spark, folder, "documents")
    asked = documents.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    found = bm25.search(documents, asked, query_key="query_id")
    return found.withColumn("score", F.round("score", 6))


SEARCH_SQL = r"""
WITH q AS (
  SELECT item_id, term, count(*) AS qn FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term
    FROM benchmark WHERE item_id % 20 = 0) GROUP BY ALL
), w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term
  FROM documents
), l AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
s AS (SELECT (SELECT count(*) FROM documents) AS docs,
             (SELECT count(*) FROM w) * 1.0 / (SELECT count(*) FROM documents) AS mean),
p AS (SELECT doc_id, term, count(*) AS tf FROM w
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
d AS (SELECT term, count(*) AS df FROM p GROUP BY term),
scored AS (
  SELECT item_id, doc_id,
         round(sum(qn * ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2
                   / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS score
  FROM q JOIN p USING (term) JOIN d USING (term) JOIN l USING (doc_id), s GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op2_block_max_search", SEARCH_SQL)
def op2_block_max_search(spark, folder):
    asked = table(spark, folder, "benchmark").where("item_id % 20 = 0")
    found = bm25.search(table(spark, folder, "documents"), asked)
    return found.withColumn("score", F.round("score", 6))


@query("op6_nb_svm_quality")
def op6_nb_svm_quality(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder_is_zero("doc_id", 5), F.lit(False))
    model = nbsvm.fit(documents, table(spark, folder, "labels"), held_out)
    return nbsvm.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op8_crf_pii")
def op8_crf_pii(spark, folder):
    documents = table(spark, folder, "documents")
    field = crf.fit(crf.labelled_windows(documents))
    found = crf.find(documents, field)
    base = F.filter("spans", lambda s: s["base"])
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return found.select(
        "doc_id",
        *(
            F.size(F.array_remove(F.transform(base, lambda s: s["kind"] != kind), True))
            .cast("long").alias(f"n_{kind}")
            for kind in crf.KINDS
        ),
        F.sha2(F.array_join(F.transform(base, as_text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", as_text), ",").alias("spans"),
    )


@query("op13_prefix_token_counts")
def op13_prefix_token_counts(spark, folder):
    return prefixes.count(table(spark, folder, "documents"), prefixes.default_model())


def with_planted_periods(documents):
    """Every tenth document, by crc32 of its key, repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def turned(words):
        n = F.size(words)
        a = g % n
        return periods.with_period(words, a, 1 + F.floor((n - a) / (3 + g % 8)))

    words = rules.words_of(F.col("text"))
    planted = (h % 10 == 0) & (F.size(words) > 0)
    text = F.when(planted, rules.let(words, turned)).otherwise(F.col("text"))
    return documents.select("doc_id", text.alias("text"))


@query("op12_importance_resampling")
def op12_importance_resampling(spark, folder):
    return resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, folder):
    found = periods.find(with_planted_periods(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
