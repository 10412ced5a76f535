"""Queries on slowly changing dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import inputs
from tidemark.checks.registry import dates_as_text, query
from tidemark.constants import CUSTOMER_FIELDS, SIX_FIELDS
from tidemark.operators import graph, scd
from tidemark.plans import customer_history
from tidemark.session import scratch

FIRST_DAY = dt.date(2024, 1, 1)
DAY = dt.date(2024, 6, 1)
_DAY = "DATE '2024-06-01'"
_FIRST_DAY = "DATE '2024-01-01'"
THIRD_DAY = dt.date(2024, 7, 1)
_THIRD_DAY = "DATE '2024-07-01'"
_INPUTS = f"first_rows AS ({inputs.FIRST_SQL}), changes AS ({inputs.CHANGES_SQL})"
_SEVEN = (*SIX_FIELDS, "age")
_DATES = ("sign_up_date", "valid_from", "valid_to", "last_update_date")


def _text(fields) -> str:
    return ", ".join(f"CAST({f} AS VARCHAR) AS {f}" if f in _DATES else f for f in fields)


def _differ(fields, old: str = "o", new: str = "n") -> str:
    return "(" + " OR ".join(f"{old}.{f} IS DISTINCT FROM {new}.{f}" for f in fields) + ")"


def _fields(alias: str, **given: str) -> str:
    return ", ".join(f"{given.get(f, f'{alias}.{f}')} AS {f}" for f in CUSTOMER_FIELDS)


# --- first loads ------------------------------------------------------------------------


def _first_versions(start: str) -> str:
    return f"""
WITH first_rows AS ({inputs.FIRST_SQL}),
dim AS (SELECT *, {start} AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current
        FROM first_rows)
SELECT {_text(scd.VERSION_FIELDS)} FROM dim"""


@query("scd2_first_load", _first_versions("sign_up_date"))
def scd2_first_load(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded twice; the second load inserts nothing."""
    loaded = scd.type2_load(inputs.first_day(spark, folder), FIRST_DAY)
    return dates_as_text(scd.insert_if_absent(loaded, loaded))


@query("scd2_first_load_document", _first_versions(_FIRST_DAY))
def scd2_first_load_document(spark: SparkSession, folder: str) -> DataFrame:
    first = inputs.first_day(spark, folder)
    return dates_as_text(scd.type2_load(first, FIRST_DAY, scd.TYPE2_DOCUMENT))


@query(
    "scd3_first_load",
    f"""
WITH first_rows AS ({inputs.FIRST_SQL})
SELECT {_text(CUSTOMER_FIELDS)},
       {", ".join(f"CAST(NULL AS VARCHAR) AS previous_{f}" for f in SIX_FIELDS)},
       CAST(sign_up_date AS VARCHAR) AS last_update_date FROM first_rows""",
)
def scd3_first_load(spark: SparkSession, folder: str) -> DataFrame:
    first = inputs.first_day(spark, folder)
    return dates_as_text(scd.type3_load(first, scd.TYPE3_DOCUMENT))


@query(
    "scd4_first_load",
    f"""
WITH first_rows AS ({inputs.FIRST_SQL})
SELECT {_text(CUSTOMER_FIELDS)}, '2024-01-01' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to
FROM first_rows""",
)
def scd4_first_load(spark: SparkSession, folder: str) -> DataFrame:
    """The open history rows; the current rows are the snapshot itself."""
    return dates_as_text(scd.type4_load(inputs.first_day(spark, folder), FIRST_DAY)[1])


# --- type 2 -----------------------------------------------------------------------------


def _type2_with(tracked, keep_sign_up: bool, new_from: str, first_from: str) -> str:
    """CTEs ending in ``dim``: the dimension after both days."""
    sign_up = "o.sign_up_date" if keep_sign_up else "n.sign_up_date"
    return f"""
WITH {_INPUTS},
hit AS (SELECT o.customer_id FROM first_rows o JOIN changes n USING (customer_id)
        WHERE {_differ(tracked)}),
dim AS (
  SELECT {_fields("o")}, {first_from} AS valid_from, CAST(NULL AS DATE) AS valid_to,
         true AS is_current
  FROM first_rows o WHERE o.customer_id NOT IN (SELECT customer_id FROM hit)
  UNION ALL
  SELECT {_fields("o")}, {first_from}, {_DAY}, false
  FROM first_rows o JOIN hit USING (customer_id)
  UNION ALL
  SELECT {_fields("n", sign_up_date=sign_up)}, {_DAY}, NULL, true
  FROM changes n JOIN hit USING (customer_id) JOIN first_rows o USING (customer_id)
  UNION ALL
  SELECT {_fields("n")}, {new_from}, NULL, true
  FROM changes n WHERE n.customer_id NOT IN (SELECT customer_id FROM first_rows)
)"""


_RELATIONAL_WITH = _type2_with(("email", "city"), True, _DAY, "o.sign_up_date")
_DOCUMENT_WITH = _type2_with(SIX_FIELDS, False, _DAY, _FIRST_DAY)
_GRAPH_WITH = _type2_with(SIX_FIELDS, False, "n.sign_up_date", "o.sign_up_date")
_ALL_VERSIONS = f" SELECT {_text(scd.VERSION_FIELDS)} FROM dim"


def _type2(spark: SparkSession, folder: str, rules: scd.Type2Rules) -> DataFrame:
    loaded = scd.type2_load(inputs.first_day(spark, folder), FIRST_DAY, rules)
    return scd.type2_apply(loaded, inputs.changes(spark, folder), DAY, rules)


@query("scd2_relational", _RELATIONAL_WITH + _ALL_VERSIONS)
def scd2_relational(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_type2(spark, folder, scd.TYPE2_RELATIONAL))


@query("scd2_document", _DOCUMENT_WITH + _ALL_VERSIONS)
def scd2_document(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_type2(spark, folder, scd.TYPE2_DOCUMENT))


@query("scd2_graph", _GRAPH_WITH + _ALL_VERSIONS)
def scd2_graph(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_type2(spark, folder, scd.TYPE2_GRAPH))


@query("scd2_shuffled", _RELATIONAL_WITH + _ALL_VERSIONS)
def scd2_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The way for a batch of changes too large to broadcast."""
    loaded = scd.type2_load(inputs.first_day(spark, folder), FIRST_DAY)
    merged = scd.type2_apply(loaded, inputs.changes(spark, folder), DAY, max_rows=0)
    return dates_as_text(merged)


def _stored(spark, folder, rules=scd.TYPE2_RELATIONAL, days: int = 3):
    """The days' files through a dimension kept on files."""
    later = [(inputs.changes(spark, folder), DAY), (inputs.third_day(spark, folder), THIRD_DAY)]
    first = inputs.first_day(spark, folder)
    path = scratch(spark, "dimension")
    return customer_history.published(spark, path, first, later[: days - 1], FIRST_DAY, rules)


@query("scd2_published", _RELATIONAL_WITH + _ALL_VERSIONS)
def scd2_published(spark: SparkSession, folder: str) -> DataFrame:
    """Two days through a dimension kept on files."""
    return dates_as_text(_stored(spark, folder, days=2).read())


_THREE_DAYS_WITH = f"""{_RELATIONAL_WITH},
third AS ({inputs.THIRD_SQL}),
opened AS (SELECT * FROM dim WHERE is_current),
again AS (SELECT o.customer_id FROM opened o JOIN third n USING (customer_id)
          WHERE {_differ(("email", "city"))}),
dim3 AS (
  SELECT * FROM dim
  WHERE NOT is_current OR customer_id NOT IN (SELECT customer_id FROM again)
  UNION ALL
  SELECT {_fields("o")}, o.valid_from, {_THIRD_DAY}, false FROM opened o JOIN again USING (customer_id)
  UNION ALL
  SELECT {_fields("n", sign_up_date="o.sign_up_date")}, {_THIRD_DAY}, NULL, true
  FROM third n JOIN again USING (customer_id) JOIN opened o USING (customer_id)
  UNION ALL
  SELECT {_fields("n")}, {_THIRD_DAY}, NULL, true
  FROM third n WHERE n.customer_id NOT IN (SELECT customer_id FROM opened)
)"""


@query("scd2_three_days", _THREE_DAYS_WITH + f" SELECT {_text(scd.VERSION_FIELDS)} FROM dim3")
def scd2_three_days(spark: SparkSession, folder: str) -> DataFrame:
    """Three days, the last one read over a base and two sets of changes."""
    return dates_as_text(_stored(spark, folder).read())


@query(
    "scd_unique_versions",
    _THREE_DAYS_WITH
    + " SELECT customer_id, count(*) AS open_rows FROM dim3 WHERE is_current GROUP BY 1",
)
def scd_unique_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Open versions per key, from the index that every batch is checked against."""
    return _stored(spark, folder).open_rows_per_key()


@query(
    "scd2_as_of",
    _GRAPH_WITH
    + f""" SELECT {_text(scd.VERSION_FIELDS)} FROM dim
WHERE valid_from <= DATE '2024-05-15'
  AND (valid_to IS NULL OR valid_to > DATE '2024-05-15')""",
)
def scd2_as_of(spark: SparkSession, folder: str) -> DataFrame:
    versions = _type2(spark, folder, scd.TYPE2_GRAPH)
    return dates_as_text(scd.valid_on(versions, dt.date(2024, 5, 15)))


@query(
    "scd2_document_ids",
    _DOCUMENT_WITH
    + """ SELECT customer_id, customer_id || ':' || CAST(valid_from AS VARCHAR) AS _id,
       is_current FROM dim""",
)
def scd2_document_ids(spark: SparkSession, folder: str) -> DataFrame:
    versions = _type2(spark, folder, scd.TYPE2_DOCUMENT)
    named = scd.with_document_id(versions, "customer_id", "valid_from")
    return named.select("customer_id", "_id", "is_current")


# --- graph ------------------------------------------------------------------------------

_NODE = "'version:' || customer_id || ':' || CAST(valid_from AS VARCHAR)"


@query(
    "scd_graph_edges",
    _GRAPH_WITH + f" SELECT customer_id AS src, {_NODE} AS dst, 'HAS_VERSION' AS type FROM dim",
)
def scd_graph_edges(spark: SparkSession, folder: str) -> DataFrame:
    return graph.version_edges(_type2(spark, folder, scd.TYPE2_GRAPH))


@query("scd_graph_nodes", _GRAPH_WITH + " SELECT DISTINCT customer_id FROM dim")
def scd_graph_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return graph.main_nodes(_type2(spark, folder, scd.TYPE2_GRAPH)).drop("created_at")


@query(
    "scd_graph_match",
    _GRAPH_WITH
    + f""" SELECT customer_id, {_NODE} AS node_id, email, city,
       CAST(valid_from AS VARCHAR) AS valid_from FROM dim WHERE is_current""",
)
def scd_graph_match(spark: SparkSession, folder: str) -> DataFrame:
    """main → open version, matched over the edges of the stored layout."""
    path = scratch(spark, "graph")
    _type2(spark, folder, scd.TYPE2_GRAPH).write.parquet(f"{path}/dimension")
    versions = spark.read.parquet(f"{path}/dimension")
    graph.main_nodes(versions).write.parquet(f"{path}/main")
    graph.version_nodes(versions).write.parquet(f"{path}/version")
    graph.version_edges(versions).write.parquet(f"{path}/edges")
    main, version, edges = (
        spark.read.parquet(f"{path}/{name}") for name in ("main", "version", "edges")
    )
    found = graph.open_versions(main, edges, version)
    return dates_as_text(found.select("customer_id", "node_id", "email", "city", "valid_from"))


# --- type 3 -----------------------------------------------------------------------------


def _type3_sql(tracked, remembered, updated) -> str:
    columns = []
    for f in CUSTOMER_FIELDS:
        if f == "customer_id":
            columns.append("coalesce(o.customer_id, n.customer_id) AS customer_id")
            continue
        takes = "o.customer_id IS NULL" + (" OR hit" if f in updated else "")
        columns.append(f"CASE WHEN {takes} THEN n.{f} ELSE o.{f} END AS {f}")
    for f in remembered:
        columns.append(
            f"CASE WHEN hit AND {_differ([f])} THEN o.{f} END AS previous_{f}"
        )
    columns.append(
        f"CASE WHEN o.customer_id IS NULL OR hit THEN {_DAY} ELSE o.sign_up_date END "
        "AS last_update_date"
    )
    names = [*CUSTOMER_FIELDS, *(f"previous_{f}" for f in remembered), "last_update_date"]
    return f"""
WITH {_INPUTS},
flags AS (SELECT o.customer_id AS id, {_differ(tracked)} AS hit
          FROM first_rows o JOIN changes n USING (customer_id)),
dim AS (SELECT {", ".join(columns)}
        FROM first_rows o FULL JOIN changes n ON o.customer_id = n.customer_id
        LEFT JOIN flags ON flags.id = o.customer_id)
SELECT {_text(names)} FROM dim"""


@query(
    "scd3_relational",
    _type3_sql(_SEVEN, ("email", "city"), _SEVEN),
)
def scd3_relational(spark: SparkSession, folder: str) -> DataFrame:
    first, later = inputs.first_day(spark, folder), inputs.changes(spark, folder)
    return dates_as_text(customer_history.type3_two_days(first, later, DAY))


@query("scd3_document", _type3_sql(SIX_FIELDS, SIX_FIELDS, SIX_FIELDS))
def scd3_document(spark: SparkSession, folder: str) -> DataFrame:
    first, later = inputs.first_day(spark, folder), inputs.changes(spark, folder)
    rows = customer_history.type3_two_days(first, later, DAY, scd.TYPE3_DOCUMENT)
    return dates_as_text(rows)


def _type3_third_sql(tracked, remembered, updated) -> str:
    """Rows after three days: the two days' rows met by the third file."""
    columns = []
    for f in CUSTOMER_FIELDS:
        if f == "customer_id":
            columns.append("coalesce(o.customer_id, n.customer_id) AS customer_id")
            continue
        takes = "o.customer_id IS NULL" + (" OR hit" if f in updated else "")
        columns.append(f"CASE WHEN {takes} THEN n.{f} ELSE o.{f} END AS {f}")
    for f in remembered:
        columns.append(
            f"CASE WHEN hit AND {_differ([f])} THEN o.{f} ELSE o.previous_{f} END AS previous_{f}"
        )
    columns.append(
        f"CASE WHEN o.customer_id IS NULL OR hit THEN {_THIRD_DAY} "
        "ELSE CAST(o.last_update_date AS DATE) END AS last_update_date"
    )
    names = [*CUSTOMER_FIELDS, *(f"previous_{f}" for f in remembered), "last_update_date"]
    return f"""
WITH two AS (SELECT * REPLACE (CAST(sign_up_date AS DATE) AS sign_up_date)
             FROM ({_type3_sql(tracked, remembered, updated)})),
third AS ({inputs.THIRD_SQL}),
again AS (SELECT o.customer_id AS id, {_differ(tracked)} AS hit
          FROM two o JOIN third n USING (customer_id)),
dim AS (SELECT {", ".join(columns)}
        FROM two o FULL JOIN third n ON o.customer_id = n.customer_id
        LEFT JOIN again ON again.id = o.customer_id)
SELECT {_text(names)} FROM dim"""


@query("scd3_published", _type3_third_sql(_SEVEN, ("email", "city"), _SEVEN))
def scd3_published(spark: SparkSession, folder: str) -> DataFrame:
    """Three days through a dimension kept on files; some keys change twice."""
    return dates_as_text(_stored(spark, folder, scd.TYPE3_RELATIONAL).read())


@query("scd3_published_document", _type3_third_sql(SIX_FIELDS, SIX_FIELDS, SIX_FIELDS))
def scd3_published_document(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_stored(spark, folder, scd.TYPE3_DOCUMENT).read())


# --- type 4 -----------------------------------------------------------------------------


def _type4_with(tracked, updated) -> str:
    overwritten = {f: f"n.{f}" for f in updated}
    return f"""
WITH {_INPUTS},
hit AS (SELECT o.customer_id FROM first_rows o JOIN changes n USING (customer_id)
        WHERE {_differ(tracked)}),
current_rows AS (
  SELECT {_fields("o")} FROM first_rows o
  WHERE o.customer_id NOT IN (SELECT customer_id FROM hit)
  UNION ALL
  SELECT {_fields("o", **overwritten)}
  FROM first_rows o JOIN hit USING (customer_id) JOIN changes n USING (customer_id)
  UNION ALL
  SELECT {_fields("n")} FROM changes n
  WHERE n.customer_id NOT IN (SELECT customer_id FROM first_rows)),
archived AS (
  SELECT {_fields("o")}, o.sign_up_date AS valid_from, {_DAY} AS valid_to
  FROM first_rows o JOIN hit USING (customer_id)),
opened AS (
  SELECT {_fields("o")}, {_FIRST_DAY} AS valid_from, CAST(NULL AS DATE) AS valid_to
  FROM first_rows o)"""


_T4_RELATIONAL = _type4_with(_SEVEN, (*_SEVEN, "full_name"))
_T4_GRAPH = _type4_with(SIX_FIELDS, SIX_FIELDS)


def _type4(spark, folder, rules=scd.TYPE4_RELATIONAL, close=False):
    first, later = inputs.first_day(spark, folder), inputs.changes(spark, folder)
    return customer_history.type4_two_days(first, later, FIRST_DAY, DAY, rules, close)


@query("scd4_current", _T4_RELATIONAL + f" SELECT {_text(CUSTOMER_FIELDS)} FROM current_rows")
def scd4_current(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_type4(spark, folder)[0])


@query(
    "scd4_history",
    _T4_RELATIONAL
    + f""" SELECT {_text(scd.HISTORY_FIELDS)}
FROM (SELECT * FROM opened UNION ALL SELECT * FROM archived)""",
)
def scd4_history(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_type4(spark, folder)[1])


@query(
    "scd4_history_closed",
    _T4_RELATIONAL
    + f""" SELECT {_text(scd.HISTORY_FIELDS)}
FROM (SELECT o.* REPLACE (CASE WHEN h.customer_id IS NULL THEN NULL ELSE {_DAY} END AS valid_to)
      FROM opened o LEFT JOIN hit h ON o.customer_id = h.customer_id
      UNION ALL SELECT * FROM archived)""",
)
def scd4_history_closed(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_type4(spark, folder, close=True)[1])


@query("scd4_graph_current", _T4_GRAPH + f" SELECT {_text(CUSTOMER_FIELDS)} FROM current_rows")
def scd4_graph_current(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_type4(spark, folder, scd.TYPE4_GRAPH)[0])


@query("scd4_graph_history", _T4_GRAPH + f" SELECT {_text(scd.HISTORY_FIELDS)} FROM archived")
def scd4_graph_history(spark: SparkSession, folder: str) -> DataFrame:
    return dates_as_text(_type4(spark, folder, scd.TYPE4_GRAPH)[1])


@query(
    "scd4_graph_edges",
    _T4_GRAPH
    + """ SELECT customer_id AS src, 'current:' || customer_id AS dst, 'HAS_CURRENT' AS type
FROM current_rows
UNION ALL SELECT customer_id, 'history:' || customer_id || ':' || CAST(valid_to AS VARCHAR),
       'HAS_HISTORY' FROM archived""",
)
def scd4_graph_edges(spark: SparkSession, folder: str) -> DataFrame:
    return graph.current_and_history_edges(*_type4(spark, folder, scd.TYPE4_GRAPH))


_OVERWRITTEN = {f: f"n.{f}" for f in (*_SEVEN, "full_name")}


@query(
    "scd4_published",
    f"""{_T4_RELATIONAL},
third AS ({inputs.THIRD_SQL}),
again AS (SELECT o.customer_id FROM current_rows o JOIN third n USING (customer_id)
          WHERE {_differ(_SEVEN)}),
current3 AS (
  SELECT * FROM current_rows WHERE customer_id NOT IN (SELECT customer_id FROM again)
  UNION ALL
  SELECT {_fields("o", **_OVERWRITTEN)}
  FROM current_rows o JOIN again USING (customer_id) JOIN third n USING (customer_id)
  UNION ALL
  SELECT {_fields("n")} FROM third n
  WHERE n.customer_id NOT IN (SELECT customer_id FROM current_rows)),
every AS (
  SELECT *, CAST(NULL AS DATE) AS valid_from, CAST(NULL AS DATE) AS valid_to, 'current' AS place
  FROM current3
  UNION ALL SELECT *, 'history' FROM opened
  UNION ALL SELECT *, 'history' FROM archived
  UNION ALL
  SELECT {_fields("o")}, o.sign_up_date, {_THIRD_DAY}, 'history'
  FROM current_rows o JOIN again USING (customer_id))
SELECT {_text(scd.HISTORY_FIELDS)}, place FROM every""",
)
def scd4_published(spark: SparkSession, folder: str) -> DataFrame:
    """Current and archived rows after three days through a dimension kept on files."""
    store = _stored(spark, folder, scd.TYPE4_RELATIONAL)
    current = store.read_current().withColumn("place", F.lit("current"))
    past = store.read_history().withColumn("place", F.lit("history"))
    return dates_as_text(past.unionByName(current, allowMissingColumns=True))


@query(
    "scd4_document_ids",
    _T4_RELATIONAL
    + """ SELECT CAST(customer_id AS VARCHAR) AS _id, 'current' AS kind FROM current_rows
UNION ALL SELECT customer_id || ':' || CAST(valid_to AS VARCHAR), 'history' FROM archived""",
)
def scd4_document_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Plain keys of current rows, keys with the closing day of archived ones."""
    current, history = _type4(spark, folder)
    ids = scd.with_document_id(current, "customer_id").select("_id", F.lit("current").alias("kind"))
    closed = history.filter("valid_to IS NOT NULL")
    past = scd.with_document_id(closed, "customer_id", "valid_to")
    return ids.unionByName(past.select("_id", F.lit("history").alias("kind")))


@query(
    "scd4_graph_nodes",
    _T4_GRAPH
    + """ SELECT 'current:' || customer_id AS node_id, email, city FROM current_rows
UNION ALL SELECT 'history:' || customer_id || ':' || CAST(valid_to AS VARCHAR), email, city
FROM archived""",
)
def scd4_graph_nodes(spark: SparkSession, folder: str) -> DataFrame:
    current, history = _type4(spark, folder, scd.TYPE4_GRAPH)
    wanted = ("node_id", "email", "city")
    return graph.current_nodes(current).select(*wanted).unionByName(
        graph.history_nodes(history).select(*wanted)
    )


# --- insert if absent -------------------------------------------------------------------


@query(
    "insert_if_absent",
    f"""
WITH {_INPUTS},
twice AS (SELECT * FROM changes
          UNION ALL SELECT * REPLACE ('z ' || full_name AS full_name) FROM changes),
ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY full_name) AS place
           FROM twice)
SELECT {_text(CUSTOMER_FIELDS)} FROM first_rows
UNION ALL
SELECT {_text(CUSTOMER_FIELDS)} FROM ranked
WHERE place = 1 AND customer_id NOT IN (SELECT customer_id FROM first_rows)""",
)
def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming keys appear twice; the first by name is taken."""
    incoming = inputs.changes(spark, folder)
    again = incoming.withColumn("full_name", F.concat(F.lit("z "), F.col("full_name")))
    rows = scd.insert_if_absent(
        inputs.first_day(spark, folder), incoming.unionByName(again), order_by="full_name"
    )
    return dates_as_text(rows)
