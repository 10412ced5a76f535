"""Slowly changing dimensions of types 2, 3 and 4 as set-based merges.

A merge pairs the current rows with one change per key and decides all keys at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import CUSTOMER_FIELDS, CUSTOMER_KEY, SIX_FIELDS
from tidemark.operators.joins import lookup_join
from tidemark.operators.sizing import measure

VERSION_FIELDS = (*CUSTOMER_FIELDS, "valid_from", "valid_to", "is_current")
HISTORY_FIELDS = (*CUSTOMER_FIELDS, "valid_from", "valid_to")


@dataclass(frozen=True)
class Type2Rules:
    """What opens a new version, and its dates."""

    tracked: tuple[str, ...]
    keep_sign_up: bool
    new_key_from_sign_up: bool
    first_load_from_sign_up: bool


@dataclass(frozen=True)
class Type3Rules:
    """What counts as a change, what is remembered, what else is overwritten."""

    tracked: tuple[str, ...]
    remembered: tuple[str, ...]
    updated: tuple[str, ...]


@dataclass(frozen=True)
class Type4Rules:
    """What archives the old row, what is overwritten, and the first load's history."""

    tracked: tuple[str, ...]
    updated: tuple[str, ...]
    first_load_history: bool


# The fields and dates of each variant.
TYPE2_RELATIONAL = Type2Rules(
    tracked=("email", "city"),
    keep_sign_up=True,
    new_key_from_sign_up=False,
    first_load_from_sign_up=True,
)
TYPE2_DOCUMENT = Type2Rules(
    tracked=SIX_FIELDS,
    keep_sign_up=False,
    new_key_from_sign_up=False,
    first_load_from_sign_up=False,
)
TYPE2_GRAPH = Type2Rules(
    tracked=SIX_FIELDS,
    keep_sign_up=False,
    new_key_from_sign_up=True,
    first_load_from_sign_up=True,
)
TYPE3_RELATIONAL = Type3Rules(
    tracked=(*SIX_FIELDS, "age"),
    remembered=("email", "city"),
    updated=(*SIX_FIELDS, "age"),
)
TYPE3_DOCUMENT = Type3Rules(tracked=SIX_FIELDS, remembered=SIX_FIELDS, updated=SIX_FIELDS)
TYPE4_RELATIONAL = Type4Rules(
    tracked=(*SIX_FIELDS, "age"),
    updated=(*SIX_FIELDS, "age", "full_name"),
    first_load_history=True,
)
TYPE4_GRAPH = Type4Rules(tracked=SIX_FIELDS, updated=SIX_FIELDS, first_load_history=False)


# --- keys -----------------------------------------------------------------------------


def _stop_if(condition: Column, message: str) -> Column:
    """A filter that lets every row pass, or ends the query."""
    failed = F.raise_error(F.lit(message)).cast("boolean")
    return F.when(condition, failed).otherwise(F.lit(True))


def _no_key(keys: Sequence[str]) -> Column:
    """Whether a group has a null in its key, as an aggregate: a filter on the key itself
    would be inferred for the other side of a join as well."""
    return F.max(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys)))


def one_per_key(
    rows: DataFrame,
    key: str | Sequence[str] = CUSTOMER_KEY,
    order_by: str | None = None,
    keep: str = "last",
) -> DataFrame:
    """One row per key.

    Without ``order_by`` a repeated key ends the query; with it the last (or first) row
    wins. Rows of a key are combined before the shuffle, so a key that owns most of the
    rows never gathers in one task. A null key ends the query.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in rows.columns if c not in keys]
    if order_by is None:
        row = F.struct(*others)
        chosen = F.first(row)
    else:
        row = F.struct(order_by, *(c for c in others if c != order_by))
        chosen = F.max(row) if keep == "last" else F.min(row)
    picked = rows.groupBy(*keys).agg(
        chosen.alias("_row"), F.count("*").alias("_rows"), _no_key(keys).alias("_no_key")
    )
    picked = picked.filter(_stop_if(F.col("_no_key"), f"{', '.join(keys)} is null"))
    if order_by is None:
        picked = picked.filter(
            _stop_if(F.col("_rows") > 1, f"{', '.join(keys)} is not unique")
        )
    return picked.select(*keys, "_row.*").select(*rows.columns)


def require_unique(rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows themselves, or an error when a key repeats."""
    return one_per_key(rows, key)


def insert_if_absent(
    existing: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str] = CUSTOMER_KEY,
    order_by: str | None = None,
    **limits: int,
) -> DataFrame:
    """``existing`` plus the incoming rows whose key it does not hold.

    Of several incoming rows for a key the first by ``order_by`` is taken; without an
    order, the least by value, so that a repeated run inserts the same row. An incoming
    null key ends the query: it would be inserted again by every run.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in incoming.columns if c not in keys]
    order = [order_by] if order_by else []
    least = F.min(F.struct(*order, *(c for c in others if c not in order)))
    first = incoming.groupBy(*keys).agg(least.alias("_row"), _no_key(keys).alias("_no_key"))
    first = first.filter(_stop_if(F.col("_no_key"), f"{', '.join(keys)} is null"))
    first = first.select(*keys, "_row.*")
    small = measure(incoming).fits(**limits)
    fresh = _absent(first, existing.select(*keys), keys, small)
    return existing.unionByName(fresh.select(*existing.columns))


def _absent(
    rows: DataFrame, known: DataFrame, keys: Sequence[str], small: bool
) -> DataFrame:
    """The rows whose key is not among the known keys.

    A small batch of rows is sent to the known keys, which then need no shuffle; what
    comes back is at most the batch again.
    """
    if small:
        known = known.join(F.broadcast(rows.select(*keys)), list(keys), "left_semi")
    return rows.join(known, list(keys), "left_anti")


# --- pairing --------------------------------------------------------------------------


def _pair(
    current: DataFrame,
    batch: DataFrame,
    order_by: str | None,
    small: bool | None = None,
    **limits: int,
) -> DataFrame:
    """(old, new) per key, from the current rows and a batch of changes.

    The batch is measured, unless ``small`` says what came of it. A small one is broadcast: the dimension stays where it is and
    only its key column is read a second time, to find the new keys. Otherwise both sides
    are shuffled by key once; ``one_per_key`` leaves the changes already placed by key.
    A key with several current rows ends the merge on both ways, whether the batch holds it
    or not: the small way counts all keys before it looks for those of the batch.
    """
    key = CUSTOMER_KEY
    changes = one_per_key(batch, key, order_by).select(*CUSTOMER_FIELDS)
    new = changes.select(F.col(key).alias("_key"), F.struct("*").alias("new"))
    small = measure(batch).fits(**limits) if small is None else small
    rows = current if small else require_unique(current, key)
    old = rows.select(F.col(key).alias("_key"), F.struct("*").alias("old"))
    if not small:
        return old.join(new, "_key", "full_outer").select("old", "new")
    stayed = old.join(F.broadcast(new), "_key", "left").select("old", "new")
    once = _stop_if(F.col("count") > 1, f"{key} is not unique: several current rows")
    known = old.groupBy("_key").count().filter(once).alias("o")
    # The count is part of the condition, so that the join stays above the check of all keys.
    asked = F.broadcast(new.select(F.col("_key").alias("k"))).alias("n")
    known = known.join(asked, F.expr("o._key = n.k AND o.count > 0"), "left_semi").select("_key")
    added = _absent(new, known, ["_key"], small=False).select(
        F.lit(None).cast(old.schema["old"].dataType).alias("old"), "new"
    )
    return stayed.unionByName(added)


def _both() -> Column:
    return F.col("old").isNotNull() & F.col("new").isNotNull()


def _differs(fields: Sequence[str]) -> Column:
    """True when any field differs; two nulls are equal, null and a value are not."""
    old, new = (", ".join(f"{side}.{f}" for f in fields) for side in ("old", "new"))
    return F.expr(f"NOT (struct({old}) <=> struct({new}))")


def _with(row: Column, **fields: Column) -> Column:
    """A struct with some fields replaced or added at the end."""
    for name, value in fields.items():
        row = row.withField(name, value)
    return row


def _date(as_of: dt.date) -> Column:
    return F.lit(as_of).cast("date")


def _no_date() -> Column:
    return F.lit(None).cast("date")


# --- type 2 ---------------------------------------------------------------------------


def type2_load(
    customers: DataFrame, as_of: dt.date, rules: Type2Rules = TYPE2_RELATIONAL
) -> DataFrame:
    """First versions: open, from the sign-up date or from the load date."""
    start = F.col("sign_up_date") if rules.first_load_from_sign_up else _date(as_of)
    return customers.select(
        *CUSTOMER_FIELDS,
        start.alias("valid_from"),
        _no_date().alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def type2_merge(
    current: DataFrame,
    changes: DataFrame,
    as_of: dt.date,
    rules: Type2Rules = TYPE2_RELATIONAL,
    order_by: str | None = None,
    changed_only: bool = False,
    **limits: int,
) -> DataFrame:
    """Current versions after a batch of changes, with the versions it closed.

    ``current`` holds only open versions. A tracked change closes the old version and
    opens one; a new key opens one; everything else stays. A change dated on or before the
    start of the version it would close ends the query. With ``changed_only`` what stays is
    left out and ``_new`` tells the versions of new keys.
    """
    pairs = _pair(current.select(*VERSION_FIELDS), changes, order_by, **limits)
    day = _date(as_of)
    old, new = F.col("old"), F.col("new")
    closing_day = F.when(
        day <= F.col("old.valid_from"),
        F.raise_error(F.lit("a change must be later than the version it closes")).cast("date"),
    ).otherwise(day)
    closed = _with(old, valid_to=closing_day, is_current=F.lit(False))
    sign_up = F.col("old.sign_up_date" if rules.keep_sign_up else "new.sign_up_date")
    opening = {"valid_to": _no_date(), "is_current": F.lit(True)}
    opened = _with(new, sign_up_date=sign_up, valid_from=day, **opening)
    start = F.col("new.sign_up_date") if rules.new_key_from_sign_up else day
    added = _with(new, valid_from=start, **opening)
    hit = _both() & _differs(rules.tracked)
    if changed_only:
        closed, opened = (_with(row, _new=F.lit(False)) for row in (closed, opened))
        added = _with(added, _new=F.lit(True))
        versions = F.when(old.isNull(), F.array(added)).when(hit, F.array(closed, opened))
        return pairs.select(F.inline(versions))
    versions = (
        F.when(old.isNull(), F.array(added))
        .when(hit, F.array(closed, opened))
        .otherwise(F.array(old))
    )
    return pairs.select(F.inline(versions))


def type2_apply(
    dimension: DataFrame,
    changes: DataFrame,
    as_of: dt.date,
    rules: Type2Rules = TYPE2_RELATIONAL,
    order_by: str | None = None,
    **limits: int,
) -> DataFrame:
    """The whole dimension after the changes: closed versions pass by untouched."""
    closed = dimension.filter(~F.col("is_current")).select(*VERSION_FIELDS)
    current = dimension.filter(F.col("is_current"))
    return closed.unionByName(
        type2_merge(current, changes, as_of, rules, order_by, **limits)
    )


def valid_on(dimension: DataFrame, day: dt.date) -> DataFrame:
    """The versions that were valid on a day."""
    at = _date(day)
    return dimension.filter(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )


# --- type 3 ---------------------------------------------------------------------------


def type3_fields(rules: Type3Rules) -> list[str]:
    return [*CUSTOMER_FIELDS, *(f"previous_{f}" for f in rules.remembered), "last_update_date"]


def type3_load(customers: DataFrame, rules: Type3Rules = TYPE3_RELATIONAL) -> DataFrame:
    """First rows: nothing remembered, last updated on the sign-up date."""
    return customers.select(
        *CUSTOMER_FIELDS,
        *(
            F.lit(None).cast(customers.schema[f].dataType).alias(f"previous_{f}")
            for f in rules.remembered
        ),
        F.col("sign_up_date").alias("last_update_date"),
    )


def type3_merge(
    dimension: DataFrame,
    changes: DataFrame,
    as_of: dt.date,
    rules: Type3Rules = TYPE3_RELATIONAL,
    order_by: str | None = None,
    changed_only: bool = False,
    **limits: int,
) -> DataFrame:
    """One row per key with the value before the last change of each remembered field.

    With ``changed_only`` rows that stay are left out and ``_new`` tells the new keys.
    """
    fields = type3_fields(rules)
    pairs = _pair(dimension.select(*fields), changes, order_by, **limits)
    is_new, hit = F.col("old").isNull(), _both() & _differs(rules.tracked)
    columns = []
    for f in CUSTOMER_FIELDS:
        old, new = F.col(f"old.{f}"), F.col(f"new.{f}")
        takes_new = (is_new | hit) if f in rules.updated else is_new
        columns.append(F.when(takes_new, new).otherwise(old).alias(f))
    for f in rules.remembered:
        old, new, before = F.col(f"old.{f}"), F.col(f"new.{f}"), F.col(f"old.previous_{f}")
        moved = hit & ~old.eqNullSafe(new)
        columns.append(F.when(moved, old).otherwise(before).alias(f"previous_{f}"))
    columns.append(
        F.when(is_new | hit, _date(as_of))
        .otherwise(F.col("old.last_update_date"))
        .alias("last_update_date")
    )
    if changed_only:
        return pairs.filter(is_new | hit).select(*columns, is_new.alias("_new"))
    return pairs.select(*columns)


# --- type 4 ---------------------------------------------------------------------------


def type4_load(
    customers: DataFrame, as_of: dt.date, rules: Type4Rules = TYPE4_RELATIONAL
) -> tuple[DataFrame, DataFrame]:
    """(current, history) of the first load."""
    current = customers.select(*CUSTOMER_FIELDS)
    history = current.select(
        "*", _date(as_of).alias("valid_from"), _no_date().alias("valid_to")
    )
    return current, history if rules.first_load_history else history.limit(0)


def type4_rows(
    current: DataFrame,
    changes: DataFrame,
    as_of: dt.date,
    rules: Type4Rules = TYPE4_RELATIONAL,
    order_by: str | None = None,
    changed_only: bool = False,
    **limits: int,
) -> DataFrame:
    """Both results of one join, told apart by ``target``: ``current`` or ``history``.

    Written partitioned by ``target`` the merge costs one pass; history rows are the
    newly archived ones, from the old sign-up date to ``as_of``. With ``changed_only``
    current rows that stay are left out and ``_new`` tells those of new keys.
    """
    pairs = _pair(current.select(*CUSTOMER_FIELDS), changes, order_by, **limits)
    old, new = F.col("old"), F.col("new")
    span = {"valid_from": _no_date(), "valid_to": _no_date()}
    to_current = {**span, "target": F.lit("current")}
    kept, added = _with(old, **to_current), _with(new, **to_current)
    renewed = _with(old, **{f: F.col(f"new.{f}") for f in rules.updated}, **to_current)
    archived = _with(
        old,
        valid_from=F.col("old.sign_up_date"),
        valid_to=_date(as_of),
        target=F.lit("history"),
    )
    hit = _both() & _differs(rules.tracked)
    if changed_only:
        renewed, archived = (_with(row, _new=F.lit(False)) for row in (renewed, archived))
        added = _with(added, _new=F.lit(True))
        rows = F.when(old.isNull(), F.array(added)).when(hit, F.array(renewed, archived))
        return pairs.select(F.inline(rows))
    rows = (
        F.when(old.isNull(), F.array(added))
        .when(hit, F.array(renewed, archived))
        .otherwise(F.array(kept))
    )
    return pairs.select(F.inline(rows))


def type4_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current, newly archived) from the rows of ``type4_rows``."""
    return (
        rows.filter(F.col("target") == "current").select(*CUSTOMER_FIELDS),
        rows.filter(F.col("target") == "history").select(*HISTORY_FIELDS),
    )


def type4_merge(
    current: DataFrame,
    history: DataFrame,
    changes: DataFrame,
    as_of: dt.date,
    rules: Type4Rules = TYPE4_RELATIONAL,
    order_by: str | None = None,
    close_open_history: bool = False,
    **limits: int,
) -> tuple[DataFrame, DataFrame]:
    """(current, history) after the changes.

    The open history row of the first load stays open unless ``close_open_history``.
    """
    renewed, archived = type4_split(
        type4_rows(current, changes, as_of, rules, order_by, **limits)
    )
    before = history.select(*HISTORY_FIELDS)
    if close_open_history:
        changed = archived.select(CUSTOMER_KEY, F.lit(True).alias("_changed"))
        closes = F.col("_changed") & F.col("valid_to").isNull()
        before = (
            lookup_join(before, changed, CUSTOMER_KEY, "left", **limits)
            .withColumn("valid_to", F.when(closes, _date(as_of)).otherwise(F.col("valid_to")))
            .select(*HISTORY_FIELDS)
        )
    return renewed, before.unionByName(archived)


# --- document ids ---------------------------------------------------------------------


def with_document_id(rows: DataFrame, *parts: str) -> DataFrame:
    """``_id``: the key, or the key and a date, joined by a colon."""
    return rows.withColumn("_id", F.concat_ws(":", *(F.col(p).cast("string") for p in parts)))
