"""Customer dimensions kept on files between batches: a base and the changes on top of it.

``<path>/batch=N/kind=base/buckets=B/table=T/bucket=b``   all rows after batch N
``<path>/batch=N/kind=delta/buckets=B/table=T/bucket=b``  what batch N made or replaced

A bucket holds the keys of one remainder. Tables of a batch: ``open`` and ``closed`` rows,
``history`` (type 4, only ever added to) and ``keys``, one row per open row that was added.

* A batch reads the buckets of its keys, the open rows in them, and writes changed rows only.
* The newest row of an identity counts; the others are left out when rows are read.
* ``keys`` is the index of uniqueness: before a batch is merged the open rows per key are
  counted in all buckets that it touches, from that narrow table alone, whatever its size.
* Once changes take more than a share of the base's bytes they are folded into a new base.
* A batch counts once Spark has committed it with its marker file, all its tables at once. A
  batch that broke off can be run again. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.constants import CUSTOMER_FIELDS, CUSTOMER_KEY
from tidemark.operators import scd
from tidemark.operators.sizing import Size, measure, size_columns

MARKER = "_SUCCESS"

#: Rows of a bucket when a base is written.
BUCKET_ROWS = 1_000_000

#: Changes are folded into a new base when they take more than this share of its bytes, and
#: more than these bytes.
DELTA_SHARE = 0.25
DELTA_BYTES = 32 * 1024 * 1024

Rules = scd.Type2Rules | scd.Type3Rules | scd.Type4Rules

_PLACE = "batch int, kind string, buckets int, table string, bucket int"
_FOLDER = re.compile(r"batch=(\d+)/kind=(base|delta)/buckets=(\d+)$")


@dataclass(frozen=True)
class Folder:
    batch: int
    kind: str
    buckets: int
    path: str


def bucket_of(buckets: int, key: str = CUSTOMER_KEY) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class DimensionStore:
    """A dimension of type 2, 3 or 4, by its rules."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        rules: Rules = scd.TYPE2_RELATIONAL,
        bucket_rows: int = BUCKET_ROWS,
        delta_share: float = DELTA_SHARE,
        delta_bytes: int = DELTA_BYTES,
    ):
        self.spark, self.path, self.rules = spark, path.rstrip("/"), rules
        self.bucket_rows, self.delta_share, self.delta_bytes = bucket_rows, delta_share, delta_bytes
        self._kinds: dict[str, T.DataType] | None = None
        if isinstance(rules, scd.Type2Rules):
            self.fields: tuple[str, ...] = scd.VERSION_FIELDS
            self.identity = (CUSTOMER_KEY, "valid_from")
        elif isinstance(rules, scd.Type3Rules):
            self.fields = tuple(scd.type3_fields(rules))
            self.identity = (CUSTOMER_KEY,)
        else:
            self.fields = CUSTOMER_FIELDS
            self.identity = (CUSTOMER_KEY,)

    # --- files ------------------------------------------------------------------------

    def _system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def folders(self) -> list[Folder]:
        """Committed batches in order, a base after the changes that it holds."""
        pattern = f"{self.path}/batch=*/kind=*/buckets=*/{MARKER}"
        found = self._system().globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(pattern))
        out = []
        for status in found or []:
            path = status.getPath().getParent().toString()
            batch, kind, buckets = _FOLDER.search(path).groups()
            out.append(Folder(int(batch), kind, int(buckets), path))
        return sorted(out, key=lambda f: (f.batch, f.kind == "base"))

    def newest(self) -> int:
        """Number of the newest complete batch, -1 if there is none."""
        return max((f.batch for f in self.folders()), default=-1)

    def _live(self) -> list[Folder]:
        """The newest base and the changes after it."""
        folders = self.folders()
        if not folders:
            return []
        base = max((f for f in folders if f.kind == "base"), key=lambda f: f.batch)
        return [base, *(f for f in folders if f.kind == "delta" and f.batch > base.batch)]

    def _schema(self) -> T.StructType:
        """Columns of the files. The first load decides their types; later batches are cast."""
        if self._kinds is None:
            base = next((f for f in self.folders() if f.kind == "base"), None)
            if base is not None:
                held = self.spark.read.parquet(base.path).schema
                self._kinds = {f.name: f.dataType for f in held.fields}
        kinds = {f.name: f.dataType for f in T._parse_datatype_string(schemas.CUSTOMER).fields}
        kinds |= {"valid_from": T.DateType(), "valid_to": T.DateType(), "is_current": T.BooleanType(),
                  "last_update_date": T.DateType()} | (self._kinds or {})
        names = dict.fromkeys((*self.fields, "valid_from", "valid_to"))
        fields = [T.StructField(n, kinds[n.removeprefix("previous_")]) for n in names]
        return T.StructType([*fields, *T._parse_datatype_string(_PLACE).fields])

    def _scan(self, folders: list[Folder]) -> DataFrame:
        schema = self._schema()
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*(f.path for f in folders))

    def _bytes(self, folders: list[Folder]) -> int:
        path, system = self.spark._jvm.org.apache.hadoop.fs.Path, self._system()
        return sum(system.getContentSummary(path(f.path)).getLength() for f in folders)

    def _write(self, rows: DataFrame, folder: Folder) -> None:
        """One job, hence one marker. ``rows`` have _table and _new; each new open row leaves
        a row in ``keys`` as well."""
        keys = F.when(F.col("_new"), F.array("_table", F.lit("keys"))).otherwise(F.array("_table"))
        rows = rows.withColumn("table", F.explode(keys)).withColumn("bucket", bucket_of(folder.buckets))
        schema = self._schema()
        columns = []
        for name in (n for n in schema.names if n in rows.columns and n not in ("table", "bucket")):
            value = F.col(name).cast(schema[name].dataType) if self._kinds else F.col(name)
            if name != CUSTOMER_KEY:
                value = F.when(F.col("table") != "keys", value)
            columns.append(value.alias(name))
        (
            rows.select(*columns, "table", "bucket")
            .repartition("bucket")
            .write.mode("overwrite")
            .partitionBy("table", "bucket")
            .parquet(folder.path)
        )

    def _folder(self, batch: int, kind: str, buckets: int) -> Folder:
        return Folder(batch, kind, buckets, f"{self.path}/batch={batch}/kind={kind}/buckets={buckets}")

    # --- reading ----------------------------------------------------------------------

    def _state(self, tables: tuple[str, ...], buckets: list[int] | None = None) -> DataFrame:
        """The newest rows of the tables, with _table. The base is not shuffled while the
        changes on top of it are small."""
        live = self._live()
        wanted = F.col("table").isin("open", "closed")
        if buckets is not None:
            wanted &= F.col("bucket").isin(buckets)
        base = self._scan(live[:1]).filter(wanted & F.col("table").isin(*tables))
        base = base.select(*self.fields, F.col("table").alias("_table"))
        if len(live) < 2:
            return base
        row = F.struct(*(f for f in self.fields if f not in self.identity), F.col("table").alias("_table"))
        delta = self._scan(live[1:]).filter(wanted).groupBy(*self.identity)
        delta = delta.agg(F.max_by(row, "batch").alias("_row")).select(*self.identity, "_row.*")
        replaced = delta.select(*(F.col(c).alias(f"_{c}") for c in self.identity))
        if measure(replaced).fits():
            replaced = F.broadcast(replaced)
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.identity]
        base = base.join(replaced, same, "left_anti")
        return base.unionByName(delta.filter(F.col("_table").isin(*tables)).select(*base.columns))

    def read(self) -> DataFrame:
        """All rows: every version of type 2, the rows of type 3, the current ones of type 4.
        None before the first batch."""
        return self._state(("open", "closed")).select(*self.fields)

    def read_current(self) -> DataFrame:
        """Open rows; closed ones of the base are not read."""
        return self._state(("open",)).select(*self.fields)

    def read_history(self) -> DataFrame:
        """Archived rows of type 4."""
        rows = self._scan(self.folders()).filter("table = 'history'")
        return rows.select(*scd.HISTORY_FIELDS)

    def open_rows_per_key(self, buckets: list[int] | None = None) -> DataFrame:
        """(key, open rows) from the index of uniqueness alone."""
        keys = self._scan(self._live()).filter("table = 'keys'")
        if buckets is not None:
            keys = keys.filter(F.col("bucket").isin(buckets))
        return keys.groupBy(CUSTOMER_KEY).agg(F.count("*").alias("open_rows"))

    # --- writing ----------------------------------------------------------------------

    def publish_first(self, customers: DataFrame, as_of: dt.date) -> int:
        """The first load, each key once (the least by value); an existing dimension is left
        as it is."""
        if self.newest() < 0:
            once = scd.insert_if_absent(customers.limit(0), customers)
            self._write_base(self._loaded(once, as_of), 0)
        return self.newest()

    def adopt(self, rows: DataFrame) -> int:
        """Open and closed rows that come from elsewhere, as they are, as the first batch."""
        if self.newest() < 0:
            is_open = F.col("is_current") if "is_current" in self.fields else F.lit(True)
            table = F.when(is_open, "open").otherwise("closed")
            self._write_base(rows.select(*self.fields, table.alias("_table"), is_open.alias("_new")), 0)
        return self.newest()

    def _loaded(self, customers: DataFrame, as_of: dt.date) -> DataFrame:
        new, opened = F.lit(True).alias("_new"), F.lit("open").alias("_table")
        if isinstance(self.rules, scd.Type2Rules):
            return scd.type2_load(customers, as_of, self.rules).select("*", opened, new)
        if isinstance(self.rules, scd.Type3Rules):
            return scd.type3_load(customers, self.rules).select("*", opened, new)
        current, history = scd.type4_load(customers, as_of, self.rules)
        old = history.select("*", F.lit("history").alias("_table"), F.lit(False).alias("_new"))
        return current.select("*", opened, new).unionByName(old, allowMissingColumns=True)

    def _write_base(self, rows: DataFrame, batch: int) -> None:
        count = rows.filter("_table <> 'history'").count()
        buckets = max(1, -(-count // self.bucket_rows))
        self._write(rows, self._folder(batch, "base", buckets))

    def publish(self, changes: DataFrame, as_of: dt.date, order_by: str | None = None) -> int:
        """Merges a batch and writes what it changed. A key with several open rows in a bucket
        of the batch ends it, as do repeated and null keys of the batch itself."""
        live = self._live()
        batch = self.newest() + 1
        once = scd.one_per_key(changes, CUSTOMER_KEY, order_by).select(*CUSTOMER_FIELDS)
        if not live:
            made = self._changed(self.read_current(), once, as_of)
            self._write_base(made, batch)
            return batch
        buckets = live[0].buckets
        touched = F.collect_set(bucket_of(buckets)).alias("buckets")  # at most as many as there are
        seen = once.agg(touched, *size_columns(once)).first()
        small = Size(seen["rows"], seen["bytes"]).fits()
        some = sorted(seen["buckets"])
        self._stop_if_repeated(some)
        keys = once.select(CUSTOMER_KEY)
        current = self._state(("open",), some).select(*self.fields)
        current = current.join(F.broadcast(keys) if small else keys, CUSTOMER_KEY, "left_semi")
        made = self._changed(current, once, as_of, small)
        self._write(made, self._folder(batch, "delta", buckets))
        self.compact_if_due()
        return batch

    def _stop_if_repeated(self, buckets: list[int]) -> None:
        repeated = self.open_rows_per_key(buckets).filter("open_rows > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"{CUSTOMER_KEY} {repeated[0][0]} has several current rows")

    def _changed(
        self, current: DataFrame, changes: DataFrame, as_of: dt.date, small: bool | None = None
    ) -> DataFrame:
        """Changed and new rows only, with _table and _new."""
        if isinstance(self.rules, scd.Type2Rules):
            made = scd.type2_merge(current, changes, as_of, self.rules, changed_only=True, small=small)
            table = F.when(F.col("is_current"), "open").otherwise("closed")
        elif isinstance(self.rules, scd.Type3Rules):
            made = scd.type3_merge(current, changes, as_of, self.rules, changed_only=True, small=small)
            table = F.lit("open")
        else:
            made = scd.type4_rows(current, changes, as_of, self.rules, changed_only=True, small=small)
            table = F.when(F.col("target") == "current", "open").otherwise("history")
        return made.withColumn("_table", table)

    def compact_if_due(self) -> bool:
        live = self._live()
        delta = self._bytes(live[1:])
        if len(live) < 2 or delta <= max(self.delta_bytes, self.delta_share * self._bytes(live[:1])):
            return False
        self.compact()
        return True

    def compact(self) -> None:
        """Folds all changes into a new base; the history stays where it was written."""
        if len(self._live()) < 2:
            return
        rows = self._state(("open", "closed"))
        self._write_base(rows.withColumn("_new", F.col("_table") == "open"), self.newest())

    def remove_replaced(self) -> None:
        """Deletes what the newest base replaced, but for the history. No reader may be on it."""
        path, system = self.spark._jvm.org.apache.hadoop.fs.Path, self._system()
        live = {f.path for f in self._live()}
        for folder in self.folders():
            if folder.path not in live:
                for table in ("open", "closed", "keys"):
                    system.delete(path(f"{folder.path}/table={table}"), True)
