"""The employee history kept as a table in hash buckets: a run rebuilds touched employees and rewrites only their buckets.

The headcount follows it by the files that changed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.functions.ordered import HOT_ROWS
from peoplelake.functions.scalar import day
from peoplelake.operators.dims import dim_employee, scd2_build
from peoplelake.operators.marts import HEADCOUNT_STATE, add_moves, headcount_moves
from peoplelake.sources.sinks import materialize, run_dir
from peoplelake.sources.versions import VersionedTable

BUCKETS = 256
#: (base, changes) of some keys to their versions.
Build = Callable[[DataFrame, DataFrame], DataFrame]
#: Hash of the base row that a key's versions were built from.
BASE = "_base_hash"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class HistoryRun:
    """Keys that were rebuilt, and the buckets that were rewritten and left as they were."""

    keys: int
    rewritten: int
    kept: int


class HistoryTable:
    """Versions of keys in hash buckets. ``change_id`` numbers the changes in the order they are loaded."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, change_id: str, buckets: int = BUCKETS):
        fields = T.StructType([*[f for f in schema.fields if f.name != BASE], T.StructField(BASE, T.LongType())])
        self.table = VersionedTable(spark, path, fields, key)
        self.key, self.change_id = key, change_id
        self.buckets = self.table.note().get("buckets", buckets)

    def read(self) -> DataFrame:
        return self.table.read().drop(BASE)

    def touched(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        """Keys whose base row is new or differs, or that have a change above the last one built in.

        Every key has one current version, which carries the hash. Keys whose base row is gone stay.
        """
        stored = self.table.read().filter("is_current = 1").select(self.key, F.col(BASE).alias("_stored"))
        base = base.select(self.key, self._hash(base).alias(BASE)).join(stored, self.key, "left")
        mark = self.table.note().get("last_change")
        new = changes if mark is None else changes.filter(F.col(self.change_id) > F.lit(mark))
        keys = base.filter(~F.col(BASE).eqNullSafe(F.col("_stored"))).select(self.key)
        return keys.unionByName(new.select(self.key)).filter(F.col(self.key).isNotNull()).distinct()

    @staticmethod
    def _hash(base: DataFrame) -> Column:
        return F.xxhash64(*sorted(base.columns))

    def update(self, base: DataFrame, changes: DataFrame, build: Build) -> HistoryRun:
        """Build the versions of touched keys anew with ``build(base, changes)`` and replace them in their buckets.

        Only buckets with a touched key are read and written; the files of all others stay, and the last change that
        is built in is noted in the same switch, so a run that stopped is simply repeated.
        """
        spark, version = self.table.spark, self.table.version()
        files = self.table.files(version)
        keys = materialize(self.touched(base, changes), run_dir(spark, "touched"))
        per_bucket = keys.groupBy(bucket_of(self.key, self.buckets).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        mark = changes.agg(F.max(self.change_id)).first()[0]
        note = {"buckets": self.buckets, "last_change": mark}
        hit = {r["b"] for r in per_bucket}
        old = [f for f in files if f.bucket in hit]
        if not hit:
            return HistoryRun(0, 0, len({f.bucket for f in files}))
        hashes = base.select(self.key, self._hash(base).alias(BASE))
        fresh = build(base.join(keys, self.key, "left_semi"), changes.join(keys, self.key, "left_semi")).join(hashes, self.key, "left")
        names = [f.name for f in self.table.schema.fields]
        rows = fresh.select(*names)
        if old:
            rows = self.table.read(old).join(keys, self.key, "left_anti").select(*names).unionByName(rows)
        bucket = bucket_of(self.key, self.buckets)
        added = self.table.write(rows.repartition(max(1, len(hit)), bucket), bucket)
        self.table.commit(added, old, version, note)
        self.table.vacuum()
        return HistoryRun(sum(r["n"] for r in per_bucket), len(hit), len({f.bucket for f in files} - hit))


#: Columns of the history that depend on the day it is looked at, and so are not stored.
DAILY = ("tenure_days",)


def employee_history(spark: SparkSession, path: str, employees: DataFrame, job_changes: DataFrame, buckets: int = BUCKETS) -> HistoryTable:
    """The table of ``dim_employee`` without its daily columns; it is empty until the first update."""
    schema = dim_employee(employees.limit(0), job_changes.limit(0), "2000-01-01").drop(*DAILY).schema
    return HistoryTable(spark, path, schema, "employee_id", "change_id", buckets)


def update_employees(
    history: HistoryTable, employees: DataFrame, job_changes: DataFrame, *, change_types: Sequence[str] = ("promotion",),
    base_from_change: bool = False, hot_rows: int = HOT_ROWS,
) -> HistoryRun:
    """Bring the history up to the staged employees and job changes; a run with nothing new rewrites nothing."""

    def build(base: DataFrame, changes: DataFrame) -> DataFrame:
        options = {"change_types": change_types, "base_from_change": base_from_change, "hot_rows": hot_rows}
        return dim_employee(base, changes, "2000-01-01", **options).drop(*DAILY)

    columns = [c for c in employees.columns if not c.startswith("_")]
    return history.update(employees.select(*columns), job_changes, build)


def read_employees(history: HistoryTable, as_of: dt.date | str) -> DataFrame:
    """``dim_employee`` as of a day, from the stored history."""
    rows = history.read()
    tenure = F.datediff(F.coalesce(F.col("exit_date"), day(as_of)), F.col("hire_date"))
    out = rows.withColumn("tenure_days", tenure)
    names = [c for c in rows.columns if c not in ("exit_date", "exit_type")]
    return out.select(*names, "tenure_days", "exit_date", "exit_type")


def update_versions(history: HistoryTable, base: DataFrame, changes: DataFrame, valid_from: str, order: Sequence[str], hot_rows: int = HOT_ROWS) -> HistoryRun:
    """``scd2_build`` kept up to date: ``base`` has one row per key, ``changes`` the same columns, the change id among them."""

    def build(first: DataFrame, later: DataFrame) -> DataFrame:
        return scd2_build(first, later, history.key, valid_from, order, hot_rows)

    return history.update(base, changes, build)


class HeadcountState:
    """Month changes of the headcount, kept as a table that follows an employee history."""

    def __init__(self, spark: SparkSession, path: str):
        kinds = [T.StructField(c, T.LongType()) for c in ("department_id", "level_id")] + [T.StructField("month", T.DateType())]
        self.table = VersionedTable(spark, path, T.StructType([*kinds, *[T.StructField(n, T.LongType()) for n in HEADCOUNT_STATE]]))

    def read(self) -> DataFrame:
        return self.table.read()

    def update(self, history: HistoryTable) -> bool:
        """Follow the history; returns whether all of it had to be read.

        Files of the history that both its versions hold cancel out, so only the rows of replaced files are read: the
        old ones are taken back and the new ones added. Without the version that the state stands for, it is built anew.
        """
        now, seen = history.table.version(), self.table.note().get("history", 0)
        if seen == now:
            return False
        new, old, whole = history.table.files(now), [], not history.table.has(seen)
        if not whole:
            old = history.table.files(seen)
            both = {f.path for f in new} & {f.path for f in old}
            new, old = ([f for f in files if f.path not in both] for files in (new, old))
        moves = [headcount_moves(history.table.read(files)) for files in (new, old)]
        state = self.table.read([]) if whole else self.read()
        names = [f.name for f in self.table.schema.fields]
        self.table.publish(add_moves(state, *moves).select(*[F.col(c).cast(self.table.schema[c].dataType).alias(c) for c in names]), note={"history": now})
        return whole
