"""Load strategies of the raw layer: full, replace and incremental by key, with a watermark table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.functions.ordered import first_by_key, last_by_key
from peoplelake.schemas import SOURCES, TABLES, WATERMARKS, TableConfig
from peoplelake.sources.sinks import materialize
from peoplelake.sources.versions import FILE_ROWS, VersionedTable, upsert_by_files


WATERMARK_TABLE = "_load_watermarks"


@dataclass(frozen=True)
class LoadResult:
    """``rows`` to append and a watermark frame (last_loaded_id, rows_loaded), empty when nothing was new."""

    rows: DataFrame
    watermark: DataFrame


def add_lineage(df: DataFrame, source_name: str, loaded_at: dt.datetime) -> DataFrame:
    return df.withColumns(
        {
            "_loaded_at": F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz"),
            "_source": F.lit(source_name),
        }
    )


def load_full(source: DataFrame, pk: str | None = None, target_cols: Sequence[str] | None = None) -> DataFrame:
    """All source rows, in the target's column order; the caller replaces the table with them.

    With a primary key the first row per key stays, in the order of the other columns.
    """
    rows = source if target_cols is None else source.select(*target_cols)
    return rows if pk is None else first_by_key(rows, pk, [c for c in rows.columns if c != pk]).select(*rows.columns)


def insert_ignore(batch: DataFrame, target: DataFrame, pk: str, order: Sequence[str]) -> DataFrame:
    """New rows of ``batch``: the first row per key in ``order``, without keys the target already holds.

    Copies of one key are cut to one per task before they are exchanged.
    """
    once = first_by_key(batch, pk, order)
    return once.join(target.select(pk), pk, "left_anti").select(*batch.columns)


def load_incremental_pk(
    source: DataFrame, target: DataFrame, pk: str, wm: int, order: Sequence[str] | None = None
) -> LoadResult:
    """Rows above the watermark that the target does not hold yet, and the new watermark.

    ``pk > wm`` reaches both scans: only target rows above the mark can collide. Updates of rows at or below the
    mark are not seen, as in any load by key.
    """
    fresh = source.filter(F.col(pk) > F.lit(wm))
    others = [c for c in source.columns if c != pk]
    rows = insert_ignore(fresh, target.filter(F.col(pk) > F.lit(wm)), pk, order or others)
    mark = fresh.agg(F.max(pk).alias("last_loaded_id"), F.count(F.lit(1)).alias("rows_loaded"))
    return LoadResult(rows, mark.filter(F.col("rows_loaded") > 0))


def load_replace(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Upsert all source rows. Target rows without a source row are kept, also when deleted at the source.

    Of source rows with the same key the last one stays, in the order of the other columns.
    """
    rows = last_by_key(source.select(*target.columns), key, [c for c in target.columns if c != key])
    kept = target.join(source.select(key), key, "left_anti").select(*target.columns)
    return rows.select(*target.columns).unionByName(kept)


def watermark_get(watermarks: DataFrame, table: str) -> int:
    """Last loaded id of a table, 0 when there is none. The control table has one row per source table."""
    mark = watermarks.filter(F.col("table_name") == table).agg(F.coalesce(F.max("last_loaded_id"), F.lit(0)))
    return int(mark.first()[0])


def watermark_merge(watermarks: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply updates (same columns): the update's id and time win, row counts add up."""
    both = watermarks.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return both.groupBy("table_name").agg(
        F.max_by("last_loaded_id", "_new").alias("last_loaded_id"),
        F.max_by("last_loaded_at", "_new").alias("last_loaded_at"),
        F.sum("rows_loaded").alias("rows_loaded"),
    )


def watermark_update(
    watermarks: DataFrame, table: str, last_id: int, n: int, loaded_at: dt.datetime | None = None
) -> DataFrame:
    row = [(table, last_id, loaded_at, n)]
    return watermark_merge(watermarks, watermarks.sparkSession.createDataFrame(row, WATERMARKS))


@dataclass
class LoadConfig:
    """Where a load reads and writes. ``read(table)`` returns the source DataFrame of one table.

    A source that can plan by key is read with ``read_above(table, watermark)`` in incremental loads: it may leave out
    rows at or below the mark.
    Replaced tables get files of about ``file_rows`` rows, the unit in which they are rewritten.
    """

    read: Callable[[str], DataFrame]
    root: str
    loaded_at: dt.datetime
    source_prefix: str = "postgres.hr."
    tables: Sequence[TableConfig] = TABLES
    file_rows: int = FILE_ROWS
    read_above: Callable[[str, int], DataFrame] | None = None


def raw_path(root: str, target: str) -> str:
    return f"{root.rstrip('/')}/{target}"


def _staged(root: str, target: str) -> str:
    return raw_path(root, f"_staged/{target}")


def raw_schema(config: TableConfig) -> T.StructType:
    return T.StructType(
        [*SOURCES[config.source].fields, T.StructField("_loaded_at", T.TimestampNTZType()), T.StructField("_source", T.StringType())]
    )


def raw_table(spark: SparkSession, root: str, config: TableConfig) -> VersionedTable:
    return VersionedTable(spark, raw_path(root, config.target), raw_schema(config), config.key)


def read_raw(spark: SparkSession, root: str, config: TableConfig) -> DataFrame:
    return raw_table(spark, root, config).read()


def read_watermarks(spark: SparkSession, root: str) -> DataFrame:
    return VersionedTable(spark, raw_path(root, WATERMARK_TABLE), WATERMARKS).read()


def _load_table(spark: SparkSession, config: LoadConfig, table: TableConfig, marks: DataFrame, full_load: bool):
    """Load one table; returns (rows loaded, watermark update or None)."""
    target, staged = raw_table(spark, config.root, table), _staged(config.root, table.target)
    columns = [f.name for f in target.schema.fields]
    incremental = table.mode == "incremental_pk"
    wm = watermark_get(marks, table.source) if incremental and not full_load else None
    rows = config.read(table.source) if wm is None or config.read_above is None else config.read_above(table.source, wm)
    source = add_lineage(rows, config.source_prefix + table.source, config.loaded_at)
    if wm is not None:
        # The source is read once: mark and rows both come from the staged copy of its new rows.
        fresh = materialize(source.select(*columns).filter(F.col(table.key) > F.lit(wm)), staged)
        above = target.read([f for f in target.files() if f.high is not None and f.high > wm])
        result = load_incremental_pk(fresh, above, table.key, wm)
        mark = result.watermark.first()
        if mark is None:
            return 0, None
        target.append(result.rows)
        return mark["rows_loaded"], (table.source, mark["last_loaded_id"], config.loaded_at, mark["rows_loaded"])
    if table.mode == "replace":
        rows = last_by_key(source.select(*columns), table.key, [c for c in columns if c != table.key])
        rows = materialize(rows if not full_load else load_full(source, table.key, columns), staged)
        if full_load or not target.version():
            # in ranges of the key, so that later upserts find few files
            total = rows.count()
            target.publish(rows.repartitionByRange(max(1, -(-total // config.file_rows)), table.key))
            return total, None
        return upsert_by_files(target, rows, config.file_rows).rows, None
    target.publish(load_full(source, table.key, columns))
    total = sum(f.rows for f in target.files())
    last_id = max((f.high for f in target.files() if f.high is not None), default=None)
    return total, (table.source, last_id, config.loaded_at, total) if incremental and total else None


def run_load(
    spark: SparkSession, config: LoadConfig, *, tables: Iterable[str] | None = None, full_load: bool = False
) -> dict[str, int]:
    """Load the configured tables into the raw layer and return rows loaded per table; a key lands once in every mode.

    Tables are independent, so their jobs are submitted together. Each switches to its new version in one step; a
    replaced table rewrites only the files whose keys changed. Watermarks are written last, once all tables arrived: after
    a crash the next run starts from the old marks and skips rows that are already there. A full load sets the mark to the
    highest key it loaded.
    """
    wanted = None if tables is None else set(tables)
    chosen = [t for t in config.tables if wanted is None or t.source in wanted]
    marks = read_watermarks(spark, config.root)
    with ThreadPoolExecutor(max_workers=max(len(chosen), 1)) as pool:
        results = list(pool.map(lambda t: _load_table(spark, config, t, marks, full_load), chosen))
    updates = [mark for _, mark in results if mark is not None]
    if updates:
        merged = watermark_merge(marks, spark.createDataFrame(updates, WATERMARKS))
        materialize(merged.coalesce(1), raw_path(config.root, WATERMARK_TABLE))
    return {table.source: n for table, (n, _) in zip(chosen, results)}
