"""Sinks: shared working folder, materialised tables, score partitions, CSV and JSON exports."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.sources.versions import VersionedTable

# Temporary folders of local sessions without a configured one; the setting itself is fixed once a session runs.
_LOCAL_DIRS: dict[str, str] = {}
BYTE_ORDER_MARK = "﻿"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``. A temporary one is used only in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="peoplelake-")
    return _LOCAL_DIRS[context.applicationId]


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Publish a table as a new version and read it back: later plans start from files, not from the lineage behind them.

    The version before stays readable until the new one is complete, and for readers that began with it.
    """
    return VersionedTable(df.sparkSession, path, df.schema).publish(df)


def write_scores(scores: DataFrame, path: str) -> None:
    """Replace the ``scored_at`` partitions present in ``scores`` and keep all others; a re-run is safe."""
    (
        scores.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("scored_at")
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str, *, bom: bool = False, single_file: bool = False) -> None:
    """CSV with header, doubled quotes, NULL as empty text, UTF-8. ``bom`` marks the header of each file.

    ``single_file`` is for report sections, which are bounded by months, departments and levels.
    """
    out = df.select(*[_csv_text(f).alias(f.name) for f in df.schema.fields])
    if bom:
        first = out.columns[0]
        out = out.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    if single_file:
        out = out.coalesce(1)
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def _plain_number(c: Column) -> Column:
    """Whole numbers without a fraction, others without trailing zeros: the shortest text that reads back as the value.

    Only beyond 20 digits before or 18 behind the point it keeps an exponent.
    """
    short = c.cast("string")
    text = F.when(short.contains("E"), F.coalesce(short.try_cast("decimal(38,18)").cast("string"), short)).otherwise(short)
    plain = text.contains(".") & ~text.contains("E")
    return F.when(plain, F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")).otherwise(text)


def _csv_text(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
        return _plain_number(c)
    return c


def json_line(df: DataFrame) -> DataFrame:
    """One JSON object per row: ISO dates, whole decimals as integers, NULL written as null."""
    parts = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            value = _plain_number(c)
        elif isinstance(field.dataType, (T.IntegralType, T.BooleanType)):
            value = c.cast("string")
        else:
            # to_json quotes and escapes; the array brackets around the single element are cut off.
            quoted = F.to_json(F.array(c.cast("string")))
            value = F.when(c.isNotNull(), quoted.substr(F.lit(2), F.length(quoted) - 2))
        name = F.lit(f'"{field.name}":')
        parts.append(F.concat(name, F.coalesce(value, F.lit("null"))))
    return df.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value"))


def export_json_bundle(sections: Mapping[str, DataFrame | Mapping], path: str) -> None:
    """Write each section as JSON lines below ``path``; nested sections become nested folders.

    Executors write the rows, so a long section such as the per-employee risk list never reaches the driver.
    """
    for name, section in sections.items():
        if isinstance(section, Mapping):
            export_json_bundle(section, f"{path}/{name}")
        else:
            json_line(section).write.mode("overwrite").text(f"{path}/{name}")
