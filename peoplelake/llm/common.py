"""Shared folder, written intermediate tables, and orders and running sums over groups of any size."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Temporary folders of local sessions without the setting, which can't be changed once a session runs.
_LOCAL_DIRS: dict[str, str] = {}
#: Rows of one group fall into so many hash ranges, each of which is sorted by one task.
RANGES = 1024


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``; a local session without that setting gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL_DIRS.get(context.applicationId)
        if root is None:
            root = _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="shared-")
    # with the scheme that Spark takes for it, for code that doesn't know the cluster's default
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"{re.sub('^file:/+', 'file:///', root).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there and lost executors cost nothing."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_range(h: Column, ranges: int = RANGES) -> Column:
    """The leading bits of a 64-bit hash: ranges follow each other as the hashes do inside a range."""
    return F.shiftrightunsigned(h, 64 - (ranges - 1).bit_length()).cast("int")


def running_sums(
    df: DataFrame, group: list[str], h: str, sums: dict[str, Column], ties: tuple[str, ...] = (), ranges: int = RANGES,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Exclusive running sums of every group in the order of hash column ``h``; group columns must not be null.

    A group is cut into ranges of its hashes, so a group of any size is spread over the tasks; one small row for each
    group and range carries the offset, and the columns of ``per_group`` with it.
    """
    keys = [*group, "_range"]
    rows = df.withColumn("_range", hash_range(F.col(h), ranges))
    inside = Window.partitionBy(*keys).orderBy(h, *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy(*keys).agg(*[F.sum(v).alias(f"_of_{k}") for k, v in sums.items()])
    totals = totals.select(*keys, *[(F.sum(f"_of_{k}").over(before) - F.col(f"_of_{k}")).alias(f"_of_{k}") for k in sums])
    if per_group is not None:
        totals = totals.join(per_group, group)
    rows = rows.select("*", *[(F.sum(v).over(inside) - v).alias(f"_in_{k}") for k, v in sums.items()])
    out = rows.join(totals, keys)
    for k in sums:
        out = out.withColumn(k, F.col(f"_of_{k}") + F.col(f"_in_{k}"))
    return out.drop("_range", *[f"_of_{k}" for k in sums], *[f"_in_{k}" for k in sums])


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its place (from 0) in the order of the given columns, nulls first, without one task for all rows."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = written(rows, "numbered").withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.select("_part", (F.sum("_n").over(ahead) - F.col("_n")).alias("_base"))
    place = F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(parts, "_part").withColumn(name, place).drop("_part", "_at", "_base")


def set_aside(df: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``df`` with all but the used columns renamed, so that no name clashes, and the columns that bring it back."""
    names = {c: c if c in used else f"_aside_{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), [F.col(n).alias(c) for c, n in names.items()]


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root): the smallest node that every node of an edge reaches.

    Alternating stars: each round links a node's larger neighbours, then its smaller ones, to the smallest of them.
    Minima are hash aggregates with a partial step and the joins can be split by adaptive execution, so a node with very
    many neighbours is no task of its own. Every round is written; it ends when a round changes nothing.
    """
    links = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct()
    links, before = written(links, "links"), None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
