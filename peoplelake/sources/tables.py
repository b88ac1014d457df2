"""Source readers. Both declare their schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def src_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a table from files with a declared schema (CSV has a header)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("quote", '"').option("escape", '"')
    return reader.format(fmt).load(path)


def src_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    *,
    pk: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 8,
    fetch_size: int = 5000,
    properties: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read columns of a database table, in parallel: one connection for each predicate, or ranges of equal width between
    the bounds of a numeric key.

    Filters on the result (``pk > watermark``) are pushed to the database by the JDBC source.
    """
    if predicates:
        options = {"fetchsize": str(fetch_size), **(properties or {})}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options).select(*columns)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for name, value in (properties or {}).items():
        reader = reader.option(name, value)
    if pk is not None and lower is not None and upper is not None:
        reader = (
            reader.option("partitionColumn", pk)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load().select(*columns)


def key_histogram_sql(table: str, pk: str, width: int, above: int | None = None) -> str:
    """The query that has the database count its rows per ``width`` keys."""
    where = "" if above is None else f" WHERE {pk} > {above}"
    return f"SELECT FLOOR({pk} / {width}) * {width} AS low, COUNT(*) AS n FROM {table}{where} GROUP BY FLOOR({pk} / {width}) * {width}"


def balanced_ranges(histogram: Sequence[tuple[int, int]], pk: str, width: int, partitions: int, above: int | None = None) -> list[str]:
    """Predicates that cut a numeric key into at most ``partitions`` ranges of about equal numbers of rows.

    ``histogram`` has (low, rows) for steps of ``width`` keys. A step with more than a range's share is cut further, at
    equal widths. The ranges are disjoint and cover every key, whatever came after the count; NULL keys go with the first.
    """
    steps = sorted((int(low), int(n)) for low, n in histogram if low is not None and n > 0)
    total = sum(n for _, n in steps)
    share = max(1, -(-total // max(1, partitions)))
    pieces = []
    for low, n in steps:
        parts = min(max(1, -(-n // share)), width)
        edges = [low + width * i // parts for i in range(parts)]
        pieces += [(edge, n / parts) for edge in edges]
    # a piece belongs to the range that its middle row falls into
    edges, before, current = [], 0.0, 0
    for low, n in pieces:
        place = min(partitions - 1, int((before + n / 2) * partitions / total))
        if place > current and before:
            edges.append(low)
        current, before = max(place, current), before + n
    floor = "" if above is None else f"{pk} > {above} AND "
    if not edges:
        return [f"{floor}1 = 1"]
    first = f"{floor}{pk} < {edges[0]}" if above is not None else f"({pk} < {edges[0]} OR {pk} IS NULL)"
    inner = [f"{pk} >= {a} AND {pk} < {b}" for a, b in zip(edges, edges[1:], strict=False)]
    return [first, *inner, f"{pk} >= {edges[-1]}"]


def jdbc_reader(
    spark: SparkSession, url: str, tables: Mapping[str, Sequence[str]], keys: Mapping[str, str], *, schema: str = "hr", width: int = 10_000,
    partitions: int = 8, fetch_size: int = 5000, properties: Mapping[str, str] | None = None,
):
    """``LoadConfig.read`` for a database: tables with a numeric key are read in balanced ranges above the watermark.

    ``tables`` maps tables to their columns and ``keys`` those with a numeric key to it. The histogram is one grouped
    query with a row for each ``width`` keys.
    """

    def read(table: str, above: int | None = None) -> DataFrame:
        name, pk = f"{schema}.{table}", keys.get(table)
        predicates = None
        if pk is not None:
            reader = spark.read.format("jdbc").option("url", url).option("query", key_histogram_sql(name, pk, width, above))
            for option, value in (properties or {}).items():
                reader = reader.option(option, value)
            histogram = [tuple(r) for r in reader.load().collect()]
            predicates = balanced_ranges(histogram, pk, width, partitions, above)
        return src_jdbc(spark, url, name, tables[table], fetch_size=fetch_size, properties=properties, predicates=predicates)

    return read
