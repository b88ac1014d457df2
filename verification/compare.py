"""Run registered queries against their SQL: ``python -m verification.compare <sf_dir> [query ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from verification.oracle import ORACLE
from verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(spark: SparkSession, name: str, sf_dir: str):
    df = QUERIES[name](spark, sf_dir)
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, name: str):
    cur = con.execute(ORACLE[name])
    return _rows([d[0] for d in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    """None when equal, else a short description."""
    if got[0] != want[0]:
        return f"columns {sorted(set(got[0]) ^ set(want[0]))}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} against {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if repr(a) != repr(b):
            cells = [(c, x, y) for c, x, y in zip(got[0], a, b) if repr(x) != repr(y)]
            return f"first difference {cells[:4]} in {a}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        begin = time.time()
        try:
            got = spark_rows(spark, name, sf_dir)
            middle = time.time()
            if name in ORACLE:
                problem = difference(got, sql_rows(con, name))
                text = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, text = None, "rows only"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            middle, problem = time.time(), str(error)
            text = f"ERROR {type(error).__name__} {problem[:700]}"
        failed += problem is not None
        print(f"{name:28s} {len(got[1]) if problem is None else '':>7} {middle - begin:6.2f}s {time.time() - middle:6.2f}s {text}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
