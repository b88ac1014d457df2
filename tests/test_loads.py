"""Load strategies, sinks and the streaming load."""

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from verification import binding
from peoplelake.schemas import SCORES, TABLES, WATERMARKS
from peoplelake.sources import loads, sinks, tables
from peoplelake.streaming.incremental import StreamTarget, stream_incremental_load

NOW = dt.datetime(2024, 1, 1, 12)
ROW = "id long, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_ignore_keeps_the_first(spark):
    batch = frame(spark, (1, "b"), (1, "a"), (2, "x"), (3, "y"))
    got = loads.insert_ignore(batch, frame(spark, (3, "old")), "id", ["v"])
    assert rows(got) == [(1, "a"), (2, "x")]


def test_incremental_moves_the_mark_and_counts_copies(spark):
    source = frame(spark, (1, "a"), (2, "b"), (3, "c"), (3, "c"))
    result = loads.load_incremental_pk(source, frame(spark, (1, "a"), (2, "b")), "id", 1)
    assert rows(result.rows) == [(3, "c")]
    assert tuple(result.watermark.first()) == (3, 3)


def test_incremental_without_news(spark):
    result = loads.load_incremental_pk(frame(spark, (1, "a")), frame(spark, (1, "a")), "id", 1)
    assert rows(result.rows) == [] and result.watermark.count() == 0


def test_incremental_on_an_empty_source(spark):
    empty = spark.createDataFrame([], ROW)
    assert loads.load_incremental_pk(empty, empty, "id", 0).rows.count() == 0
    assert loads.load_replace(empty, frame(spark, (1, "a")), "id").count() == 1
    assert loads.load_full(empty).count() == 0


def test_replace_upserts_and_keeps_missing(spark):
    got = loads.load_replace(frame(spark, (1, "new"), (4, "x")), frame(spark, (1, "old"), (2, "kept")), "id")
    assert rows(got) == [(1, "new"), (2, "kept"), (4, "x")]


def test_full_and_replace_keep_one_row_per_key(spark):
    source = frame(spark, (1, "b"), (1, "a"), (2, "x"), (2, "x"))
    assert rows(loads.load_full(source, "id")) == [(1, "a"), (2, "x")]
    assert rows(loads.load_full(source)) == [(1, "a"), (1, "b"), (2, "x"), (2, "x")]
    assert rows(loads.load_replace(source, frame(spark, (2, "old"), (3, "kept")), "id")) == [(1, "b"), (2, "x"), (3, "kept")]


def test_watermarks(spark):
    marks = spark.createDataFrame([("t", 5, None, 10)], WATERMARKS)
    assert loads.watermark_get(marks, "t") == 5 and loads.watermark_get(marks, "other") == 0
    marks = loads.watermark_update(marks, "t", 9, 3, NOW)
    marks = loads.watermark_update(marks, "u", 2, 2, NOW)
    assert sorted((r["table_name"], r["last_loaded_id"], r["rows_loaded"]) for r in marks.collect()) == [
        ("t", 9, 13), ("u", 2, 2)
    ]


def test_lineage(spark):
    row = loads.add_lineage(frame(spark, (1, "a")), "postgres.hr.t", NOW).first()
    assert (row["_loaded_at"], row["_source"]) == (NOW, "postgres.hr.t")


def config(spark, sf_dir, root, until=None):
    def read(name):
        df = binding.source_table(spark, sf_dir, name)
        return df if until is None or name != "salary_history" else df.filter(F.col("salary_id") <= until)

    return loads.LoadConfig(read, str(root), NOW)


def test_run_load_twice_adds_nothing(spark, sf_dir, tmp_path):
    first = loads.run_load(spark, config(spark, sf_dir, tmp_path, until=700))
    second = loads.run_load(spark, config(spark, sf_dir, tmp_path))
    third = loads.run_load(spark, config(spark, sf_dir, tmp_path))
    assert first["salary_history"] > 0 and second["salary_history"] > 0
    assert third["salary_history"] == third["performance_reviews"] == third["recruitment_events"] == 0
    by_name = {t.source: t for t in TABLES}
    raw = loads.read_raw(spark, str(tmp_path), by_name["salary_history"])
    source = binding.source_table(spark, sf_dir, "salary_history")
    assert raw.count() == source.count() == first["salary_history"] + second["salary_history"]
    assert raw.select("salary_id").distinct().count() == raw.count()
    employees = loads.read_raw(spark, str(tmp_path), by_name["employees"])
    assert employees.count() == employees.select("employee_id").distinct().count() == third["employees"]


def test_full_load_resets_the_mark(spark, sf_dir, tmp_path):
    loads.run_load(spark, config(spark, sf_dir, tmp_path), tables=["salary_history"])
    high = loads.watermark_get(loads.read_watermarks(spark, str(tmp_path)), "salary_history")
    loads.run_load(spark, config(spark, sf_dir, tmp_path, until=500), tables=["salary_history"], full_load=True)
    low = loads.watermark_get(loads.read_watermarks(spark, str(tmp_path)), "salary_history")
    assert low <= 500 < high
    again = loads.run_load(spark, config(spark, sf_dir, tmp_path), tables=["salary_history"])
    assert again["salary_history"] > 0


def test_a_failed_table_leaves_the_marks(spark, sf_dir, tmp_path):
    good = config(spark, sf_dir, tmp_path)

    def broken(name):
        if name == "job_changes":
            raise RuntimeError("source is gone")
        return good.read(name)

    with pytest.raises(RuntimeError):
        loads.run_load(spark, loads.LoadConfig(broken, str(tmp_path), NOW))
    assert loads.read_watermarks(spark, str(tmp_path)).count() == 0
    # The next run repairs everything without copies.
    loads.run_load(spark, good)
    for t in TABLES:
        raw = loads.read_raw(spark, str(tmp_path), t)
        assert raw.count() == raw.select(t.key).distinct().count() == good.read(t.source).count()


def test_a_replaced_table_keeps_its_other_files(spark, sf_dir, tmp_path):
    employees = next(t for t in TABLES if t.source == "employees")
    read = config(spark, sf_dir, tmp_path).read
    loads.run_load(spark, loads.LoadConfig(read, str(tmp_path), NOW, file_rows=20), tables=["employees"])
    table = loads.raw_table(spark, str(tmp_path), employees)
    names = {f.path for f in table.files()}
    low = min(f.high for f in table.files())
    source = read("employees").filter(F.col("employee_id") <= low).withColumn("status", F.lit("MOVED"))
    loads.run_load(spark, loads.LoadConfig(lambda name: source, str(tmp_path), NOW, file_rows=20), tables=["employees"])
    assert len(names) > 2 and len(names & {f.path for f in table.files()}) == len(names) - 1
    got = loads.read_raw(spark, str(tmp_path), employees)
    assert got.count() == 150 and got.filter("status = 'MOVED'").count() == source.count()


def test_a_load_that_stops_leaves_the_table(spark, sf_dir, tmp_path):
    salaries = next(t for t in TABLES if t.source == "salary_history")
    loads.run_load(spark, config(spark, sf_dir, tmp_path, until=700), tables=["salary_history"])
    before = loads.read_raw(spark, str(tmp_path), salaries).count()
    # files that a stopped run has written, but not named in a version
    table = loads.raw_table(spark, str(tmp_path), salaries)
    table.write(loads.read_raw(spark, str(tmp_path), salaries))
    assert loads.read_raw(spark, str(tmp_path), salaries).count() == before
    loads.run_load(spark, config(spark, sf_dir, tmp_path), tables=["salary_history"])
    want = binding.source_table(spark, sf_dir, "salary_history").count()
    assert loads.read_raw(spark, str(tmp_path), salaries).count() == want


class Reader:
    """Stands in for spark.read: no database is started."""

    def __init__(self):
        self.options, self.columns = {}, None

    def format(self, name):
        self.options["format"] = name
        return self

    def option(self, name, value):
        self.options[name] = value
        return self

    def load(self):
        return self

    def select(self, *columns):
        self.columns = columns
        return self


def test_jdbc_options():
    fake = type("Session", (), {"read": Reader()})()
    got = tables.src_jdbc(
        fake, "jdbc:x", "hr.salary_history", ["salary_id"], pk="salary_id", lower=0, upper=100, partitions=4,
        properties={"user": "u"},
    )
    assert got.columns == ("salary_id",)
    assert got.options == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "hr.salary_history", "fetchsize": 5000, "user": "u",
        "partitionColumn": "salary_id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4,
    }
    text_key = tables.src_jdbc(type("S", (), {"read": Reader()})(), "jdbc:x", "hr.employees", ["employee_id"])
    assert "partitionColumn" not in text_key.options


def test_watermark_filter_reaches_both_scans(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    frame(spark, (1, "a"), (2, "b")).write.parquet(source)
    frame(spark, (1, "a")).write.parquet(target)
    result = loads.load_incremental_pk(spark.read.parquet(source), spark.read.parquet(target), "id", 1)
    plan = result.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(id,1)") >= 2


def test_csv_files(spark, tmp_path):
    data = [(1, 'a "quoted", cell', 1.5), (2, None, 2.0), (3, "two\nlines", None), (4, "é", 3.25)]
    df = spark.createDataFrame(data, "id long, text string, n double").orderBy("id")
    sinks.export_csv(df, str(tmp_path / "out"), bom=True, single_file=True)
    (part,) = glob.glob(str(tmp_path / "out" / "part-*.csv"))
    raw = open(part, "rb").read()
    assert raw.startswith("﻿id,text,n\n".encode())
    assert raw.decode("utf-8-sig").split("\n", 1)[1] == '1,"a ""quoted"", cell",1.5\n2,,2\n3,"two\nlines",\n4,é,3.25\n'


def test_csv_source(spark, tmp_path):
    df = frame(spark, (1, "a,b"), (2, 'q"q'))
    sinks.export_csv(df, str(tmp_path / "x"))
    assert rows(tables.src_files(spark, str(tmp_path / "x"), df.schema, "csv")) == [(1, "a,b"), (2, 'q"q')]


def test_json_bundle(spark, tmp_path):
    df = spark.sql(
        "SELECT 1L AS id, 'a\"b' AS t, CAST(2 AS DECIMAL(5,2)) AS whole, CAST(2.50 AS DECIMAL(5,2)) AS part, "
        "DATE '2024-02-29' AS d, CAST(NULL AS DOUBLE) AS n, CAST(100 AS DOUBLE) AS big"
    )
    sinks.export_json_bundle({"top": df, "risk": {"bands": df}}, str(tmp_path))
    want = {"id": 1, "t": 'a"b', "whole": 2, "part": 2.5, "d": "2024-02-29", "n": None, "big": 100}
    for folder in ("top", "risk/bands"):
        (part,) = [p for p in glob.glob(str(tmp_path / folder / "part-*")) if open(p).read()]
        line = open(part).read()
        assert json.loads(line) == want and '"whole":2,' in line


def test_scores_of_a_day_are_replaced(spark, tmp_path):
    path = str(tmp_path / "scores")

    def day(d, ids):
        data = [(i, dt.date.fromisoformat(d), None, "low") + (None,) * 6 for i in ids]
        return spark.createDataFrame(data, SCORES)

    sinks.write_scores(day("2024-01-01", ["a", "b"]), path)
    sinks.write_scores(day("2024-01-02", ["a"]), path)
    sinks.write_scores(day("2024-01-01", ["c"]), path)
    got = sorted((str(r["scored_at"]), r["employee_id"]) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", "c"), ("2024-01-02", "a")]


class Conf:
    def __init__(self, master, path):
        self.conf, self.sparkContext, self.master, self.applicationId = self, self, master, f"app-{master}"
        self.path = path

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.path or default


def test_shared_folder():
    assert sinks.shared_dir(Conf("yarn", "hdfs://x")) == "hdfs://x"
    local = Conf("local[2]", None)
    assert sinks.shared_dir(local) == sinks.shared_dir(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.shared_dir(Conf("yarn", None))


def test_materialize_cuts_the_plan(spark, tmp_path):
    df = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()
    plan = sinks.materialize(df, str(tmp_path / "m"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan parquet" in plan


def test_stream_equals_batch_and_repeats_safely(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = frame(spark, (1, "a")).schema

    def run():
        stream_incremental_load(spark, landing, schema, target, "id", checkpoint, files_per_batch=1).awaitTermination()
        return rows(StreamTarget(spark, target, schema, "id").read())

    frame(spark, (5, "a"), (6, "b")).coalesce(1).write.mode("append").parquet(landing)
    assert run() == [(5, "a"), (6, "b")]
    # A later file with lower keys and one key again.
    frame(spark, (2, "c"), (6, "late")).coalesce(1).write.mode("append").parquet(landing)
    assert run() == [(2, "c"), (5, "a"), (6, "b")]
    assert run() == [(2, "c"), (5, "a"), (6, "b")]
