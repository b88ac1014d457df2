"""Versioned tables, upserts by files, the bucketed history, the as-of join and the stream target."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from peoplelake.functions.asof import as_of_join
from peoplelake.operators import dims, history, staging
from verification import binding
from peoplelake.sources import sinks
from peoplelake.sources.loads import add_lineage
from peoplelake.sources.versions import ConcurrentWrite, VersionedTable, place_among, upsert_by_files
from peoplelake.streaming import incremental

ROW = "id long, v string"


def frame(spark, rows, schema=ROW):
    return spark.createDataFrame(list(rows), schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def table(spark, path, schema=ROW, key="id"):
    return VersionedTable(spark, str(path), frame(spark, [], schema).schema, key)


# ---------------------------------------------------------------- versions


def test_files_are_packed_tightly(spark, tmp_path):
    """Whatever the session's codec."""
    t = table(spark, tmp_path / "t")
    t.publish(frame(spark, [(1, "a")]))
    t.publish(frame(spark, [(1, "a"), (2, "b")]), F.col("id"))
    assert t.files() and all(f.path.endswith(".zstd.parquet") for f in t.files())


def test_a_write_that_stops_half_way_leaves_the_old_version(spark, tmp_path):
    df = frame(spark, [(1, "old"), (2, "old")])
    sinks.materialize(df, str(tmp_path / "t"))
    again = VersionedTable(spark, str(tmp_path / "t"), df.schema)

    def broken(batch):
        yield from batch
        raise RuntimeError("executor is gone")

    failing = spark.range(100, numPartitions=4).select("id", F.lit("new").alias("v")).mapInArrow(broken, ROW)
    with pytest.raises(Exception, match="executor is gone"):
        sinks.materialize(failing, str(tmp_path / "t"))
    assert rows(again.read()) == [(1, "old"), (2, "old")]
    # complete files that no manifest names count for nothing either
    again.write(frame(spark, [(9, "never")]))
    assert rows(again.read()) == [(1, "old"), (2, "old")]
    assert rows(sinks.materialize(frame(spark, [(3, "new")]), str(tmp_path / "t"))) == [(3, "new")]


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    before = t.publish(frame(spark, [(1, "a")]))
    t.publish(frame(spark, [(2, "b")]))
    assert rows(before) == [(1, "a")] and rows(t.read()) == [(2, "b")]


def test_old_versions_are_cleaned_up(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for i in range(6):
        t.publish(frame(spark, [(i, "x")]))
    assert t._versions() == [5, 6]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2 and rows(t.read()) == [(5, "x")]


def test_two_writers(spark, tmp_path):
    one, two = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    base = two.version()
    one.append(frame(spark, [(1, "a")]))
    with pytest.raises(ConcurrentWrite):
        two.commit(two.write(frame(spark, [(2, "b")])), (), base)
    assert rows(two.read()) == [(1, "a")]


def test_statistics_of_files(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.publish(spark.range(1000).select("id", F.lit("x").alias("v")).repartitionByRange(4, "id"))
    files = t.files()
    assert sum(f.rows for f in files) == 1000 and len(files) == 4
    assert all(a.high < b.low for a, b in zip(files, files[1:], strict=False))
    assert rows(t.read(files[:1])) == [(i, "x") for i in range(files[0].rows)]
    assert t.publish(frame(spark, [])).count() == 0 and t.note() == {}


def test_place_among(spark):
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 10, 37):
        edges = sorted(rng.sample(range(200), n))
        got = spark.range(200).select(place_among(F.col("id"), edges).alias("n")).collect()
        assert [r.n for r in got] == [bisect.bisect_right(edges, i) for i in range(200)]


# ---------------------------------------------------------------- upserts


def test_upsert_rewrites_only_touched_files(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.publish(spark.range(0, 20_000, 2).select("id", F.lit("old").alias("v")).repartitionByRange(20, "id"))
    names = {f.path for f in t.files()}
    done = upsert_by_files(t, frame(spark, [(i, "new") for i in range(4000, 4100)]), file_rows=500)
    assert (done.rows, done.kept) == (100, 19) and len(names & {f.path for f in t.files()}) == 19
    want = {i: "old" for i in range(0, 20_000, 2)} | {i: "new" for i in range(4000, 4100)}
    assert rows(t.read()) == sorted(want.items())


def test_upserts_against_a_dictionary(spark, tmp_path):
    rng, want = random.Random(4), {}
    t = table(spark, tmp_path / "t")
    for step in range(6):
        batch = {rng.randrange(step * 40, 400 + 100 * step): f"v{step}" for _ in range(rng.choice([1, 30, 90]))}
        if step == 3:  # an append of other keys, whose files overlap the others
            batch = {k: v for k, v in batch.items() if k not in want}
            t.append(frame(spark, batch.items()).repartition(3))
        else:
            upsert_by_files(t, frame(spark, batch.items()), file_rows=40)
        want |= batch
        assert rows(t.read()) == sorted(want.items())
    files = sorted(t.files(), key=lambda f: f.low)
    before = t.version()
    assert upsert_by_files(t, frame(spark, [])).rows == 0 and t.version() == before
    assert sum(f.rows for f in files) == len(want)


def test_upsert_of_text_keys_and_keys_behind_all_files(spark, tmp_path):
    schema = "id string, v string"
    t = table(spark, tmp_path / "t", schema)
    upsert_by_files(t, frame(spark, [(f"EMP-{i:06d}", "a") for i in range(300)], schema), file_rows=50)
    names = {f.path for f in t.files()}
    done = upsert_by_files(t, frame(spark, [("EMP-000900", "b"), ("EMP-000901", "b")], schema))
    assert done.replaced == 0 and names < {f.path for f in t.files()} and t.read().count() == 302
    upsert_by_files(t, frame(spark, [("A", "c")], schema))
    assert t.read().count() == 303 and rows(t.read())[0] == ("A", "c")


# ---------------------------------------------------------------- as-of join


def brute(facts, versions):
    out = []
    for key, at, n in facts:
        held = [(v, tie, name, until) for k, v, tie, name, until in versions if k is not None and v is not None and k == key and at is not None and v <= at]
        last = max(held, default=None)
        out.append((key, at, n, last[2] if last and (last[3] is None or last[3] >= at) else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [10**9, 40, 0])
@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_as_of_join_against_brute_force(spark, hot_rows, kind):
    rng = random.Random(7)

    def moment():
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60))
        return day if kind == "date" else dt.datetime(day.year, day.month, day.day, rng.randrange(24), rng.randrange(60))

    keys = ["a"] * 20 + ["b", "c", "d", "e", None]
    facts = [(rng.choice(keys), moment() if rng.random() < 0.97 else None, i) for i in range(400)]
    versions = []
    for i in range(120):
        start = moment()
        versions.append((rng.choice([*keys, "only"]), start if rng.random() < 0.97 else None, i, f"v{i}", start + dt.timedelta(days=rng.randrange(9)) if rng.random() < 0.5 else None))
    versions += [("a", versions[0][1], 1000 + i, f"same{i}", None) for i in range(5)]
    left = frame(spark, facts, f"k string, at {kind}, n int")
    right = frame(spark, versions, f"k string, at {kind}, tie int, name string, until {kind}")
    got = as_of_join(left, right, "k", "at", "at", {"version": "name"}, tie=["tie"], until="until", hot_rows=hot_rows)
    assert got.columns == ["k", "at", "n", "version"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(facts, versions)
    assert as_of_join(left, right.limit(0), "k", "at", "at", ["name"], hot_rows=hot_rows).filter("name IS NOT NULL").count() == 0
    assert as_of_join(left.limit(0), right, "k", "at", "at", ["name"], hot_rows=hot_rows).count() == 0


def test_as_of_join_has_no_nested_loop(spark):
    left, right = frame(spark, [], "k string, at date"), frame(spark, [], "k string, s date, name string")
    plan = as_of_join(left, right, "k", "at", "s", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# ---------------------------------------------------------------- history


def staged(spark, sf_dir, until):
    """Staged employees and job changes of a load that has seen the changes up to an id."""
    raw = lambda name: add_lineage(binding.source_table(spark, sf_dir, name), name, dt.datetime(2024, 1, 1))
    people = staging.STAGING["stg_employees"][1](raw("employees"))
    changes = staging.STAGING["stg_job_changes"][1](raw("job_changes"))
    return people, changes.filter(F.col("change_id") <= until)


def test_two_loads_equal_one_full_build(spark, sf_dir, tmp_path):
    kept = history.employee_history(spark, str(tmp_path / "dim"), *staged(spark, sf_dir, 10**9), buckets=32)
    people, early = staged(spark, sf_dir, 200)
    some = people.filter("employee_id < 'EMP-000120'").withColumn("job_title", F.when(F.col("employee_id") == "EMP-000007", "apprentice").otherwise(F.col("job_title")))
    first = history.update_employees(kept, some, early)
    assert first.kept == 0 and first.keys == some.count()
    people, every = staged(spark, sf_dir, 10**9)
    history.update_employees(kept, people, every)
    want = dims.dim_employee(people, every, binding.AS_OF)
    got = history.read_employees(kept, binding.AS_OF)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)

    # nothing new: nothing is written; one employee: one bucket
    names = {f.path for f in kept.table.files()}
    assert history.update_employees(kept, people, every).rewritten == 0
    assert {f.path for f in kept.table.files()} == names
    moved = people.withColumn("job_title", F.when(F.col("employee_id") == "EMP-000033", "baker").otherwise(F.col("job_title")))
    run = history.update_employees(kept, moved, every)
    assert (run.keys, run.rewritten) == (1, 1) and run.kept > 20
    gone = names - {f.path for f in kept.table.files()}
    assert len(gone) < len(names) / 4
    assert rows_of(history.read_employees(kept, binding.AS_OF)) == rows_of(dims.dim_employee(moved, every, binding.AS_OF))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_versions_of_any_key_are_kept_up_to_date(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    schema = "k string, since date, n long"
    base = frame(spark, [(f"k{i}", day, 0) for i in range(20)], schema)
    changes = frame(spark, [(f"k{i % 20}", day + dt.timedelta(days=i), i) for i in range(1, 100)], schema)
    build = lambda b, c: dims.scd2_build(b, c, "k", "since", ["n"])
    kept = history.HistoryTable(spark, str(tmp_path / "h"), build(base, changes).schema, "k", "n", buckets=8)
    for until in (30, 30, 61, 99):
        history.update_versions(kept, base, changes.filter(F.col("n") <= until), "since", ["n"])
        assert rows_of(kept.read()) == rows_of(build(base, changes.filter(F.col("n") <= until)))


# ---------------------------------------------------------------- stream target


def test_batches_with_late_keys_equal_one_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "FAN", 3)
    rng, want, most = random.Random(11), {}, 0
    target = incremental.StreamTarget(spark, str(tmp_path / "t"), frame(spark, []).schema, "id", file_rows=300)
    for batch in range(16):
        keys = {rng.randrange(batch * 50, batch * 50 + 60) for _ in range(40)} | {rng.randrange(0, batch * 50 + 1) for _ in range(rng.choice([0, 3, 9]))}
        data = [(k, f"{batch}") for k in keys]
        assert target.load(frame(spark, data + data[:3]), batch) == len(keys - want.keys())
        want = {k: f"{batch}" for k in keys} | want
        most = max(most, len(target.table.files()))
    assert target.load(frame(spark, [(-1, "repeated")]), 15) == 0
    assert rows(target.read()) == sorted(want.items())
    assert most <= 16 and sum(f.rows for f in target.table.files()) == len(want)
    # every filter of a live file is there, and no file is read for keys that are in none
    held = {r.file for r in target.blooms.read().select("file").distinct().collect()}
    assert {f.path for f in target.table.files()} <= held
    for key in rng.sample(sorted(want), 5):
        (found,) = rows(target.table.read(target.may_hold(frame(spark, [(key,)], "id long"))).filter(F.col("id") == key))
        assert found == (key, want[key])
    missing = sorted(set(range(max(want))) - want.keys())[:60]
    assert len(missing) == 60
    read = sum(len(target.may_hold(frame(spark, [(k,)], "id long"))) for k in missing[:6])
    assert read <= 2


def test_batches_of_new_keys_read_no_file(spark, tmp_path):
    target = incremental.StreamTarget(spark, str(tmp_path / "t"), frame(spark, []).schema, "id")
    assert target.load(frame(spark, []), 0) == 0
    assert target.load(frame(spark, [(1, "a"), (2, "b")]), 1) == 2
    assert target.may_hold(frame(spark, [(5,)], "id long")) == []
    assert target.load(frame(spark, [(5, "c"), (5, "b")]), 2) == 1
    assert rows(target.read()) == [(1, "a"), (2, "b"), (5, "b")]
