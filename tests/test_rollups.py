"""Sketches that roll up, the headcount that follows its history, tests in the writing pass, balanced source ranges."""

import bisect
import datetime as dt
import random

from pyspark.sql import functions as F

from peoplelake.operators import checks, dims, history, marts, metrics, sketches, staging
from verification import binding
from peoplelake.sources import loads, tables
from peoplelake.sources.loads import add_lineage


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- quantiles


def test_sketches_of_small_groups_are_exact(spark):
    rng = random.Random(2)
    data = [(g, rng.randrange(50) / 2) for g in "aabbbc" for _ in range(rng.choice([1, 2, 4, 90]))] + [("a", None), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    ps = {"p25": "0.25", "p50": "0.50", "p75": "0.75", "p100": "0.999"}
    found = sketches.sketched_percentiles(sketches.quantile_sketches(df, ["g"], "v"), ["g"], ps)
    assert rows(found) == rows(marts.discrete_percentile(df, ["g"], "v", ps))


def test_merged_sketches_keep_the_rank_error(spark):
    df = spark.range(200_000).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), (F.hash("id").cast("double") % 100_000).alias("v"))
    values = sorted(r.v for r in df.select("v").collect())
    fine = sketches.quantile_sketches(df, ["a", "b"], "v")
    (whole,) = sketches.roll_up(fine, []).select("n", *[sketches.quantile(p).alias(f"q{p[2:]}") for p in ("0.05", "0.5", "0.95")]).collect()
    assert whole.n == len(values)
    for p in (0.05, 0.5, 0.95):
        row, v = int(whole.n * p), whole[f"q{str(p)[2:]}"]
        low, high = bisect.bisect_left(values, v), bisect.bisect_right(values, v) - 1
        assert max(low - row, row - high, 0) <= sketches.RANK_ERROR * whole.n
    one = sketches.roll_up(sketches.roll_up(fine, ["a"]), [])
    assert one.select("n", "low", "high", F.round("total", 3)).first() == fine.agg(F.sum("n"), F.min("low"), F.max("high"), F.round(F.sum("total"), 3)).first()


def test_empty_groups_have_no_sketch(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert sketches.quantile_sketches(empty, ["g"], "v").collect() == []
    assert sketches.sketched_calibration(spark.createDataFrame([], "y int, s double"), "y", "s").collect() == []


def test_sketched_calibration_is_near_the_exact_curve(spark):
    df = spark.range(20_000).select((F.pmod(F.hash("id"), F.lit(1000)) / 1000).alias("s"), (F.pmod(F.hash(F.col("id") + 1), F.lit(4)) == 0).cast("int").alias("y"))
    exact = {r.bin: r for r in metrics.calibration_curve(df, "y", "s").collect()}
    near = {r.bin: r for r in sketches.sketched_calibration(df, "y", "s").collect()}
    assert near.keys() == exact.keys() and sum(r.n for r in near.values()) == 20_000
    assert all(abs(near[b].n - exact[b].n) <= 2 * sketches.RANK_ERROR * 20_000 + 25 for b in exact)
    assert all(abs(near[b].mean_pred - exact[b].mean_pred) < 0.01 for b in exact)


# ---------------------------------------------------------------- distinct counts


def test_distinct_counts_merge_without_double_counting(spark):
    df = spark.range(300_000).select((F.col("id") % 60_000).alias("who"), (F.col("id") % 12).alias("month"))
    fine = sketches.distinct_sketches(df, ["month"], {"people": F.col("who")})
    whole = sketches.estimates(sketches.merged(fine, [], ["people"]), [], ["people"]).first()[0]
    assert abs(whole - 60_000) < 0.02 * 60_000
    each = {r.month: r.people for r in sketches.estimates(fine, ["month"], ["people"]).collect()}
    assert all(abs(v - 5_000) < 0.02 * 5_000 for v in each.values()) and len(each) == 12


def test_months_of_stay(spark):
    people = [("a", 1, "2024-01-31", None), ("b", 1, "2024-02-10", "2024-02-20"), ("c", 1, "2024-01-05", "2024-03-31"), ("d", 2, "2023-01-01", "2024-02-01"), ("e", None, None, None)]
    df = spark.createDataFrame(people, "employee_id string, department_id long, h string, x string")
    df = df.select("employee_id", "department_id", F.to_date("h").alias("hire_date"), F.to_date("x").alias("exit_date"), F.lit(1).alias("is_current"))
    found = sketches.headcount_sketches(df, dims.dim_date(spark, "2024-01-01", "2024-12-31"), "2024-01-01", "2024-04-15")
    got = {(r.year_month_key, r.department_id): r.employees for r in sketches.estimates(found, ["year_month_key", "department_id"], ["employees"]).collect()}
    assert got == {("2024-01", 1): 2, ("2024-02", 1): 2, ("2024-03", 1): 1, ("2024-04", 1): 1, ("2024-01", 2): 1}


# ---------------------------------------------------------------- headcount from its history


def staged(spark, sf_dir):
    raw = lambda name: add_lineage(binding.source_table(spark, sf_dir, name), name, dt.datetime(2024, 1, 1))
    return staging.STAGING["stg_employees"][1](raw("employees")), staging.STAGING["stg_job_changes"][1](raw("job_changes"))


def test_headcount_follows_late_hires_and_corrected_exits(spark, sf_dir, tmp_path):
    people, changes = staged(spark, sf_dir)
    date, dept = dims.dim_date(spark, "1992-01-01", "2001-12-31"), dims.dim_department(staging.STAGING["stg_departments"][1](add_lineage(binding.source_table(spark, sf_dir, "departments"), "d", dt.datetime(2024, 1, 1))))
    level = dims.dim_job_level(staging.STAGING["stg_job_levels"][1](add_lineage(binding.source_table(spark, sf_dir, "job_levels"), "d", dt.datetime(2024, 1, 1))))
    kept = history.employee_history(spark, str(tmp_path / "dim"), people, changes, buckets=16)
    state = history.HeadcountState(spark, str(tmp_path / "state"))

    def compare(people, changes, as_of="2001-08-01", start="1995-01-01"):
        history.update_employees(kept, people, changes)
        whole = state.update(kept)
        got = marts.headcount_from_state(state.read(), date, dept, level, start, as_of)
        want = marts.mart_headcount(date, dims.dim_employee(people, changes, as_of), dept, level, start, as_of)
        assert got.columns == want.columns and rows(got) == rows(want)
        return whole

    # the first build takes all; late hires, later exits and a corrected hire date follow by the files that changed
    early = people.filter("employee_id < 'EMP-000090'")
    assert not compare(early, changes.filter("change_id <= 100"))
    assert not compare(people, changes.filter("change_id <= 100"))
    assert not compare(people, changes)
    moved = people.withColumn("hire_date", F.when(F.col("employee_id") == "EMP-000004", F.date_add("hire_date", -400)).otherwise(F.col("hire_date")))
    assert not compare(moved, changes)
    assert not state.update(kept) and state.table.note()["history"] == kept.table.version()
    compare(moved, changes, as_of="1999-03-05", start="1996-02-10")
    # too many versions in between: built anew
    for title in ("x", "y", "z"):
        history.update_employees(kept, moved.withColumn("job_title", F.lit(title)), changes)
    assert compare(people, changes)


# ---------------------------------------------------------------- tests in the writing pass


def test_tests_are_counted_while_the_table_is_written(spark, tmp_path):
    tests = checks.TableTests("t", ("id", "v"), ("id",), {"kind": ("a", "b")}, {"positive": "v <= 0"})
    data = [(1, 5, "a"), (2, None, "a"), (2, 0, "c"), (None, -1, None), (4, 7, "b")]
    df = spark.createDataFrame(data, "id long, v int, kind string")
    done = checks.publish_tested(df, str(tmp_path / "t"), tests)
    want = [f for frame in tests.run(df) for f in rows(frame)]
    assert rows(done.results) == sorted(want, key=repr)
    assert rows(done.table) == rows(df) and done.table.columns == df.columns
    assert {(r.id, r.v, r.kind): sorted(r._reasons) for r in done.failing.collect()} == {
        (2, None, "a"): ["not_null:v"], (2, 0, "c"): ["accepted_values:kind", "expression:positive"], (None, -1, None): ["expression:positive", "not_null:id"],
    }
    empty = checks.publish_tested(df.limit(0), str(tmp_path / "none"), tests)
    assert all(r.failures == 0 for r in empty.results.collect()) and empty.failing.count() == 0


# ---------------------------------------------------------------- source ranges


def test_ranges_are_balanced_and_cover_every_key():
    rng = random.Random(6)
    keys = [int(rng.paretovariate(0.6)) % 1_000_000 for _ in range(5000)] + list(range(400_000, 403_000))
    for width, parts in ((10_000, 8), (500, 16), (1_000_000, 4), (10_000, 1)):
        histogram = {}
        for k in keys:
            histogram[k // width * width] = histogram.get(k // width * width, 0) + 1
        found = tables.balanced_ranges(list(histogram.items()), "k", width, parts)
        assert 1 <= len(found) <= parts
        held = [matching(p, keys) for p in found]
        assert sum(map(len, held)) == len(keys)
        assert all(sum(bool(matching(p, [k])) for p in found) == 1 for k in (-5, 0, 10**9, None))


def matching(predicate, keys):
    text = predicate.replace("AND", "and").replace("OR", "or").replace("IS NULL", "is None").replace("1 = 1", "True")
    out = []
    for k in keys:
        try:
            hit = eval(text, {"k": k})  # noqa: S307 - predicates made above
        except TypeError:
            hit = "is None" in text or text == "True"
        if hit:
            out.append(k)
    return out


def test_even_keys_get_even_ranges():
    found = tables.balanced_ranges([(i * 100, 100) for i in range(100)], "k", 100, 8)
    sizes = [len(matching(p, range(10_000))) for p in found]
    assert len(found) == 8 and max(sizes) <= 1.1 * 10_000 / 8
    hot = tables.balanced_ranges([(0, 9_000), (100, 500), (200, 500)], "k", 100, 5)
    assert len(hot) >= 4
    above = tables.balanced_ranges([(0, 10), (100, 10)], "k", 100, 2, above=50)
    assert above == ["k > 50 AND k < 100", "k >= 100"] and tables.balanced_ranges([], "k", 100, 4, above=7) == ["k > 7 AND 1 = 1"]


class Database:
    """Stands in for spark.read: no database is started."""

    def __init__(self):
        self.options, self.calls = {}, []

    def format(self, name):
        return self

    def option(self, name, value):
        self.options[name] = value
        return self

    def load(self):
        return self

    def collect(self):
        return [(0, 60), (10, 30), (20, 10)]

    def jdbc(self, url, table, predicates, properties):
        self.calls.append((table, predicates, properties))
        return self

    def select(self, *columns):
        return self


def test_a_reader_plans_its_ranges_above_the_mark():
    database = Database()
    read = tables.jdbc_reader(type("S", (), {"read": database})(), "jdbc:x", {"salary_history": ["salary_id"]}, {"salary_history": "salary_id"}, width=10, partitions=2)
    read("salary_history", 3)
    assert database.options["query"] == "SELECT FLOOR(salary_id / 10) * 10 AS low, COUNT(*) AS n FROM hr.salary_history WHERE salary_id > 3 GROUP BY FLOOR(salary_id / 10) * 10"
    ((table, predicates, properties),) = database.calls
    assert table == "hr.salary_history" and len(predicates) == 2 and properties == {"fetchsize": "5000"}


def test_incremental_loads_read_above_the_mark(spark, sf_dir, tmp_path):
    asked = []

    def above(name, mark):
        asked.append((name, mark))
        return binding.source_table(spark, sf_dir, name).filter(F.col("salary_id") > mark)

    config = loads.LoadConfig(lambda name: binding.source_table(spark, sf_dir, name), str(tmp_path), dt.datetime(2024, 1, 1), read_above=above)
    first = loads.run_load(spark, config, tables=["salary_history"])
    assert loads.run_load(spark, config, tables=["salary_history"]) == {"salary_history": 0}
    assert [m for _, m in asked][0] == 0 and asked[1][1] > 0 and first["salary_history"] > 0
