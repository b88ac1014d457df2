"""Edge cases of staging, history, facts and marts on small inline tables."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peoplelake.operators import checks, dims, exports, facts, marts, staging
from verification import binding, queries

D = dt.date
EMPLOYEE = (
    "employee_id string, full_name string, email string, gender string, birth_date date, hire_date date, "
    "department_id long, job_title string, level_id long, manager_id string, employment_type string, status string"
)
CHANGE = (
    "change_id long, employee_id string, change_date date, change_type string, to_dept_id long, from_level_id long, "
    "to_level_id long, to_manager_id string, exit_type string"
)


def people(spark, *rows):
    full = [(i, i, f"{i}@x", "female", D(1980, 1, 1), hire, 1, "t", 2, None, "full_time", status) for i, hire, status in rows]
    return spark.createDataFrame(full, EMPLOYEE)


def moves(spark, *rows):
    full = [(n, e, d, kind, None, 2, 3 if kind == "promotion" else None, None, "voluntary" if kind == "termination" else None)
            for n, (e, d, kind) in enumerate(rows, 1)]
    return spark.createDataFrame(full, CHANGE)


def history(spark, staff, changes, **more):
    df = dims.dim_employee(people(spark, *staff), moves(spark, *changes), "2024-01-01", **more)
    return {r["employee_sk"]: r for r in df.collect()}


def test_promotion_on_the_hire_date(spark):
    h = history(spark, [("a", D(2020, 1, 1), "active")], [("a", D(2020, 1, 1), "promotion")])
    assert (h["a-V001"]["valid_from"], h["a-V001"]["valid_to"]) == (D(2020, 1, 1), D(2020, 1, 1))
    assert (h["a-V002"]["valid_to"], h["a-V002"]["is_current"], h["a-V002"]["level_id"]) == (None, 1, 3)


def test_promotion_after_exit_is_clamped(spark):
    changes = [("a", D(2022, 6, 1), "promotion"), ("a", D(2022, 1, 1), "termination")]
    last = history(spark, [("a", D(2020, 1, 1), "terminated")], changes)["a-V002"]
    assert (last["valid_from"], last["valid_to"]) == (D(2022, 6, 1), D(2022, 6, 1))


def test_terminated_without_exit_event_stays_open(spark):
    row = history(spark, [("a", D(2020, 1, 1), "terminated")], [])["a-V001"]
    assert row["valid_to"] is None and row["exit_date"] is None


def test_two_exits_give_one_current_row(spark):
    changes = [("a", D(2021, 1, 1), "termination"), ("a", D(2022, 1, 1), "termination")]
    h = history(spark, [("a", D(2020, 1, 1), "terminated")], changes)
    assert len(h) == 1 and h["a-V001"]["exit_date"] == D(2022, 1, 1)


def test_first_version_can_show_the_earlier_level(spark):
    staff, changes = [("a", D(2020, 1, 1), "active")], [("a", D(2021, 1, 1), "promotion")]
    people_now = people(spark, *staff).withColumn("level_id", F.lit(3).cast("long"))
    kept = dims.dim_employee(people_now, moves(spark, *changes), "2024-01-01", base_from_change=True)
    assert [r["level_id"] for r in kept.orderBy("employee_sk").collect()] == [2, 3]


def test_version_numbers_above_999_stay_unique(spark):
    changes = [("a", D(2020, 1, 1) + dt.timedelta(days=i), "promotion") for i in range(1, 1003)]
    h = history(spark, [("a", D(2020, 1, 1), "active")], changes, hot_rows=100)
    assert len(h) == 1003 and "a-V1003" in h


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 900)), max_size=12), st.sampled_from([0, 10**6]))
def test_history_windows_do_not_overlap(spark, promotions, hot_rows):
    staff = [(e, D(2020, 1, 1), "active") for e in "abc"]
    changes = [(e, D(2020, 1, 1) + dt.timedelta(days=d), "promotion") for e, d in promotions]
    by_employee = {}
    for r in history(spark, staff, changes, hot_rows=hot_rows).values():
        by_employee.setdefault(r["employee_id"], []).append(r)
    for rows in by_employee.values():
        rows.sort(key=lambda r: r["employee_sk"])
        assert sum(r["is_current"] for r in rows) == 1 and rows[-1]["is_current"] == 1
        for a, b in zip(rows, rows[1:]):
            assert a["valid_to"] >= a["valid_from"]
            assert a["valid_to"] < b["valid_from"] or a["valid_from"] == b["valid_from"]


def test_as_of_picks_one_version(spark):
    dim = dims.dim_employee(
        people(spark, ("a", D(2020, 1, 1), "active")), moves(spark, ("a", D(2021, 1, 1), "promotion")), "2024-01-01"
    )
    assert [r["level_id"] for r in dims.scd2_as_of(dim, "employee_id", "2020-12-31").collect()] == [2]
    assert [r["level_id"] for r in dims.scd2_as_of(dim, "employee_id", "2021-01-01").collect()] == [3]


def calendar(spark):
    return dims.dim_date(spark, "2019-01-01", "2024-12-31")


def test_calendar_default_range(spark):
    df = dims.dim_date(spark)
    assert df.count() == 2922
    row = df.filter(F.col("date_day") == D(2021, 1, 3)).first()
    assert (row["week_of_year"], row["day_of_week"], row["day_name"], row["is_weekend"]) == (53, 1, "Sunday", 1)


def test_salary_steps(spark):
    rows = [(1, "a", D(2020, 1, 1), 100), (3, "a", D(2021, 1, 1), 150), (2, "a", D(2021, 1, 1), 120), (9, "b", D(2020, 5, 1), 7)]
    df = spark.createDataFrame(rows, "salary_id long, employee_id string, effective_date date, s long").select(
        "salary_id", "employee_id", "effective_date", F.col("s").cast("decimal(12,2)").alias("salary_amount"),
        F.lit("USD").alias("currency"), F.lit("x").alias("change_reason"),
    )
    got = {r["salary_id"]: r for r in facts.fct_salary(df, calendar(spark)).collect()}
    assert (got[1]["salary_delta"], got[1]["salary_delta_pct"], got[1]["salary_seq"]) == (0, None, 1)
    # Equal dates are ordered by id.
    assert (got[2]["prev_salary"], got[3]["prev_salary"]) == (100, 120)
    assert float(got[3]["salary_delta_pct"]) == 25.0 and got[3]["year_quarter"] == "2021-Q1"


def test_rolling_review_mean(spark):
    rows = [(i, "a", D(2020, 1, 1) + dt.timedelta(days=90 * i), s) for i, s in enumerate([1, 2, 3, 4, 5])]
    df = spark.createDataFrame(rows, "review_id long, employee_id string, review_date date, s long").select(
        "review_id", "employee_id", "review_date", F.lit(2020).alias("review_year"), F.lit(1).alias("review_quarter"),
        F.col("s").cast("decimal(3,2)").alias("score"), F.lit("m").alias("manager_id"),
    )
    got = facts.fct_performance(df, calendar(spark)).orderBy("review_seq").collect()
    assert [float(r["score_4q_avg"]) for r in got] == [1.0, 1.5, 2.0, 2.5, 3.5]
    assert [float(r["score_delta"]) for r in got] == [0, 1, 1, 1, 1]


def brute_headcount(rows, months):
    out = {}
    for m in months:
        nxt = D(m.year + m.month // 12, m.month % 12 + 1, 1)
        end = nxt - dt.timedelta(days=1)
        n = sum(1 for s, e in rows if s <= end and (e is None or e > end))
        if n:
            out[m.strftime("%Y-%m")] = n
    return out


def month_list(start, end):
    out, y, m = [], start.year, start.month
    while D(y, m, 1) <= end:
        if D(y, m, 1) >= start:
            out.append(D(y, m, 1))
        y, m = y + m // 12, m % 12 + 1
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 1200), st.one_of(st.none(), st.integers(0, 500))), min_size=1, max_size=15),
    st.sampled_from([D(2020, 1, 1), D(2020, 3, 15)]),
)
def test_snapshot_counts_equal_nested_loop(spark, drawn, start):
    rows = [(D(2019, 1, 1) + dt.timedelta(days=s), None if e is None else D(2019, 1, 1) + dt.timedelta(days=s + e)) for s, e in drawn]
    df = spark.createDataFrame([("g", *r) for r in rows], "g string, s date, e date")
    end = D(2021, 6, 20)
    got = marts.snapshot_counts(df, "s", "e", ["g"], (start, end)).collect()
    assert {r["year_month_key"]: r["entities"] for r in got} == brute_headcount(rows, month_list(start, end))


def test_exit_on_the_last_day_leaves_that_month(spark):
    df = spark.createDataFrame([("g", D(2020, 1, 10), D(2020, 3, 31))], "g string, s date, e date")
    got = marts.snapshot_counts(df, "s", "e", ["g"], ("2020-01-01", "2020-12-31")).collect()
    assert sorted(r["year_month_key"] for r in got) == ["2020-01", "2020-02"]


def test_tenure_can_be_measured_on_the_snapshot_day(spark):
    employees = dims.dim_employee(people(spark, ("a", D(2020, 1, 1), "active")), moves(spark), "2024-01-01")
    dept = spark.createDataFrame([(1, "d")], "department_id long, department_name string")
    level = spark.createDataFrame([(2, "l", "g")], "level_id long, level_name string, level_group string")
    args = (calendar(spark), employees, dept, level, "2020-01-01", "2021-02-01")
    today = marts.mart_headcount(*args).filter("year_month_key = '2021-01'").first()
    then = marts.mart_headcount(*args, tenure_at_snapshot=True).filter("year_month_key = '2021-01'").first()
    assert (float(today["avg_tenure_years"]), float(then["avg_tenure_years"])) == (4.0, 1.08)


def test_attrition_rate_is_null_outside_headcount_months(spark):
    exits = spark.createDataFrame(
        [("2020-Q1", 2020, 1, 1, "voluntary"), ("2023-Q4", 2023, 4, 1, "retirement")],
        "exit_year_quarter string, exit_year int, exit_quarter int, department_id long, exit_type string",
    ).select("*", *[F.lit(1).cast("decimal(8,2)").alias(c) for c in ("tenure_years", "last_perf_score", "last_salary")])
    hc = spark.createDataFrame(
        [("2020-01", 1, 10), ("2020-02", 1, 20)], "year_month_key string, department_id long, headcount long"
    )
    dept = spark.createDataFrame([(1, "d")], "department_id long, department_name string")
    got = {r["exit_year_quarter"]: r for r in marts.mart_attrition(exits, hc, dept).collect()}
    assert float(got["2020-Q1"]["attrition_rate_pct"]) == 6.67 and float(got["2020-Q1"]["avg_headcount"]) == 15
    assert got["2023-Q4"]["attrition_rate_pct"] is None and got["2023-Q4"]["exits_retirement"] == 1


def test_requisition_that_never_hired(spark):
    rows = [("r1", "c1", "applied", D(2020, 1, 1)), ("r1", "c1", "applied", D(2020, 1, 5)), ("r1", "c2", "applied", D(2020, 1, 2)),
            ("r2", "c3", "applied", D(2020, 2, 1)), ("r2", "c3", "offer", D(2020, 2, 11)), ("r2", "c3", "hired", D(2020, 2, 21))]
    df = spark.createDataFrame([(1, *r) for r in rows], "department_id long, requisition_id string, candidate_id string, stage string, stage_date date")
    dept = spark.createDataFrame([(1, "d")], "department_id long, department_name string")
    row = marts.mart_hiring(df, calendar(spark), dept).first()
    assert (row["total_requisitions"], row["cnt_applied"], row["cnt_hired"]) == (2, 3, 1)
    assert (float(row["avg_days_to_hire"]), float(row["avg_days_to_offer"])) == (20.0, 10.0)
    assert row["screening_rate_pct"] == 0 and row["interview_rate_pct"] is None


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_events_are_dealt_by_requisition_once(spark):
    stages = ("applied", "screening", "interview", "offer", "hired", "rejected", None)
    rows = [(d, r, c, stages[(i * 3 + (c is None)) % 7], D(2020, 1 + i % 12, 1 + i % 28) if i % 9 else None)
            for i in range(60) for d, r, c in ((1 + i % 2, f"r{i % 5}", f"c{i % 4}"), (1, "busy", None if i % 6 == 0 else f"c{i % 7}"), (None, None, "c"), (2, None, f"c{i}"))]
    df = spark.createDataFrame(rows, "department_id long, requisition_id string, candidate_id string, stage string, stage_date date")
    dept = spark.createDataFrame([(1, "d"), (2, "e")], "department_id long, department_name string")
    once = marts.mart_hiring(df, calendar(spark), dept)
    by_quarter = sorted(map(str, once.collect()))
    assert by_quarter and all(by_quarter == sorted(map(str, marts.mart_hiring(df, calendar(spark), dept, hot).collect())) for hot in (0, 25))
    assert "candidate_id#" not in " ".join(x.split(")")[0] for x in final_plan(once).split("hashpartitioning(")[1:])


def test_reviews_move_once_to_their_employee(spark):
    rows = [("busy" if i % 2 else f"e{i % 9}", None if i % 11 == 0 else f"2020-Q{1 + i % 4}", (i % 9 + 2) * 0.5 if i % 13 else None) for i in range(80)]
    fct = spark.createDataFrame([*rows, (None, "2020-Q1", 3.0)], "employee_id string, year_quarter string, score double")
    fct = fct.withColumn("score", F.col("score").cast("decimal(3,2)"))
    staff = spark.createDataFrame([(e, 1 + n % 2, 1) for n, e in enumerate(["busy", "e0", "e2", "e4", "e4"])], "employee_id string, department_id long, is_current int")

    def totals(**more):
        found = exports._reviews_by_employee(fct, staff, **more).groupBy("year_quarter", "department_id")
        return sorted(map(str, found.agg(F.sum("n"), F.sum("s")).collect()))

    assert totals() and totals() == totals(hot_rows=0) == totals(hot_rows=20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = final_plan(exports.perf_dist(fct, staff))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(employee_id#" in plan
    assert not any("employee_id#" in x and "year_quarter#" in x for x in (x.split(")")[0] for x in plan.split("hashpartitioning(")))


class Seen(Exception):
    pass


def test_declared_tests_are_counted_in_the_first_write(spark, sf_dir, monkeypatch):
    """The first table tested comes from its source, not from a copy written before."""

    def stop(df, path, tests):
        raise Seen(tests.table, df.inputFiles())

    monkeypatch.setattr(checks, "publish_tested", stop)
    with pytest.raises(Seen) as seen:
        queries.QUERIES["declared_tests_observed"](spark, sf_dir)
    table, files = seen.value.args
    assert table == "raw_departments" and [f.rsplit("/", 1)[1] for f in files] == ["region.parquet"]


def test_clamp(spark):
    exits = spark.createDataFrame([("E1", D(2025, 6, 30))], "employee_id string, exit_date date")
    salary = spark.createDataFrame(
        [("E1", D(2024, 1, 1)), ("E1", D(2026, 1, 1)), ("E2", D(2025, 1, 1)), ("E1", D(2025, 6, 30))], "employee_id string, d date"
    )
    kept = staging.clamp_events_to_exit(salary, exits, "employee_id", "d").collect()
    assert sorted((r["employee_id"], r["d"]) for r in kept) == [
        ("E1", D(2024, 1, 1)), ("E1", D(2025, 6, 30)), ("E2", D(2025, 1, 1))
    ]
    changes = spark.createDataFrame(
        [("E1", "termination", D(2025, 7, 1)), ("E1", "promotion", D(2026, 3, 1)), ("E1", "promotion", D(2024, 5, 1))],
        "employee_id string, change_type string, d date",
    )
    report = staging.clamp_report(changes, exits, "employee_id", "d", F.col("change_type") == "termination").first()
    assert (report["kept"], report["dropped"]) == (2, 1)
    nobody = exits.limit(0)
    assert staging.clamp_report(salary, nobody, "employee_id", "d").first()["dropped"] == 0


def test_clamp_of_events_whose_key_stands_in_their_parents(spark):
    parents = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, None), (None, "a"), (4, "c"), (4, "c")], "o long, k string")
    events = spark.createDataFrame([(o, D(2020, m, 1) if m else None) for o in (1, 2, 3, 4, 5, None) for m in (1, 1, 6, None)], "o long, d date")
    gone = spark.createDataFrame([("a", D(2020, 3, 1)), ("a", D(2020, 2, 1)), ("b", D(2020, 7, 1)), ("z", D(2020, 1, 1))], "k string, exit_date date")
    flat = staging.clamp_events_to_exit(events.join(parents, "o"), gone, "k", "d")
    found = staging.clamp_events_to_exit(events, gone, "k", "d", parents=parents, on="o")
    assert found.columns == flat.columns == ["o", "d", "k"]
    assert sorted(map(str, found.collect())) == sorted(map(str, flat.collect()))


def test_lines_are_dealt_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("performance_reviews", "recruitment_events"):
            plan = str(binding.source_table(spark, sf_dir, name)._jdf.queryExecution().executedPlan())
            # one for the lines, one for their orders
            assert plan.count("hashpartitioning(l_orderkey") == 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    ("start", "end", "want"),
    [
        (D(2024, 1, 15), D(2024, 12, 31), [D(2024, 1, 1), D(2024, 4, 1), D(2024, 7, 1), D(2024, 10, 1)]),
        (D(2023, 11, 1), D(2024, 2, 1), [D(2023, 10, 1), D(2024, 1, 1)]),
        (D(2024, 6, 1), D(2024, 1, 1), []),
    ],
)
def test_quarters(spark, start, end, want):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    assert [r["quarter_start"] for r in staging.quarters_between(df, "s", "e").collect()] == want


def test_dirty_raw_values_become_null(spark):
    raw = spark.createDataFrame(
        [("7", " Ops ", "x"), (None, "gone", "1")], "department_id string, department_name string, parent_id string"
    )
    got = staging.stg_departments(raw).collect()
    assert [tuple(r) for r in got] == [(7, "Ops", None)]


def test_source_keys_are_formatted_without_the_formatter(spark):
    """The same text for every key, and the formatter is left to keys below zero and NULL."""
    keys = [0, 7, 99_999, 999_999, 1_000_000, 5_400_000, 2**40, -1, -1_234_567, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select(
        binding.employee_id(F.col("k")).alias("a"), F.format_string("EMP-%06d", "k").alias("b"),
        binding._numbered("REQ-", F.col("k")).alias("c"), F.format_string("REQ-%d", "k").alias("d"),
    )
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in df.collect())
    usual = spark.range(3).select(binding.employee_id(F.col("id")).alias("e"))
    assert "lpad" in usual._jdf.queryExecution().optimizedPlan().toString()
