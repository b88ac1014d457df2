"""One entry per operator. Every query starts from the given tables or from tables Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.functions import ordered
from peoplelake.functions.asof import as_of_join
from peoplelake.functions.scalar import (
    decimals_as_double,
    delta,
    number,
    quarter_key,
    risk_band,
    safe_rate,
    status_label,
    status_of,
    tenure_group,
    tenure_years,
    years_between,
)
from peoplelake.operators import checks, dims, explain, exports, features, history, marts, metrics, models, report, rules, sketches, staging
from peoplelake.operators.features import LABEL
from peoplelake.operators.report import ReportFilter
from verification import binding
from peoplelake.plans import warehouse
from peoplelake.plans.daily import export_sections, run_daily
from peoplelake.sources import loads
from peoplelake.sources.sinks import export_json_bundle, json_line, materialize, run_dir
from peoplelake.sources.tables import src_files
from peoplelake.sources.versions import VersionedTable, upsert_by_files
from peoplelake.streaming.incremental import StreamTarget, stream_incremental_load
from verification.lab import CENTERS, WEIGHTS, Lab, lab, linear_scores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Selections used by the report queries; the oracle repeats them.
ALL = ReportFilter()
SOME = ReportFilter(dept=2, level=3, month_start="1997-02", month_end="1999-08")
RANGE = ReportFilter(month_start="1999-08", month_end="1997-02", granularity="month", gender="female")
SLICE = ("EMP-000100", "EMP-000115")
LONG_SERVICE = ReportFilter(dept=3, tenure="gt5")
RISKY = ReportFilter(dept=3, band="high", tenure="gt5")


def query(name: str | None = None):
    """Register a function of a Lab; decimals leave as doubles."""

    def register(build: Callable[[Lab], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, sf_dir: decimals_as_double(build(lab(spark, sf_dir)))
        return build

    return register


# ---------------------------------------------------------------- sources and loads

CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
HALF_YEAR = "2024-01-15 00:00:00"


@query("src_files")
def _(x):
    return src_files(x.spark, f"{x.sf_dir}/customer.parquet", CUSTOMER)


def _events(x: Lab) -> DataFrame:
    return x.star("events").select("event_id", "user_id", "event_type", "value")


def _loaded_events(x: Lab) -> tuple[DataFrame, int]:
    """Events of the first half as the loaded target, with the highest key as its watermark."""
    target = x.star("events").filter(F.col("ts") < F.lit(HALF_YEAR).cast("timestamp_ntz"))
    mark = target.agg(F.coalesce(F.max("event_id"), F.lit(0))).first()[0]
    return target.select("event_id", "user_id", "event_type", "value"), mark


@query("load_full")
def _(x):
    twice = _events(x).unionByName(_events(x).withColumn("event_type", F.lit("zz")))
    return loads.load_full(twice, "event_id", ["event_id", "event_type", "value"])


@query("load_incremental_pk")
def _(x):
    target, mark = _loaded_events(x)
    result = loads.load_incremental_pk(_events(x), target, "event_id", mark)
    return target.withColumn("is_new", F.lit(0)).unionByName(result.rows.withColumn("is_new", F.lit(1)))


@query("watermark_update")
def _(x):
    target, mark = _loaded_events(x)
    marks = target.agg(F.max("event_id").alias("last_loaded_id"), F.count(F.lit(1)).alias("rows_loaded")).select(
        F.lit("events").alias("table_name"), "last_loaded_id", F.lit(None).cast("timestamp_ntz").alias("last_loaded_at"),
        "rows_loaded",
    )
    fresh = loads.load_incremental_pk(_events(x), target, "event_id", loads.watermark_get(marks, "events")).watermark
    row = fresh.select(
        F.lit("events").alias("table_name"), "last_loaded_id", F.lit(None).cast("timestamp_ntz").alias("last_loaded_at"),
        "rows_loaded",
    )
    return loads.watermark_merge(marks, row).select("table_name", "last_loaded_id", "rows_loaded")


@query("load_replace")
def _(x):
    columns = ["employee_id", "department_id", "status"]
    people = x.raw("raw_employees").select(*columns)
    hired = people.withColumn("status", F.lit("HIRED"))
    twice = people.filter(F.col("status") == "TERMINATED")
    twice = twice.unionByName(twice.withColumn("status", F.lit("OLDER")))
    return loads.load_replace(twice, hired, "employee_id")


@query("load_replace_files")
def _(x):
    """A published table, an upsert that reaches all its files, and one of a narrow range of keys."""
    people = x.raw("raw_employees").select("employee_id", "department_id", "status")
    table = VersionedTable(x.spark, run_dir(x.spark, "upsert"), people.schema, "employee_id")
    table.publish(people.withColumn("status", F.lit("HIRED")).repartitionByRange("employee_id"))
    upsert_by_files(table, people.filter(F.col("status") == "TERMINATED"))
    some = people.filter(F.col("employee_id").between(*SLICE))
    upsert_by_files(table, some.withColumn("status", F.lit("MOVED")))
    return table.read()


@query("run_load")
def _(x):
    """Sources that hold every row twice, loaded in full and then once more by their modes: rows and keys per table."""
    root = run_dir(x.spark, "keys")
    config = loads.LoadConfig(lambda name: x.source(name).unionByName(x.source(name)), f"{root}/raw", binding.LOADED_AT)
    loads.run_load(x.spark, config, full_load=True)
    loads.run_load(x.spark, config)
    counts = [
        loads.read_raw(x.spark, config.root, t).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(t.key).alias("n_keys"))
        .select(F.lit(t.target).alias("table_name"), "n_rows", "n_keys")
        for t in config.tables
    ]
    return reduce(DataFrame.unionByName, counts)


@query("insert_ignore")
def _(x):
    lines = x.star("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), "l_partkey", "l_suppkey",
        F.col("l_shipdate").cast("date").alias("ship_date"), "l_quantity", "l_extendedprice",
    )
    first_lines = x.star("orders").select((F.col("o_orderkey") * 10 + 1).alias("line_id"))
    return loads.insert_ignore(
        lines, first_lines, "line_id", ["ship_date", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    )


@query("add_lineage")
def _(x):
    rows = loads.add_lineage(x.source("employees").select("employee_id"), "star.employees", binding.LOADED_AT)
    return rows.withColumn("_loaded_at", F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query("stream_incremental_load")
def _(x):
    schema = x.star("events").schema
    target, checkpoint = run_dir(x.spark, "stream"), run_dir(x.spark, "stream-checkpoint")
    stream_incremental_load(
        x.spark, x.sf_dir, schema, target, "event_id", checkpoint, pattern="events.parquet"
    ).awaitTermination()
    return StreamTarget(x.spark, target, schema, "event_id").read().select("event_id", "user_id", "event_type", "value")


def _section_lines(spark, root: str, names) -> DataFrame:
    """The lines of published sections, as read back from their files."""
    parts = [spark.read.text(f"{root}/{name}").select(F.lit(name).alias("section"), "value") for name in names]
    return reduce(DataFrame.unionByName, parts)


#: Sections of the export that don't depend on scores, and those that do.
SECTIONS = ("departments", "levels", "headcount", "attrition", "compensation", "hiring", "perf_dist", "perf_by_dept")
RISK_SECTIONS = tuple(f"risk/{n}" for n in ("bands", "top", "by_dept", "bands_by_dept", "bands_by_level", "bands_by_dept_level"))


@query("export_json_bundle")
def _(x):
    """All sections of the bundle, written and read back."""
    root = run_dir(x.spark, "bundle")
    tables = {name: x.table(name) for name in warehouse.MODELS}
    export_json_bundle(export_sections(tables, x.scores, f"{root}/_work"), f"{root}/export")
    return _section_lines(x.spark, f"{root}/export", (*SECTIONS, *RISK_SECTIONS))


# ---------------------------------------------------------------- staging


def _staging(name):
    @query(name)
    def _(x):
        out = x.view(name)
        if "_loaded_at" in out.columns:
            out = out.withColumn("_loaded_at", F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss"))
        return out


for _name in staging.STAGING:
    _staging(_name)


def _exits(x):
    return binding.exits(x.spark, x.sf_dir)


@query("clamp_events_to_exit")
def _(x):
    events = binding.salary_events(x.spark, x.sf_dir).select("salary_id", "employee_id", "effective_date", "salary_amount")
    return staging.clamp_events_to_exit(events, _exits(x), "employee_id", "effective_date")


@query("clamp_report")
def _(x):
    s, e = x.spark, _exits(x)
    keep = F.col("change_type") == "Termination"
    parts = [
        staging.clamp_report(binding.salary_events(s, x.sf_dir), e, "employee_id", "effective_date", name="salary"),
        staging.clamp_report(binding.reviews(s, x.sf_dir), e, "employee_id", "review_date", name="review"),
        staging.clamp_report(binding.job_changes(s, x.sf_dir), e, "employee_id", "change_date", keep, "job_change"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("quarters_between")
def _(x):
    people = x.table("dim_employee").filter(F.col("is_current") == 1).select("employee_id", "hire_date", "exit_date")
    end = F.coalesce(F.col("exit_date"), F.lit(str(binding.AS_OF)).cast("date"))
    return staging.quarters_between(people, "hire_date", end).select("employee_id", "quarter_start", "year", "quarter")


# ---------------------------------------------------------------- models

for _name in warehouse.MODELS:
    query(_name)(lambda x, _name=_name: x.model(_name))


@query("scd2_build")
def _(x):
    columns = ["o_custkey", F.col("o_orderdate").cast("date").alias("valid_from"), "o_orderkey", "o_orderpriority"]
    orders = x.star("orders").select(*columns)
    base = ordered.last_by_key(orders, "o_custkey", ["valid_from", "o_orderkey"])
    changes = orders.join(base.select("o_orderkey"), "o_orderkey", "left_anti").select(*base.columns)
    return dims.scd2_build(base, changes, "o_custkey", "valid_from", ["o_orderkey"])


@query("scd2_as_of_join")
def _(x):
    """Every salary event with the version that held on its day."""
    facts = x.table("fct_salary").select("salary_id", "employee_id", "effective_date", "salary_amount")
    carry = ["employee_sk", "level_id", "department_id", "manager_id"]
    return as_of_join(facts, x.table("dim_employee"), "employee_id", "effective_date", "valid_from", carry, tie=["employee_sk"], until="valid_to")


@query("dim_employee_incremental")
def _(x):
    """The history after a load of half of the changes with outdated job titles, and then the rest."""
    people, changes = x.view("stg_employees"), x.view("stg_job_changes")
    kept = history.employee_history(x.spark, run_dir(x.spark, "history"), people, changes)
    middle = changes.agg(F.expr("percentile_approx(change_id, 0.5)")).first()[0] or 0
    old = F.when(F.col("department_id") == 1, F.concat("job_title", F.lit(" (old)"))).otherwise(F.col("job_title"))
    history.update_employees(kept, people.withColumn("job_title", old), changes.filter(F.col("change_id") <= middle))
    history.update_employees(kept, people, changes)
    return history.read_employees(kept, binding.AS_OF)


@query("mart_headcount_incremental")
def _(x):
    """The headcount after a first load without every fifth employee and half of the changes, and then the rest."""
    people, changes = x.view("stg_employees"), x.view("stg_job_changes")
    kept = history.employee_history(x.spark, run_dir(x.spark, "history"), people, changes)
    state = history.HeadcountState(x.spark, run_dir(x.spark, "headcount"))
    middle = changes.agg(F.expr("percentile_approx(change_id, 0.5)")).first()[0] or 0
    early = people.filter("CAST(right(employee_id, 2) AS INT) % 5 <> 0").withColumn("status", F.lit("active"))
    history.update_employees(kept, early, changes.filter(F.col("change_id") <= middle))
    state.update(kept)
    history.update_employees(kept, people, changes)
    state.update(kept)
    return marts.headcount_from_state(
        state.read(), x.table("dim_date"), x.table("dim_department"), x.table("dim_job_level"), binding.HEADCOUNT_START, binding.AS_OF
    )


@query("mart_compensation_sketched")
def _(x):
    rows = sketches.sketched_compensation(x.table("fct_salary"), x.table("dim_employee"), x.table("dim_department"), x.table("dim_job_level"))
    return rows.drop("sketch", "n", "low", "high", "total")


@query("sketched_percentiles")
def _(x):
    """Salary events by department and level, rolled up to departments: exact counts, and whether the ranks are near enough."""
    ps = {"p25": "0.25", "p50": "0.50", "p75": "0.75"}
    place = dims.current(x.table("dim_employee")).select("employee_id", "department_id", "level_id")
    rows = x.table("fct_salary").select("employee_id", "salary_amount").join(place, "employee_id")
    fine = sketches.quantile_sketches(rows, ["department_id", "level_id"], "salary_amount")
    out = []
    for found, group in ((fine, ["department_id", "level_id"]), (sketches.roll_up(fine, ["department_id"]), ["department_id"])):
        guess = sketches.sketched_percentiles(found, group, ps).join(found.select(*group, "n", "low", "high"), group)
        v = F.col("salary_amount").cast("double")
        parts = [c for p in ps for c in (F.count_if(v < F.col(p)).alias(f"below_{p}"), F.count_if(v <= F.col(p)).alias(f"upto_{p}"))]
        ranks = rows.join(F.broadcast(guess), group).groupBy(*group, "n", "low", "high").agg(*parts)
        near = []
        for p, share in ps.items():
            row = F.floor(F.col("n") * F.lit(float(share))) + 1
            off = F.greatest(F.col(f"below_{p}") + 1 - row, row - F.col(f"upto_{p}"), F.lit(0))
            near.append((off <= F.ceil(F.col("n") * sketches.RANK_ERROR)).cast("int").alias(f"{p}_near"))
        level = F.col("level_id") if "level_id" in group else F.lit(None).cast("long").alias("level_id")
        out.append(ranks.select("department_id", level, "n", "low", "high", *near))
    return out[0].unionByName(out[1])


def _distinct(x, months, exact, keys, names):
    """Quarters merged from month sketches beside exact counts: those, and whether the estimates are within 2 %."""
    guess = sketches.estimates(sketches.quarterly(months, names), keys, names)
    both = exact.join(guess.select(*keys, *[F.col(n).alias(f"{n}_guess") for n in names]), keys)
    near = [(F.abs(F.col(f"{n}_guess") - F.col(n)) <= 0.02 * F.col(n)).cast("int").alias(f"{n}_near") for n in names]
    return both.select(*keys, *names, *near)


@query("headcount_distinct")
def _(x):
    people = dims.current(x.table("dim_employee"))
    months = x.table("dim_date").filter((F.col("day") == 1) & F.col("date_day").between(binding.HEADCOUNT_START, binding.AS_OF))
    there = (F.col("hire_date") <= F.col("last_day_of_month")) & (F.col("exit_date").isNull() | (F.col("exit_date") > F.col("last_day_of_month")))
    listed = people.select("employee_id", "department_id", "hire_date", "exit_date").join(F.broadcast(months), there)
    exact = listed.groupBy("year_quarter", "department_id").agg(F.countDistinct("employee_id").alias("employees"))
    found = sketches.headcount_sketches(x.table("dim_employee"), x.table("dim_date"), str(binding.HEADCOUNT_START), str(binding.AS_OF))
    return _distinct(x, found, exact, ["year_quarter", "department_id"], ["employees"])


@query("hiring_distinct")
def _(x):
    stages = ["applied", "screening", "offer"]
    events = x.view("stg_recruitment_events")
    reached = [F.countDistinct(F.when(F.col("stage") == s, F.col("candidate_id"))).alias(s) for s in stages]
    exact = events.groupBy(quarter_key(F.col("stage_date")).alias("year_quarter"), "department_id").agg(*reached)
    return _distinct(x, sketches.hiring_sketches(events, stages), exact, ["year_quarter", "department_id"], stages)


@query("scd2_as_of")
def _(x):
    return dims.scd2_as_of(x.table("dim_employee"), "employee_id", binding.CUTOFF).select(
        "employee_sk", "employee_id", "level_id", "valid_from", "valid_to"
    )


@query("last_by_key")
def _(x):
    return ordered.last_by_key(x.view("stg_salary_history"), "employee_id", ["effective_date", "salary_id"])


def _priced(x):
    return x.star("orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
    )


@query("rolling_mean")
def _(x):
    return ordered.rolling_mean(_priced(x), "o_custkey", "order_date", ["o_orderkey"], "price", 3, 4, "mean_3")


@query("lag_delta")
def _(x):
    return ordered.lag_delta(_priced(x), "o_custkey", "order_date", ["o_orderkey"], "price", 2, "price_delta")


@query("pct_change")
def _(x):
    return ordered.pct_change(_priced(x), "o_custkey", "order_date", ["o_orderkey"], "price", 2, "price_change_pct")


@query("snapshot_counts")
def _(x):
    ship = x.star("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.col("l_shipdate").cast("date")).alias("shipped")
    )
    orders = x.star("orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("ordered")
    ).join(ship, "o_orderkey", "left")
    return marts.snapshot_counts(
        orders, "ordered", "shipped", ["o_orderpriority"], (binding.HEADCOUNT_START, binding.AS_OF),
        {"open_orders": F.lit(1), "key_sum": F.col("o_orderkey")},
    )


@query("discrete_percentile")
def _(x):
    lines = x.star("lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    )
    return marts.discrete_percentile(
        lines, ["l_returnflag", "l_linestatus"], "price", {"p25": "0.25", "p50": "0.50", "p75": "0.75", "p90": "0.90"}
    )


@query("funnel_conversion")
def _(x):
    stages = ("applied", "screening", "interview", "offer", "hired")
    return marts.funnel_conversion(x.view("stg_recruitment_events"), "department_id", "stage", "candidate_id", stages)


@query("safe_rate")
def _(x):
    counts = x.star("lineitem").groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_quantity") > 1000).alias("huge"),
    )
    return counts.withColumns(
        {"returned_pct": safe_rate("returned", "lines", 2), "returned_of_huge_pct": safe_rate("returned", "huge", 2)}
    )


# ---------------------------------------------------------------- exports

for _name, _source in (
    ("exp_departments", "dim_department"),
    ("exp_levels", "dim_job_level"),
    ("exp_headcount", "mart_headcount"),
    ("exp_attrition", "mart_attrition"),
    ("exp_compensation", "mart_compensation"),
    ("exp_hiring", "mart_hiring"),
):
    query(_name)(lambda x, n=_name, s=_source: getattr(exports, n)(x.table(s)))


@query("perf_dist")
def _(x):
    return exports.perf_dist(x.table("fct_performance"), x.table("dim_employee"))


@query("perf_by_dept")
def _(x):
    return exports.perf_by_dept(x.table("fct_performance"), x.table("dim_employee"), x.table("dim_department"))


@query("latest_scores")
def _(x):
    return exports.latest_scores(x.scores)


@query("risk_bands")
def _(x):
    return exports.risk_bands(x.risk_totals)


@query("risk_bands_by_dept")
def _(x):
    return exports.risk_bands_by_dept(x.risk_totals, x.table("dim_department"))


@query("risk_bands_by_level")
def _(x):
    return exports.risk_bands_by_level(x.risk_totals, x.table("dim_job_level"))


@query("risk_bands_by_dept_level")
def _(x):
    return exports.risk_bands_by_dept_level(x.risk_totals, x.table("dim_department"), x.table("dim_job_level"))


@query("risk_by_dept")
def _(x):
    return exports.risk_by_dept(x.risk_totals, x.table("dim_department"))


@query("risk_detail")
def _(x):
    return exports.risk_detail(
        x.scores, x.table("dim_employee"), x.table("dim_department"), x.table("dim_job_level"), x.table("fct_performance")
    )


@query("driver_labels")
def _(x):
    return exports.driver_labels(x.scores.select("employee_id", "scored_at", "driver_1", "driver_2", "driver_3"))


# ---------------------------------------------------------------- report


def _hc(x):
    return x.table("mart_headcount")


def _report(name, build):
    query(name)(build)


for _key, _f in (("", SOME), ("_range", RANGE)):
    for _name in ("hc_kpis", "hc_change", "hc_yoy", "hc_breakdown"):
        _report(_name + _key, lambda x, n=_name, f=_f: getattr(report, n)(_hc(x), f))
    _report("hc_trend" + _key, lambda x, f=_f: report.hc_trend(_hc(x), x.table("dim_department"), f))

_report("filter_dept", lambda x: report.filter_dept(exports.exp_attrition(x.table("mart_attrition")), SOME))
_report("filter_dept_level", lambda x: report.filter_dept_level(exports.exp_headcount(_hc(x)), SOME))
_report("months_in_range", lambda x: report.months_in_range(_hc(x), RANGE))
_report("quarters_in_range", lambda x: report.quarters_in_range(_hc(x), RANGE))
_report("last_n_months", lambda x: report.last_n_months(_hc(x), 24))
_report("filter_headcount", lambda x: report.filter_headcount(_hc(x), SOME))
_report("filter_attrition", lambda x: report.filter_attrition(x.table("mart_attrition"), _hc(x), SOME))
_report("filter_hiring", lambda x: report.filter_hiring(x.table("mart_hiring"), _hc(x), SOME))
_report("filter_perf_dist", lambda x: report.filter_perf_dist(x.perf_dist, _hc(x), SOME))
_report("filter_perf_by_dept", lambda x: report.filter_perf_by_dept(x.perf_by_dept, _hc(x), SOME))
_report("hc_breakdown_all", lambda x: report.hc_breakdown(_hc(x), ALL))
_report("attrition_kpis", lambda x: report.attrition_kpis(x.table("mart_attrition"), _hc(x), RANGE))
_report("completed_quarters", lambda x: report.completed_quarters(x.table("mart_attrition")))
_report("latest_completed_rate", lambda x: report.latest_completed_rate(x.table("mart_attrition")))
_report("attrition_by_quarter", lambda x: report.attrition_by_quarter(x.table("mart_attrition"), _hc(x), ALL))
_report("attrition_rank", lambda x: report.attrition_rank(x.table("mart_attrition"), _hc(x), SOME))
_report("attrition_yoy", lambda x: report.attrition_yoy(x.table("mart_attrition"), _hc(x), RANGE))
_report("perf_buckets", lambda x: report.perf_buckets(x.perf_dist, _hc(x), SOME))
_report("perf_summary", lambda x: report.perf_summary(x.perf_dist, _hc(x), RANGE))
_report("perf_by_dept_summary", lambda x: report.perf_by_dept_summary(x.perf_by_dept, x.perf_dist, _hc(x), RANGE))
_report("comp_summary", lambda x: report.comp_summary(x.table("mart_compensation"), ReportFilter(dept=2)))
_report("comp_by_level", lambda x: report.comp_by_level(x.table("mart_compensation"), ALL))
_report("comp_rank_dept", lambda x: report.comp_rank_dept(x.table("mart_compensation"), ALL))
_report("hiring_summary", lambda x: report.hiring_summary(x.table("mart_hiring"), _hc(x), RANGE))
_report("hiring_trend", lambda x: report.hiring_trend(x.table("mart_hiring"), _hc(x), SOME))
_report("hiring_yoy", lambda x: report.hiring_yoy(x.table("mart_hiring"), _hc(x), RANGE))
_report("band_counts", lambda x: report.band_counts(x.risk_detail, ReportFilter(dept=2)))
_report("risk_filtered", lambda x: report.risk_filtered(x.risk_detail, RISKY))
_report("risk_filtered_some", lambda x: report.risk_filtered(x.risk_detail, LONG_SERVICE))
_report("risk_filtered_top", lambda x: report.risk_filtered(x.risk_detail, LONG_SERVICE, 5))
_report("export_risk_csv_some", lambda x: report.export_risk_csv(x.risk_detail, LONG_SERVICE))
_report("risk_heatmap", lambda x: report.risk_heatmap(x.risk_detail, x.table("dim_department"), x.table("dim_job_level"), ALL))
_report("risk_hotspot", lambda x: report.risk_hotspot(x.risk_detail, ALL))
_report("most_common_driver", lambda x: report.most_common_driver(x.risk_detail, ALL))
_report("export_headcount_csv", lambda x: report.export_headcount_csv(_hc(x), SOME))
_report("export_attrition_csv", lambda x: report.export_attrition_csv(x.table("mart_attrition"), _hc(x), SOME))
_report("export_comp_csv", lambda x: report.export_comp_csv(x.table("mart_compensation"), ReportFilter(dept=2)))
_report("export_hiring_csv", lambda x: report.export_hiring_csv(x.table("mart_hiring"), _hc(x), SOME))
_report("export_risk_csv", lambda x: report.export_risk_csv(x.risk_detail, RISKY))


@query("delta")
def _(x):
    pairs = x.view("stg_job_changes").filter(F.col("change_type") == "promotion").groupBy("from_dept_id").agg(
        F.count_if(F.year("change_date") == 1998).alias("cur"), F.count_if(F.year("change_date") == 1997).alias("prev")
    )
    rows = pairs.withColumns({"up_is_good": delta("cur", "prev"), "up_is_bad": delta("cur", "prev", True)})
    return rows.select(
        "from_dept_id", "cur", "prev", F.col("up_is_good.diff").alias("diff"), F.col("up_is_good.pct").alias("pct"),
        F.col("up_is_good.direction").alias("direction"), F.col("up_is_good.good").alias("good"),
        F.col("up_is_bad.good").alias("good_if_lower"),
    )


@query("status_of")
def _(x):
    rates = report.statuses(x.table("mart_attrition"), "attrition", "attrition_rate_pct").select(
        F.lit("attrition").alias("kind"), F.concat_ws("|", "exit_year_quarter", "department_id").alias("key"),
        "status", "status_label",
    )
    quarter = F.concat_ws("|", F.coalesce("year_quarter", F.lit("?")), "department_id").alias("key")
    hiring = x.table("mart_hiring")
    hire = hiring.select(F.lit("hire").alias("kind"), quarter, status_of("hire", "overall_hire_rate_pct").alias("status"))
    tth = hiring.select(F.lit("tth").alias("kind"), quarter, status_of("tth", "avg_days_to_hire").alias("status"))
    place = F.concat_ws("|", "department_id", "level_id").alias("key")
    spread = x.table("mart_compensation").select(
        F.lit("spread").alias("kind"), place, status_of("spread", "salary_spread_pct").alias("status")
    )
    month = F.concat_ws("|", "year_month_key", "department_id", "level_id").alias("key")
    female = _hc(x).select(F.lit("female").alias("kind"), month, status_of("female", "pct_female").alias("status"))
    perf = x.table("fct_performance").select(
        F.lit("perf").alias("kind"), F.col("review_id").cast("string").alias("key"), status_of("perf", "score").alias("status")
    )
    others = hire.unionByName(tth).unionByName(spread).unionByName(female).unionByName(perf)
    return rates.unionByName(others.withColumn("status_label", status_label("status")))


@query("tenure_group")
def _(x):
    return x.table("dim_employee").select(
        "employee_sk", "tenure_days", tenure_group("tenure_days").alias("tenure_group"),
        tenure_years("tenure_days").alias("tenure_years"),
    )


def _status_metrics(x, f):
    return rules.status_metrics(
        x.table("mart_attrition"), _hc(x), x.perf_dist, x.table("mart_compensation"), x.table("mart_hiring"), f
    )


_report("insights", lambda x: rules.insights(_status_metrics(x, ReportFilter())))
_report("recommendations", lambda x: rules.recommendations(_status_metrics(x, ReportFilter())))
_report("ml_insights", lambda x: rules.ml_insights(rules.risk_metrics(x.risk_detail, ALL)))
_report("ml_recommendations", lambda x: rules.ml_recommendations(rules.risk_metrics(x.risk_detail, ALL)))
_report("attrition_alert", lambda x: rules.attrition_alert(x.table("mart_attrition")))

# ---------------------------------------------------------------- features and models

_report("feat_population", lambda x: features.feat_population(x.table("dim_employee"), binding.CUTOFF))
_report("feat_performance", lambda x: features.feat_performance(x.table("fct_performance"), binding.CUTOFF))
_report("feat_salary", lambda x: features.feat_salary(x.table("fct_salary"), binding.CUTOFF))
_report("dept_attrition_rate", lambda x: features.dept_attrition_rate(x.table("dim_employee"), binding.CUTOFF))


@query("label_within")
def _(x):
    people = dims.current(x.table("dim_employee"))
    return people.select("employee_id", features.label_within("exit_date", binding.CUTOFF).alias(LABEL))


@query("years_between")
def _(x):
    ref = F.lit(str(binding.AS_OF)).cast("date")
    people = dims.current(x.table("dim_employee"))
    return people.select(
        "employee_id", years_between("birth_date", ref).alias("age"), years_between("exit_date", ref).alias("since_exit")
    )


@query("build_features")
def _(x):
    return features.build_features(
        x.table("dim_employee"), x.table("fct_performance"), x.table("fct_salary"), binding.CUTOFF
    )


@query("one_hot")
def _(x):
    rows = x.features(binding.CUTOFF).select("employee_id", "gender", "employment_type", "age")
    return features.one_hot(rows, features.observed_values(rows))


@query("align_features")
def _(x):
    rows = features.one_hot(x.features(binding.CUTOFF).select("employee_id", "gender", "age"), {"gender": ["male"]})
    return features.align_features(rows, ["age", "gender_female", "gender_male"])


@query("stratified_split")
def _(x):
    return features.stratified_split(x.features(binding.CUTOFF).select("employee_id", LABEL), LABEL, "employee_id")


@query("stratified_kfold")
def _(x):
    return features.stratified_kfold(x.features(binding.CUTOFF).select("employee_id", LABEL), LABEL, "employee_id")


_report("class_weight", lambda x: features.class_weight(x.features(binding.CUTOFF), LABEL))
_report(
    "linear_contributions",
    lambda x: explain.linear_contributions(x.features(binding.CUTOFF), WEIGHTS, CENTERS)
    .select("employee_id", F.inline("contributions")),
)
_report(
    "top_drivers",
    lambda x: x.labelled.select(
        "employee_id", *[c for i in (1, 2, 3) for c in (f"driver_{i}", f"driver_{i}_impact")]
    ),
)
_report("risk_band", lambda x: x.labelled.select("employee_id", "risk_score", risk_band("risk_score").alias("risk_band")))
_report("roc_auc", lambda x: metrics.roc_auc(x.labelled, LABEL, "risk_score"))
_report("average_precision", lambda x: metrics.average_precision(x.labelled, LABEL, "risk_score"))
_report("brier_score", lambda x: metrics.brier_score(x.labelled, LABEL, "risk_score"))
_report("confusion_matrix", lambda x: metrics.confusion_matrix(x.labelled, LABEL, "risk_score"))
_report("classification_report", lambda x: metrics.classification_report(x.labelled, LABEL, "risk_score"))
_report("threshold_sweep", lambda x: metrics.threshold_sweep(x.labelled, LABEL, "risk_score"))
_report("calibration_curve", lambda x: metrics.calibration_curve(x.labelled, LABEL, "risk_score"))
_report("single_feature_auc", lambda x: metrics.single_feature_auc(x.labelled, LABEL))


@query("verdict")
def _(x):
    """Judged on the fixed score: folds for the mean and deviation, the last review alone as the baseline."""
    folds = features.stratified_kfold(x.labelled.select("employee_id", LABEL, "risk_score", "last_score"), LABEL, "employee_id")
    cv = metrics.roc_auc_by(folds, ["fold"], LABEL, "risk_score").agg(
        F.round(F.avg("auc_roc"), 4).alias("auc_roc_mean"), F.round(F.stddev_pop("auc_roc"), 4).alias("auc_roc_std")
    )
    oot = metrics.roc_auc(x.labelled, LABEL, "risk_score").select(F.round("auc_roc", 4).alias("auc_roc"))
    low = folds.withColumn("s", -F.col("last_score"))
    base = metrics.roc_auc(low, LABEL, "s").select(F.round("auc_roc", 4).alias("auc_roc_mean"))
    return metrics.verdict(oot, cv, base)


# Models are fitted with their full settings. SQL can't repeat a fit, so these queries return what it must hold to: who is
# in which part, class shares, and properties of the fit as 0 or 1.


def _in_range(c) -> Column:
    return F.col(c).between(0.0, 1.0).cast("int")


@query("train_gbt")
def _(x):
    scored = models.predict(x.tree_model, x.parts).withColumn("in_range", _in_range("probability"))
    auc = metrics.roc_auc(scored.filter("split = 'train'"), LABEL, "probability").scalar()
    return scored.select("employee_id", LABEL, "split", "in_range", (auc > 0.5).cast("int").alias("better_than_chance"))


@query("train_logreg")
def _(x):
    train = models.with_weight(x.parts.filter("split = 'train'"))
    model = models.train_logreg(train, x.columns)
    # At the optimum the weighted errors of the training rows cancel out.
    error = F.col("weight") * (F.col("probability") - F.col(LABEL))
    mean = models.predict(model, train).agg(F.sum(error) / F.sum("weight")).scalar()
    scored = models.predict(model, x.parts).withColumn("in_range", _in_range("probability"))
    return scored.select("employee_id", LABEL, "split", "in_range", (F.abs(mean) < 1e-4).cast("int").alias("at_optimum"))


@query("feature_importance")
def _(x):
    rows = models.feature_importance(x.spark, x.tree_model)
    total = rows.agg(F.sum("importance")).scalar()
    return rows.select("feature", _in_range("importance").alias("in_range"), (F.abs(total - 1) < 1e-9).cast("int").alias("sums_to_one"))


@query("score_active")
def _(x):
    today = features.align_features(features.one_hot(x.features(binding.AS_OF, False), x.codes), x.columns)
    rows = models.score_active(x.tree_model, today, binding.AS_OF)
    rows = explain.score_rows(explain.top_drivers(explain.explain_trees(x.tree_model, rows)))
    half = number("0.00005")
    agrees = F.col("risk_band").isin(risk_band(F.col("risk_score") - half), risk_band(F.col("risk_score") + half))
    return rows.select("employee_id", "scored_at", _in_range("risk_score").alias("in_range"), agrees.cast("int").alias("band_agrees"))


@query("explain_trees")
def _(x):
    shares = explain.explain_trees(x.tree_model, explain.tree_margin(x.tree_model, x.parts))
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c["impact"])
    gap = F.abs(F.col("base") + total - F.col("margin"))
    return shares.select("employee_id", (gap < 1e-6).cast("int").alias("adds_up"))


@query("explain_linear")
def _(x):
    model = models.train_logreg(models.with_weight(x.parts), x.columns)
    shares = explain.explain_linear(model, models.predict(model, x.parts))
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c["impact"])
    gap = F.abs(1 / (1 + F.exp(-(F.col("base") + total))) - F.col("probability"))
    return shares.select("employee_id", (gap < 1e-6).cast("int").alias("adds_up"))


def _by_ranks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Both ranking metrics by another way: mean ranks of the positive rows, and the precision at each of them."""
    p, y = F.col("probability"), F.col(LABEL)
    up = Window.partitionBy(*keys).orderBy(p)
    down = Window.partitionBy(*keys).orderBy(p.desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy(*keys, "probability")
    ranked = rows.select(*keys, y, (F.rank().over(up) + (F.count(F.lit(1)).over(same) - 1) / 2).alias("r"), (F.sum(y).over(down) / F.count(F.lit(1)).over(down)).alias("hit"))
    pos, n = F.sum(y), F.count(F.lit(1))
    auc = (F.sum(F.when(y == 1, F.col("r"))) - pos * (pos + 1) / 2) / (pos * (n - pos))
    return ranked.groupBy(*keys).agg(auc.alias("auc_roc"), F.avg(F.when(y == 1, F.col("hit"))).alias("auc_pr"))


@query("kfold_cv")
def _(x):
    """Every row's fold, and whether the summary agrees with the metrics counted by ranks."""
    ranks = _by_ranks(x.cv, ["fold"]).agg(F.avg("auc_roc").alias("roc"), F.avg("auc_pr").alias("pr"), F.stddev_pop("auc_roc").alias("std"))
    row = models.kfold_summary(x.cv)
    near = [(c, (F.abs(F.col(a) - F.col(b)) < 1e-4).cast("int")) for c, a, b in (("roc_agrees", "auc_roc_mean", "roc"), ("pr_agrees", "auc_pr_mean", "pr"), ("std_agrees", "auc_roc_std", "std"))]
    checks_ = row.crossJoin(ranks).select("k", *[c.alias(n) for n, c in near])
    return x.cv.select("employee_id", LABEL, "fold", _in_range("probability").alias("in_range")).crossJoin(F.broadcast(checks_))


@query("out_of_time")
def _(x):
    """Every test row, the summary's counts, and whether its metrics agree with those counted by ranks."""
    ranks = _by_ranks(x.oot.withColumn("all", F.lit(1)), ["all"])
    row = models.out_of_time_summary(x.oot, x.early)
    rates = [F.round(c, 3).alias(c) for c in ("base_rate_train", "base_rate_test")]
    near = [(F.abs(F.round(r, 4) - o) < 2e-4).cast("int").alias(n) for r, o, n in ((F.col("roc"), F.col("auc_roc"), "roc_agrees"), (F.col("pr"), F.col("auc_pr"), "pr_agrees"))]
    checks_ = row.crossJoin(ranks.select(F.col("auc_roc").alias("roc"), F.col("auc_pr").alias("pr"))).select("n_train", "n_test", *rates, *near)
    return x.oot.select("employee_id", LABEL, _in_range("probability").alias("in_range")).crossJoin(F.broadcast(checks_))


@query("verdict_of_model")
def _(x):
    """The verdict on the trained trees: out of time, over folds and against the logistic baseline; each judgement by its rule."""
    oot, cv, base = x.summaries()
    row = metrics.verdict(oot, cv, base)
    given = oot.select(F.col("auc_roc").alias("o")).crossJoin(cv.select(F.col("auc_roc_mean").alias("c"), F.col("auc_roc_std").alias("s"))).crossJoin(base.select(F.col("auc_roc_mean").alias("l")))
    return row.crossJoin(given).select(
        ((F.col("oot_auc") == F.col("o")) & (F.col("cv_auc") == F.col("c")) & (F.col("cv_std") == F.col("s")) & (F.col("linear_auc") == F.col("l"))).cast("int").alias("fed"),
        (F.abs(F.col("drop") - (F.col("c") - F.col("o"))) < 1e-6).cast("int").alias("drop_agrees"),
        ((F.col("over_time") == "generalizes") == (F.round(F.col("c") - F.col("o"), 6) <= 0.04)).cast("int").alias("over_time_agrees"),
        ((F.col("over_folds") == "stable") == (F.col("s") <= 0.02)).cast("int").alias("over_folds_agrees"),
        ((F.col("signal") == "mostly_linear") == (F.col("l") >= F.col("c"))).cast("int").alias("signal_agrees"),
    )


# ---------------------------------------------------------------- data tests

_report("test_not_null", lambda x: checks.test_not_null(x.raw("raw_employees"), "raw_employees", ["employee_id", "gender", "manager_id"]))
_report("test_unique", lambda x: checks.test_unique(x.star("lineitem"), "lineitem", "l_orderkey"))
_report("test_accepted_values", lambda x: checks.test_accepted_values(x.view("stg_recruitment_events"), "stg_recruitment_events", "stage", ["applied", "screening", "offer"]))
_report("test_range", lambda x: checks.test_range(x.view("stg_performance_reviews"), "stg_performance_reviews", "score", number("2.00"), number("4.50")))
_report("test_expression", lambda x: checks.test_expression(x.table("dim_employee"), "dim_employee", "ends_after_start", F.col("valid_to") > F.col("valid_from")))
_report("test_relationships", lambda x: checks.test_relationships(x.raw("raw_performance_reviews"), "raw_performance_reviews", "manager_id", dims.current(x.table("dim_employee")).filter(F.col("exit_date").isNull()), "employee_id"))
_report("exit_tests", lambda x: checks.exit_tests(x.view("stg_job_changes")))


def _tables(x):
    tables = {source: x.raw(source) for source, _ in staging.STAGING.values()}
    return {**tables, **{name: x.table(name) for name in warehouse.ALL_MODELS}}


@query("declared_tests_observed")
def _(x):
    """The declared tests counted while their tables are first written; staging models are views and are tested as such."""
    declared, found = {t.table: t for t in checks.DECLARED}, {}

    def write(df, path, name):
        if name not in declared:
            return materialize(df, path)
        done = checks.publish_tested(df, path, declared[name])
        found[name] = [done.results]
        return done.table

    tables = _tables(Lab(x.spark, x.sf_dir, write=write))
    found |= {name: declared[name].run(tables[name]) for name in staging.STAGING if name in declared}
    return reduce(DataFrame.unionByName, [rows for t in checks.DECLARED for rows in found[t.table]])


_report("declared_tests", lambda x: checks.declared_tests(_tables(x)))
_report("reference_tests", lambda x: checks.reference_tests(_tables(x)))


# ---------------------------------------------------------------- pipeline


@query("run_models")
def _(x):
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("model"), "row_count")
        for name, df in _tables(x).items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("run_daily")
def _(x):
    """A whole day with the stored tree model: what it published, the alert, who was scored, and whether the sections add up."""
    root = run_dir(x.spark, "daily")
    load = loads.LoadConfig(x.source, f"{root}/raw", binding.LOADED_AT)
    result = run_daily(
        x.spark, load, f"{root}/models", f"{root}/published", as_of=binding.AS_OF,
        headcount_start=binding.HEADCOUNT_START, calendar=binding.calendar_span(x.spark, x.sf_dir),
        scorer=x.tree_scores,
    )
    published = _section_lines(x.spark, f"{root}/published/export", SECTIONS)
    alert = json_line(result.alert).select(F.lit("alert").alias("section"), "value")
    detail = x.spark.read.schema("employee_id string, risk_band string, risk_score double").json(f"{root}/published/export/risk/top")
    kept = result.scores.join(detail.select("employee_id", F.col("risk_band").alias("band"), F.col("risk_score").alias("shown")), "employee_id")
    agrees = (F.col("risk_band") == F.col("band")) & F.col("risk_score").between(0, 1) & (F.abs(F.col("risk_score") - F.col("shown")) < 1e-9)
    scored = kept.select(F.lit("scores").alias("section"), F.concat_ws(" ", "employee_id", "scored_at", agrees.cast("int")).alias("value"))
    bands = x.spark.read.schema("risk_band string, cnt long").json(f"{root}/published/export/risk/bands").agg(F.sum("cnt").cast("string").alias("value"))
    failures = result.tests.agg(F.concat_ws(" ", F.count(F.lit(1)), F.sum("failures")).alias("value"))
    parts = [published, alert, scored, bands.select(F.lit("risk/bands").alias("section"), "value"), failures.select(F.lit("tests").alias("section"), "value")]
    return reduce(DataFrame.unionByName, parts)
