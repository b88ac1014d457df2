"""Report operators over the marts: filters, KPIs, trends, rankings and comparisons.

The marts are small (months or quarters x departments x levels); only the risk operators read one row per employee.
Means that the report shows unrounded are given with four decimals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.functions.scalar import (
    delta,
    month_to_quarter,
    ratio,
    safe_rate,
    status_label,
    status_of,
    tenure_group,
    weighted_mean,
    year_before,
)


@dataclass(frozen=True)
class ReportFilter:
    """What a report reader selected; None means all."""

    dept: int | None = None
    level: int | None = None
    month_start: str | None = None
    month_end: str | None = None
    granularity: str = "quarter"  # month | quarter
    gender: str | None = None  # female | male
    band: str | None = None  # high | medium | low
    tenure: str | None = None  # lt2 | 2to5 | gt5

    @property
    def headcount_column(self) -> str:
        return "headcount" if self.gender is None else f"headcount_{self.gender}"


# ---------------------------------------------------------------- filters


def filter_dept(df: DataFrame, f: ReportFilter) -> DataFrame:
    return df if f.dept is None else df.filter(F.col("department_id") == f.dept)


def filter_dept_level(df: DataFrame, f: ReportFilter) -> DataFrame:
    """Level is ignored where the grain does not have it."""
    out = filter_dept(df, f)
    if f.level is None or "level_id" not in df.columns:
        return out
    return out.filter(F.col("level_id") == f.level)


def _in_months(column: str, f: ReportFilter) -> Column:
    bounds = sorted(m for m in (f.month_start, f.month_end) if m is not None)
    c = F.col(column)
    if len(bounds) == 2:
        return c.between(*bounds)
    if f.month_start is not None:
        return c >= f.month_start
    return c <= f.month_end if f.month_end is not None else F.lit(True)


def months_in_range(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Selected months, ends included and in either order."""
    return headcount.filter(_in_months("year_month_key", f)).select("year_month_key").distinct()


def quarters_in_range(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return months_in_range(headcount, f).select(month_to_quarter("year_month_key").alias("year_quarter")).distinct()


def last_n_months(headcount: DataFrame, n: int | None) -> DataFrame:
    """The newest ``n`` months; None gives all."""
    months = headcount.select("year_month_key").distinct()
    return months if n is None else months.orderBy(F.desc("year_month_key")).limit(n)


def filter_headcount(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return filter_dept_level(headcount, f).filter(_in_months("year_month_key", f))


def _by_quarter(df: DataFrame, headcount: DataFrame, f: ReportFilter, column: str) -> DataFrame:
    quarters = quarters_in_range(headcount, f).withColumnRenamed("year_quarter", column)
    return filter_dept(df, f).join(quarters, column, "left_semi")


def filter_attrition(attrition: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return _by_quarter(attrition, headcount, f, "exit_year_quarter")


def filter_hiring(hiring: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return _by_quarter(hiring, headcount, f, "year_quarter")


def filter_perf_dist(perf_dist: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return _by_quarter(perf_dist, headcount, f, "year_quarter")


def filter_perf_by_dept(perf_by_dept: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return _by_quarter(perf_by_dept, headcount, f, "year_quarter")


# ---------------------------------------------------------------- headcount


def _zero(column: Column | str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _monthly(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Totals of every selected month, zero where the filtered scope has no rows."""
    rows = filter_headcount(headcount, f)
    tenure = (F.coalesce("avg_tenure_years", F.lit(0)).cast("decimal(8,2)") * F.col("headcount")).cast("decimal(22,2)")
    sums = rows.groupBy("year_month_key").agg(
        F.sum("headcount").alias("headcount"),
        F.sum("headcount_female").alias("headcount_female"),
        F.sum("headcount_male").alias("headcount_male"),
        F.sum(tenure).alias("tenure"),
    )
    out = months_in_range(headcount, f).join(sums, "year_month_key", "left")
    return out.fillna(0, ["headcount", "headcount_female", "headcount_male"]).withColumn(
        "tenure", F.coalesce("tenure", F.lit(0))
    )


def hc_kpis(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Latest month against the one before, share of women and headcount-weighted tenure."""
    monthly = _monthly(headcount, f)
    month, row = F.col("year_month_key"), F.struct("year_month_key", "headcount", "headcount_female", "headcount_male", "tenure")
    earlier = month < monthly.agg(F.max("year_month_key")).scalar()
    both = monthly.agg(F.max_by(row, month).alias("c"), F.max_by(row, F.when(earlier, month)).alias("p"))
    cur, prev = F.col("c.headcount"), F.coalesce("p.headcount", F.lit(0))
    return both.select(
        F.col("c.year_month_key").alias("latest_month"),
        cur.alias("headcount"),
        prev.alias("prev_headcount"),
        (cur - prev).alias("change"),
        F.coalesce(safe_rate(cur - prev, prev, 4), F.lit(0)).alias("change_pct"),
        F.col("c.headcount_female").alias("headcount_female"),
        F.col("c.headcount_male").alias("headcount_male"),
        F.coalesce(safe_rate("c.headcount_female", cur, 4), F.lit(0)).alias("pct_female"),
        F.coalesce(ratio("c.tenure", cur, 4), F.lit(0)).alias("avg_tenure_years"),
    )


def hc_trend(headcount: DataFrame, dim_department: DataFrame, f: ReportFilter) -> DataFrame:
    """Headcount of every department by month, or by quarter as the last selected month of the quarter; 0 without rows."""
    sums = filter_headcount(headcount, f).groupBy("year_month_key", "department_id").agg(
        F.sum("headcount").alias("headcount")
    )
    axis = months_in_range(headcount, f)
    if f.granularity == "month":
        axis = axis.withColumn("period", F.col("year_month_key"))
    else:
        axis = axis.groupBy(month_to_quarter("year_month_key").alias("period")).agg(
            F.max("year_month_key").alias("year_month_key")
        )
    # Every period meets every department: one equal key for both small dimensions.
    names = filter_dept(dim_department.select("department_id", "department_name"), f).withColumn("_all", F.lit(1))
    grid = axis.select("period", "year_month_key", F.lit(1).alias("_all")).join(names, "_all").drop("_all")
    filled = grid.join(sums, ["year_month_key", "department_id"], "left").fillna(0, ["headcount"])
    return filled.select("period", "department_id", "department_name", "headcount")


def hc_change(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """First against last selected month, and the mean change per period."""
    column = f.headcount_column
    ends = _monthly(headcount, f).agg(
        F.min("year_month_key").alias("start_month"),
        F.max("year_month_key").alias("end_month"),
        F.min_by(column, "year_month_key").alias("start_headcount"),
        F.max_by(column, "year_month_key").alias("end_headcount"),
        F.count(F.lit(1)).alias("months"),
        F.count_distinct(month_to_quarter("year_month_key")).alias("quarters"),
    )
    periods = F.greatest(F.col("months" if f.granularity == "month" else "quarters") - 1, F.lit(1))
    change = F.col("end_headcount") - F.col("start_headcount")
    return ends.select(
        "start_month",
        "end_month",
        "start_headcount",
        "end_headcount",
        change.alias("change"),
        F.coalesce(safe_rate(change, "start_headcount", 4), F.lit(0)).alias("change_pct"),
        periods.alias("periods"),
        ratio(change, periods, 4).alias("avg_per_period"),
        F.when(change > 0, "up").when(change < 0, "down").otherwise("flat").alias("direction"),
    )


def _against_last_year(
    rows: DataFrame, whole: DataFrame, key: str, others: list[str], value: str, invert_good: bool = False
) -> DataFrame:
    """Left self-join on the key shifted by one year; adds ``prev`` and the fields of ``delta``."""
    earlier = whole.select(F.col(key).alias("_before"), *others, F.col(value).alias("prev"))
    joined = rows.withColumn("_before", year_before(key)).join(earlier, ["_before", *others], "left").drop("_before")
    return joined.withColumn("_d", delta(value, "prev", invert_good)).select(*rows.columns, "prev", "_d.*")


def hc_yoy(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Month x department x level against the same month of the year before."""
    columns = ["year_month_key", "department_id", "department_name", "level_id", "level_name", "headcount",
               "headcount_female", "pct_female", "avg_tenure_years"]
    rows = filter_headcount(headcount, f).select(*columns)
    out = _against_last_year(rows, headcount, "year_month_key", ["department_id", "level_id"], "headcount")
    return out.withColumn("female_status", status_of("female", "pct_female"))


def hc_breakdown(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Last selected month by department, or by level once a department is chosen.

    Over all departments and genders the counts are split into women and men.
    """
    latest = months_in_range(headcount, f).agg(F.max("year_month_key")).scalar()
    rows = filter_headcount(headcount, f).filter(F.col("year_month_key") == latest)
    if f.dept is None and f.gender is None:
        return rows.groupBy(F.col("department_name").alias("name")).agg(
            F.sum("headcount_female").alias("female"), F.sum("headcount_male").alias("male")
        )
    name = "department_name" if f.dept is None else "level_name"
    return rows.groupBy(F.col(name).alias("name")).agg(F.sum(f.headcount_column).alias("headcount"))


# ---------------------------------------------------------------- attrition


def completed_quarters(attrition: DataFrame) -> DataFrame:
    """Quarters with a rate in any department, and their plain mean rate."""
    rated = attrition.filter(F.col("attrition_rate_pct").isNotNull())
    return rated.groupBy("exit_year_quarter").agg(
        ratio(F.sum("attrition_rate_pct"), F.count(F.lit(1)), 4).alias("mean_rate")
    )


def latest_completed_rate(attrition: DataFrame) -> DataFrame:
    """Last quarter with a rate and its mean rate; 0 and no quarter when there is none."""
    return completed_quarters(attrition).agg(
        F.max("exit_year_quarter").alias("latest_quarter"),
        F.coalesce(F.max_by("mean_rate", "exit_year_quarter"), F.lit(0)).alias("latest_rate"),
    )


def attrition_kpis(attrition: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Exits, voluntary share, mean rate, and the change from the first to the last quarter with a rate."""
    rate = F.col("attrition_rate_pct")
    quarters = (
        filter_attrition(attrition, headcount, f)
        .groupBy("exit_year_quarter")
        .agg(
            F.sum("exits_total").alias("exits"),
            F.sum("exits_voluntary").alias("voluntary"),
            F.sum(rate).alias("rate_sum"),
            F.count(rate).alias("rate_n"),
        )
        .withColumn("mean_rate", ratio("rate_sum", "rate_n", 4))
    )
    rated = F.when(F.col("rate_n") > 0, F.col("exit_year_quarter"))
    return quarters.agg(
        _zero("exits").alias("exits_total"),
        _zero("voluntary").alias("exits_voluntary"),
        F.coalesce(safe_rate(F.sum("voluntary"), F.sum("exits"), 4), F.lit(0)).alias("voluntary_pct"),
        F.coalesce(ratio(F.sum("rate_sum"), F.sum("rate_n"), 4), F.lit(0)).alias("avg_rate"),
        F.min(rated).alias("first_quarter"),
        F.max(rated).alias("latest_quarter"),
        F.min_by("mean_rate", rated).alias("first_rate"),
        F.max_by("mean_rate", rated).alias("latest_rate"),
    ).withColumn("rate_change", F.col("latest_rate") - F.col("first_rate"))


def attrition_by_quarter(attrition: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return filter_attrition(attrition, headcount, f).groupBy("exit_year_quarter").agg(
        *[F.sum(f"exits_{k}").alias(k) for k in ("voluntary", "involuntary", "retirement")]
    )


def attrition_rank(attrition: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Departments by mean rate, highest first. All departments are ranked, whatever is selected."""
    every = ReportFilter(month_start=f.month_start, month_end=f.month_end)
    rated = filter_attrition(attrition, headcount, every).filter(F.col("attrition_rate_pct").isNotNull())
    means = rated.groupBy("department_name").agg(
        ratio(F.sum("attrition_rate_pct"), F.count(F.lit(1)), 4).alias("mean_rate")
    )
    # One row per department.
    place = F.dense_rank().over(Window.orderBy(F.desc("mean_rate")))
    return means.select(
        "department_name", "mean_rate", status_of("attrition", "mean_rate").alias("status"), place.alias("rank")
    ).orderBy("rank", "department_name")


def attrition_yoy(attrition: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Exits against the same quarter of the year before; a rise is bad."""
    columns = ["exit_year_quarter", "department_id", "department_name", "exits_total", "exits_voluntary",
               "exits_involuntary", "attrition_rate_pct"]
    rows = filter_attrition(attrition, headcount, f).select(*columns)
    out = _against_last_year(rows, attrition, "exit_year_quarter", ["department_id"], "exits_total", True)
    return out.withColumns(
        {
            "voluntary_pct": F.coalesce(safe_rate("exits_voluntary", "exits_total", 4), F.lit(0)),
            "rate_status": status_of("attrition", "attrition_rate_pct"),
        }
    )


# ---------------------------------------------------------------- performance


def perf_buckets(perf_dist: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return filter_perf_dist(perf_dist, headcount, f).groupBy("score_bucket").agg(F.sum("cnt").alias("cnt"))


def perf_summary(perf_dist: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Bucket-weighted mean and the shares below 3 and from 4 upwards."""
    b, n = F.col("score_bucket"), F.col("cnt")
    sums = filter_perf_dist(perf_dist, headcount, f).agg(
        _zero("cnt").alias("total_reviews"),
        F.coalesce(weighted_mean(b, n, 4), F.lit(0)).alias("bucket_weighted_mean"),
        _zero(F.when(b < 3, n)).alias("cnt_low"),
        _zero(F.when(b >= 4, n)).alias("cnt_high"),
    )
    return sums.withColumns(
        {
            "low_pct": F.coalesce(safe_rate("cnt_low", "total_reviews", 4), F.lit(0)),
            "high_pct": F.coalesce(safe_rate("cnt_high", "total_reviews", 4), F.lit(0)),
        }
    )


def perf_by_dept_summary(
    perf_by_dept: DataFrame, perf_dist: DataFrame, headcount: DataFrame, f: ReportFilter
) -> DataFrame:
    """Mean score, reviews, and low and high counts per department."""
    b, n = F.col("score_bucket"), F.col("cnt")
    means = (
        filter_perf_by_dept(perf_by_dept, headcount, f)
        .groupBy("department_id", "department_name")
        .agg(ratio(F.sum("sum_score"), F.sum("n_reviews"), 2).alias("avg_score"), F.sum("n_reviews").alias("n_reviews"))
    )
    ends = (
        filter_perf_dist(perf_dist, headcount, f)
        .groupBy("department_id")
        .agg(_zero(F.when(b < 3, n)).alias("cnt_low"), _zero(F.when(b >= 4, n)).alias("cnt_high"))
    )
    return means.join(ends, "department_id", "left").fillna(0, ["cnt_low", "cnt_high"])


# ---------------------------------------------------------------- compensation


def comp_summary(compensation: DataFrame, f: ReportFilter) -> DataFrame:
    """Employees, weighted median, bands, and the band with the largest spread (the first one on a tie)."""
    widest = F.min(
        F.when(
            F.col("salary_spread_pct").isNotNull(),
            F.struct((-F.col("salary_spread_pct")).alias("s"), "department_id", "level_id", "department_name", "level_name"),
        )
    )
    return (
        filter_dept_level(compensation, f)
        .agg(
            _zero("employee_count").alias("employees"),
            F.coalesce(weighted_mean("salary_median", "employee_count", 4), F.lit(0)).alias("weighted_median"),
            F.count(F.lit(1)).alias("bands"),
            widest.alias("w"),
        )
        .select(
            "employees",
            "weighted_median",
            "bands",
            F.coalesce(-F.col("w.s"), F.lit(0)).alias("max_spread_pct"),
            F.col("w.department_name").alias("spread_department"),
            F.col("w.level_name").alias("spread_level"),
        )
    )


def comp_by_level(compensation: DataFrame, f: ReportFilter) -> DataFrame:
    """Headcount-weighted median per level, in level order."""
    return (
        filter_dept_level(compensation, f)
        .groupBy("level_id", "level_name")
        .agg(weighted_mean("salary_median", "employee_count", 4).alias("weighted_median"))
        .orderBy("level_id")
    )


def comp_rank_dept(compensation: DataFrame, f: ReportFilter) -> DataFrame:
    return (
        filter_dept_level(compensation, f)
        .groupBy("department_name")
        .agg(weighted_mean("salary_median", "employee_count", 4).alias("weighted_median"))
        .orderBy(F.desc("weighted_median"), "department_name")
    )


# ---------------------------------------------------------------- hiring


def hiring_summary(hiring: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Funnel totals, hire rate and hire-weighted days to hire."""
    stages = ("applied", "screening", "interview", "offer", "hired")
    hired = F.when(F.col("cnt_hired") > 0, F.col("cnt_hired"))
    sums = filter_hiring(hiring, headcount, f).agg(
        _zero("total_requisitions").alias("total_requisitions"),
        *[_zero(f"cnt_{s}").alias(f"cnt_{s}") for s in stages],
        F.coalesce(weighted_mean("avg_days_to_hire", hired, 4), F.lit(0)).alias("avg_days_to_hire"),
    )
    return sums.withColumn("hire_rate_pct", F.coalesce(safe_rate("cnt_hired", "cnt_applied", 4), F.lit(0)))


def hiring_trend(hiring: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return filter_hiring(hiring, headcount, f).groupBy("year_quarter").agg(F.sum("cnt_hired").alias("cnt_hired"))


def hiring_yoy(hiring: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    """Hires against the same quarter of the year before, with the cell statuses of the table."""
    columns = ["year_quarter", "department_id", "department_name", "cnt_applied", "cnt_offer", "cnt_hired",
               "overall_hire_rate_pct", "avg_days_to_hire"]
    rows = filter_hiring(hiring, headcount, f).select(*columns)
    out = _against_last_year(rows, hiring, "year_quarter", ["department_id"], "cnt_hired")
    days = F.col("avg_days_to_hire")
    return out.withColumns(
        {
            # The table cell knows two states for the hire rate and its own limits for the days.
            "rate_status": F.when(F.col("overall_hire_rate_pct") >= 5, "ok").otherwise("warn"),
            "days_status": F.when(days > 35, "bad").when(days > 25, "warn").otherwise("ok"),
        }
    )


# ---------------------------------------------------------------- risk


def band_counts(risk_detail: DataFrame, f: ReportFilter) -> DataFrame:
    band = F.col("risk_band")
    counts = filter_dept_level(risk_detail, f).agg(
        *[F.count_if(band == b).alias(b) for b in ("high", "medium", "low")]
    )
    total = F.col("high") + F.col("medium") + F.col("low")
    shares = [F.coalesce(safe_rate(b, total, 4), F.lit(0)).alias(f"{b}_pct") for b in ("high", "medium", "low")]
    return counts.select("high", "medium", "low", total.alias("total"), *shares)


def risk_selection(risk_detail: DataFrame, f: ReportFilter) -> DataFrame:
    """Scored employees of the selected department, level, band and tenure group; unknown tenure counts as 0."""
    out = filter_dept_level(risk_detail, f)
    if f.band is not None:
        out = out.filter(F.col("risk_band") == f.band)
    if f.tenure is not None:
        out = out.filter(tenure_group(F.coalesce("tenure_days", F.lit(0))) == f.tenure)
    return out


def risk_filtered(risk_detail: DataFrame, f: ReportFilter, top: int | None = None) -> DataFrame:
    """The selection, highest scores first: all of it, or its first ``top`` rows for a screen."""
    rows = risk_selection(risk_detail, f).orderBy(F.desc("risk_score"), "employee_id")
    return rows if top is None else rows.limit(top)


def risk_heatmap(risk_detail: DataFrame, dim_department: DataFrame, dim_job_level: DataFrame, f: ReportFilter) -> DataFrame:
    """High-risk counts of every department and level, zero filled, with the largest cell (at least 1).

    One row per department and level of the dimensions; a high-risk row at a level that the dimension lacks keeps its
    own row.
    """
    high = filter_dept_level(risk_detail, f).filter(F.col("risk_band") == "high")
    cells = high.groupBy("department_id", "level_name").agg(F.count(F.lit(1)).alias("high_risk"))
    departments = filter_dept(dim_department.select("department_id", "department_name"), f).withColumn("_all", F.lit(1))
    levels = dim_job_level.select("level_name", F.lit(1).alias("_all")).distinct()
    grid = departments.join(levels, "_all").select("department_id", "level_name")
    known = departments.select("department_id", "department_name")
    grid = grid.unionByName(cells.select("department_id", "level_name")).distinct().join(known, "department_id")
    grid = grid.join(cells, ["department_id", "level_name"], "left").fillna(0, ["high_risk"])
    largest = F.max("high_risk").over(Window.partitionBy())
    return grid.select("department_id", "department_name", "level_name", "high_risk", F.greatest(largest, F.lit(1)).alias("max_cell"))


def risk_hotspot(risk_detail: DataFrame, f: ReportFilter) -> DataFrame:
    """Department and level with the most high-risk employees; the first one on a tie."""
    high = filter_dept_level(risk_detail, f).filter(F.col("risk_band") == "high")
    groups = high.groupBy("department_id", "department_name", "level_id", "level_name").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return groups.orderBy(F.desc("cnt"), "department_id", "level_id").limit(1)


def most_common_driver(risk_detail: DataFrame, f: ReportFilter) -> DataFrame:
    """Most frequent first driver; between equals, the one of the highest-ranked employee."""
    rows = risk_selection(risk_detail, f).filter(F.col("driver_1") != "")
    first = F.min(F.struct((-F.col("risk_score")).alias("s"), F.col("employee_id").alias("e")))
    counts = rows.groupBy("driver_1").agg(F.count(F.lit(1)).alias("cnt"), first.alias("first"))
    return counts.orderBy(F.desc("cnt"), F.asc("first")).limit(1).select("driver_1", "cnt")


# ---------------------------------------------------------------- CSV sections


def export_headcount_csv(headcount: DataFrame, f: ReportFilter) -> DataFrame:
    latest = months_in_range(headcount, f).agg(F.max("year_month_key")).scalar()
    return filter_headcount(headcount, f).filter(F.col("year_month_key") == latest).select(
        F.col("year_month_key").alias("year_month"),
        F.col("department_name").alias("dept"),
        F.col("level_name").alias("level"),
        "headcount",
        F.col("headcount_female").alias("female"),
        F.col("headcount_male").alias("male"),
        "pct_female",
        "avg_tenure_years",
    )


def export_attrition_csv(attrition: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return filter_attrition(attrition, headcount, f).select(
        F.col("exit_year_quarter").alias("quarter"),
        F.coalesce("department_name", F.lit("All")).alias("dept"),
        "exits_total",
        "exits_voluntary",
        "exits_involuntary",
        "attrition_rate_pct",
    )


def export_comp_csv(compensation: DataFrame, f: ReportFilter) -> DataFrame:
    return filter_dept_level(compensation, f).select(
        F.col("department_name").alias("dept"),
        F.col("level_name").alias("level"),
        "employee_count",
        F.col("salary_p25").alias("p25"),
        F.col("salary_median").alias("median"),
        F.col("salary_p75").alias("p75"),
        F.col("salary_spread_pct").alias("spread_pct"),
    )


def export_hiring_csv(hiring: DataFrame, headcount: DataFrame, f: ReportFilter) -> DataFrame:
    return filter_hiring(hiring, headcount, f).select(
        F.col("year_quarter").alias("quarter"),
        F.col("department_name").alias("dept"),
        F.col("cnt_applied").alias("applied"),
        F.col("cnt_offer").alias("offer"),
        F.col("cnt_hired").alias("hired"),
        F.col("overall_hire_rate_pct").alias("hire_rate_pct"),
        F.col("avg_days_to_hire").alias("time_to_hire_days"),
    )


def export_risk_csv(risk_detail: DataFrame, f: ReportFilter) -> DataFrame:
    """The whole selection, not only the rows shown on screen."""
    return risk_selection(risk_detail, f).select(
        "employee_id",
        F.col("department_name").alias("dept"),
        F.col("level_name").alias("level"),
        "risk_score",
        "risk_band",
        "tenure_days",
        ratio(F.col("tenure_days") * 4, F.lit(1461), 1).alias("tenure_years"),
        F.coalesce("last_review_quarter", F.lit("")).alias("last_review_quarter"),
        "scored_at",
        "driver_1",
        "driver_2",
        "driver_3",
    )


def statuses(df: DataFrame, kind: str, value: str) -> DataFrame:
    """Add ``status`` and ``status_label`` for one value column."""
    return df.withColumn("status", status_of(kind, value)).withColumn("status_label", status_label("status"))
