"""Export sections: ordered projections of the marts and the risk block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplelake.functions.ordered import HOT_ROWS, split_crowded
from peoplelake.functions.scalar import quarter_key, ratio
from peoplelake.operators.dims import current

# Readable labels of the model features.
DRIVER_LABELS = {
    "last_score": "Low latest review score",
    "last_4q_avg": "Low score over the last four quarters",
    "avg_score": "Low average score",
    "last_score_delta": "Falling score",
    "days_since_last_raise": "Long time since the last raise",
    "last_salary_delta_pct": "Small last raise",
    "current_salary": "Current salary",
    "dept_attrition_rate": "Department with high attrition",
    "tenure_days_at_cutoff": "Short tenure",
    "age": "Age",
    "num_managers": "Many manager changes",
    "num_reviews": "Number of reviews",
    "num_salary_changes": "Number of salary changes",
}


def exp_departments(dim_department: DataFrame) -> DataFrame:
    return dim_department.select("department_id", "department_name").orderBy("department_id")


def exp_levels(dim_job_level: DataFrame) -> DataFrame:
    return dim_job_level.select("level_id", "level_name", "level_group").orderBy("level_id")


def exp_headcount(mart: DataFrame) -> DataFrame:
    return mart.select(
        "year_month_key", "department_id", "department_name", "level_id", "level_name", "headcount",
        "headcount_female", "headcount_male", "avg_tenure_years", "pct_female",
    ).orderBy("year_month_key", "department_id", "level_id")


def exp_attrition(mart: DataFrame) -> DataFrame:
    return mart.select(
        "exit_year_quarter", "department_id", "department_name", "exits_total", "exits_voluntary",
        "exits_involuntary", "exits_retirement", "avg_headcount", "attrition_rate_pct", "voluntary_pct",
        "avg_tenure_at_exit", "avg_last_perf_score", "avg_last_salary",
    ).orderBy("exit_year_quarter", "department_id")


def exp_compensation(mart: DataFrame) -> DataFrame:
    return mart.select(
        "department_id", "department_name", "level_id", "level_name", "level_group", "employee_count", "salary_min",
        "salary_max", "salary_avg", "salary_p25", "salary_median", "salary_p75", "salary_spread_pct",
    ).orderBy("department_id", "level_id")


def exp_hiring(mart: DataFrame) -> DataFrame:
    return mart.select(
        "year_quarter", "department_id", "department_name", "total_requisitions", "cnt_applied", "cnt_screening",
        "cnt_interview", "cnt_offer", "cnt_hired", "screening_rate_pct", "interview_rate_pct", "offer_rate_pct",
        "offer_accept_rate_pct", "overall_hire_rate_pct", "avg_days_to_hire",
    ).orderBy("year_quarter", "department_id")


def _reviews_by_employee(
    fct_performance: DataFrame, dim_employee: DataFrame, *more: Column, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Review counts and score sums per (employee, quarter, ...) with the current department, in one or more rows.

    Reviews move once, to their employee. Those of employees with very many collapse before, to a few rows each.
    """
    ordinary, crowded = split_crowded(fct_performance.select("employee_id", "year_quarter", "score"), ["employee_id"], hot_rows)
    one = F.lit(1).cast("long").alias("n")
    totals = crowded.groupBy("employee_id", "year_quarter", *more).agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("s"))
    each = ordinary.select("employee_id", "year_quarter", *more, one, F.col("score").cast(totals.schema["s"].dataType).alias("s"))
    return each.unionByName(totals).join(current(dim_employee).select("employee_id", "department_id"), "employee_id")


def perf_dist(fct_performance: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Reviews per quarter, current department and half-point score bucket."""
    bucket = (F.floor(F.col("score") * 2) / 2).cast("decimal(3,1)").alias("score_bucket")
    base = _reviews_by_employee(fct_performance, dim_employee, bucket)
    return (
        base.groupBy("year_quarter", "department_id", "score_bucket")
        .agg(F.sum("n").alias("cnt"))
        .orderBy("year_quarter", "department_id", "score_bucket")
    )


def perf_by_dept(fct_performance: DataFrame, dim_employee: DataFrame, dim_department: DataFrame) -> DataFrame:
    totals = (
        _reviews_by_employee(fct_performance, dim_employee)
        .groupBy("year_quarter", "department_id")
        .agg(F.sum("s").cast("decimal(22,2)").alias("sum_score"), F.sum("n").alias("n_reviews"))
    )
    names = dim_department.select("department_id", "department_name")
    return (
        totals.join(names, "department_id")
        .select("year_quarter", "department_id", "department_name", "sum_score", "n_reviews")
        .orderBy("year_quarter", "department_id")
    )


def latest_scores(scores: DataFrame) -> DataFrame:
    """Rows of the newest scoring day; the scalar subquery prunes the ``scored_at`` partitions."""
    newest = scores.agg(F.max("scored_at")).scalar()
    return scores.filter(F.col("scored_at") == newest)


def _scored(scores: DataFrame, dim_employee: DataFrame) -> DataFrame:
    place = current(dim_employee).select("employee_id", "department_id", "level_id", "tenure_days")
    return latest_scores(scores).join(place, "employee_id", "left")


def risk_totals(scores: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Counts and score sums of all four groupings in one pass; ``grouping`` tells them apart."""
    scored = _scored(scores, dim_employee)
    band, dept, level = F.col("risk_band"), F.col("department_id"), F.col("level_id")
    sets = [[band], [dept, band], [level, band], [dept, level, band]]
    return scored.groupingSets(sets, band, dept, level).agg(
        F.grouping_id("risk_band", "department_id", "level_id").alias("grouping"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum("risk_score").alias("score_sum"),
    )


def _mean_score() -> Column:
    return ratio("score_sum", "cnt", 3).cast("decimal(5,3)").alias("avg_score")


def risk_bands(totals: DataFrame) -> DataFrame:
    return totals.filter(F.col("grouping") == 3).select("risk_band", "cnt", _mean_score())


def risk_bands_by_dept(totals: DataFrame, dim_department: DataFrame) -> DataFrame:
    rows = totals.filter(F.col("grouping") == 1).join(
        dim_department.select("department_id", "department_name"), "department_id"
    )
    return rows.select("department_id", "department_name", "risk_band", "cnt", _mean_score()).orderBy(
        "department_id", "risk_band"
    )


def risk_bands_by_level(totals: DataFrame, dim_job_level: DataFrame) -> DataFrame:
    rows = totals.filter(F.col("grouping") == 2).join(dim_job_level.select("level_id", "level_name"), "level_id")
    return rows.select("level_id", "level_name", "risk_band", "cnt").orderBy("level_id", "risk_band")


def risk_bands_by_dept_level(totals: DataFrame, dim_department: DataFrame, dim_job_level: DataFrame) -> DataFrame:
    rows = (
        totals.filter(F.col("grouping") == 0)
        .join(dim_department.select("department_id", "department_name"), "department_id")
        .join(dim_job_level.select("level_id", "level_name"), "level_id")
    )
    return rows.select("department_id", "department_name", "level_id", "level_name", "risk_band", "cnt").orderBy(
        "department_id", "level_id", "risk_band"
    )


def risk_by_dept(totals: DataFrame, dim_department: DataFrame) -> DataFrame:
    """High-band count per department, most first."""
    high = risk_bands_by_dept(totals, dim_department).filter(F.col("risk_band") == "high")
    return (
        high.groupBy("department_name").agg(F.sum("cnt").alias("high_cnt")).orderBy(F.desc("high_cnt"), "department_name")
    )


def driver_label(name: Column | str) -> Column:
    """Readable label; an unknown feature keeps its name and NULL becomes empty."""
    c = F.col(name) if isinstance(name, str) else name
    pairs = [F.lit(x) for pair in DRIVER_LABELS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c, F.lit(""))


def driver_labels(df: DataFrame, columns: Sequence[str] = ("driver_1", "driver_2", "driver_3")) -> DataFrame:
    return df.withColumns({c: driver_label(c) for c in columns})


def risk_detail(
    scores: DataFrame,
    dim_employee: DataFrame,
    dim_department: DataFrame,
    dim_job_level: DataFrame,
    fct_performance: DataFrame,
) -> DataFrame:
    """Every scored employee with labels, place, tenure and the quarter of the last review, by score."""
    # Quarters follow dates, and the latest date is a hash aggregate where the latest text would be a sort.
    in_calendar = fct_performance.filter(F.col("year_quarter").isNotNull())
    last_review = in_calendar.groupBy("employee_id").agg(quarter_key(F.max("review_date")).alias("last_review_quarter"))
    rows = (
        _scored(scores, dim_employee)
        .join(dim_department.select("department_id", "department_name"), "department_id")
        .join(dim_job_level.select("level_id", "level_name"), "level_id")
        .join(last_review, "employee_id", "left")
    )
    return (
        driver_labels(rows)
        .select(
            "employee_id", "risk_score", "risk_band", "driver_1", "driver_2", "driver_3", "department_id",
            "department_name", "level_id", "level_name", "tenure_days", "last_review_quarter", "scored_at",
        )
        .orderBy(F.desc("risk_score"), "employee_id")
    )
