"""Staging views: one projection and one filter per raw table, so both reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplelake.functions.scalar import as_col


def _id(name: str) -> Column:
    return F.col(name).try_cast("bigint").alias(name)


def _date(name: str) -> Column:
    return F.col(name).try_cast("date").alias(name)


def _money(name: str) -> Column:
    return F.col(name).try_cast("decimal(12,2)").alias(name)


def _trim(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def _lower(name: str, default: str | None = None) -> Column:
    c = F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default))
    return F.lower(c).alias(name)


def stg_departments(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("department_id").isNotNull()).select(
        _id("department_id"), _trim("department_name"), _id("parent_id")
    )


def stg_job_levels(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("level_id").isNotNull()).select(_id("level_id"), _trim("level_name"), _id("level_rank"))


def stg_employees(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("employee_id").isNotNull() & F.col("hire_date").isNotNull()).select(
        "employee_id",
        "full_name",
        F.lower(F.trim("email")).alias("email"),
        _lower("gender", "unknown"),
        _date("birth_date"),
        _date("hire_date"),
        _id("department_id"),
        _trim("job_title"),
        _id("level_id"),
        "manager_id",
        _lower("employment_type"),
        _lower("status"),
        "_loaded_at",
    )


def stg_salary_history(raw: DataFrame) -> DataFrame:
    keep = F.col("salary_id").isNotNull() & F.col("employee_id").isNotNull() & (F.col("salary_amount") > 0)
    return raw.filter(keep).select(
        _id("salary_id"),
        "employee_id",
        _date("effective_date"),
        _money("salary_amount"),
        F.upper(F.coalesce("currency", F.lit("USD"))).alias("currency"),
        _lower("change_reason", "unknown"),
    )


def stg_performance_reviews(raw: DataFrame) -> DataFrame:
    keep = F.col("review_id").isNotNull() & F.col("employee_id").isNotNull() & F.col("score").between(1, 5)
    return raw.filter(keep).select(
        _id("review_id"),
        "employee_id",
        _date("review_date"),
        "review_period",
        F.left("review_period", F.lit(4)).try_cast("bigint").alias("review_year"),
        F.right("review_period", F.lit(1)).try_cast("bigint").alias("review_quarter"),
        F.col("score").try_cast("decimal(3,2)").alias("score"),
        "manager_id",
    )


def stg_job_changes(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("change_id").isNotNull() & F.col("employee_id").isNotNull()).select(
        _id("change_id"),
        "employee_id",
        _date("change_date"),
        _lower("change_type"),
        *[_id(c) for c in ("from_dept_id", "to_dept_id", "from_level_id", "to_level_id")],
        "from_manager_id",
        "to_manager_id",
        _money("from_salary"),
        _money("to_salary"),
        _lower("exit_type"),
    )


def stg_recruitment_events(raw: DataFrame) -> DataFrame:
    stage = F.lower("stage")
    return raw.filter(F.col("event_id").isNotNull()).select(
        _id("event_id"),
        "requisition_id",
        "candidate_id",
        "employee_id",
        _trim("job_title"),
        _id("department_id"),
        stage.alias("stage"),
        _date("stage_date"),
        _lower("source", "unknown"),
        F.when(stage == "hired", 1).otherwise(0).alias("is_hired"),
        F.when(stage == "rejected", 1).otherwise(0).alias("is_rejected"),
    )


STAGING = {
    "stg_departments": ("raw_departments", stg_departments),
    "stg_job_levels": ("raw_job_levels", stg_job_levels),
    "stg_employees": ("raw_employees", stg_employees),
    "stg_salary_history": ("raw_salary_history", stg_salary_history),
    "stg_performance_reviews": ("raw_performance_reviews", stg_performance_reviews),
    "stg_job_changes": ("raw_job_changes", stg_job_changes),
    "stg_recruitment_events": ("raw_recruitment_events", stg_recruitment_events),
}


def _with_exit(events: DataFrame, exits: DataFrame, key: str) -> DataFrame:
    last = exits.groupBy(F.col(key).alias("_exit_key")).agg(F.max("exit_date").alias("_exit"))
    return events.join(last, F.col(key) == F.col("_exit_key"), "left")


def _kept(date_col: str, keep: Column | None) -> Column:
    inside = F.col("_exit").isNull() | (F.col(date_col) <= F.col("_exit"))
    return inside if keep is None else inside | keep


def clamp_events_to_exit(
    events: DataFrame, exits: DataFrame, key: str, date_col: str, keep: Column | None = None, *,
    parents: DataFrame | None = None, on: str | None = None,
) -> DataFrame:
    """Drop events dated after the key's exit. ``exits`` has (key, exit_date); ``keep`` rows always stay.

    The exit side has one row per key, so the adaptive planner can split a hot key on the event side. Where the key stands
    in ``parents``, which events meet by the column ``on``, the fewer parents get the exits and events move to those only;
    the result then has the columns of both.
    """
    if parents is None:
        columns, joined = events.columns, _with_exit(events, exits, key)
    else:
        columns = [*events.columns, *[c for c in parents.columns if c != on]]
        joined = events.join(_with_exit(parents, exits, key), on)
    return joined.filter(_kept(date_col, keep)).select(*columns)


def clamp_report(
    events: DataFrame, exits: DataFrame, key: str, date_col: str, keep: Column | None = None, name: str = "events"
) -> DataFrame:
    """Rows kept and dropped by the clamp, in one aggregate."""
    # NULL dates fail the filter of the clamp, so they count as dropped here as well.
    stays = F.coalesce(_kept(date_col, keep), F.lit(False))
    return (
        _with_exit(events, exits, key)
        .agg(F.count_if(stays).alias("kept"), F.count_if(~stays).alias("dropped"))
        .select(F.lit(name).alias("events"), "kept", "dropped")
    )


def quarters_between(df: DataFrame, start, end) -> DataFrame:
    """One row per quarter that starts on or before ``end``, from the quarter that holds ``start``."""
    first, last = F.trunc(as_col(start), "quarter"), as_col(end)
    spans = df.filter(first <= last)
    out = spans.withColumn("quarter_start", F.explode(F.sequence(first, last, F.expr("interval 3 months"))))
    return out.withColumns({"year": F.year("quarter_start"), "quarter": F.quarter("quarter_start")})
