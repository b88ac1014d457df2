"""Dimensions: calendar, department, job level and the versioned employee history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.functions.ordered import HOT_ROWS, with_neighbours
from peoplelake.functions.scalar import as_col, day, quarter_key

# Department id to department group.
DEPARTMENT_GROUPS = {1: "Engineering", 2: "Product", 3: "Sales", 4: "Operations", 5: "Human Resources"}


def calendar(span: DataFrame) -> DataFrame:
    """Calendar of every day in a one-row frame (start, end)."""
    days = span.select(F.explode(F.sequence("start", "end")).alias("date_day"))
    d = F.col("date_day")
    weekday = F.dayofweek(d)
    return days.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        quarter_key(d).alias("year_quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month_key"),
        F.when(weekday.isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.last_day(d).alias("last_day_of_month"),
    )


def dim_date(spark: SparkSession, start: dt.date | str = "2020-01-01", end: dt.date | str = "2027-12-31") -> DataFrame:
    return calendar(spark.range(1).select(day(start).alias("start"), day(end).alias("end")))


def dim_department(stg: DataFrame) -> DataFrame:
    group = F.lit(None).cast("string")
    for key, name in DEPARTMENT_GROUPS.items():
        group = F.coalesce(group, F.when(F.col("department_id") == key, name))
    return stg.select(
        "department_id", "department_name", "parent_id", F.coalesce(group, F.lit("Other")).alias("department_group")
    )


def dim_job_level(stg: DataFrame) -> DataFrame:
    rank = F.col("level_rank")
    group = F.when(rank <= 2, "Individual Contributor").when(rank <= 4, "Senior / Lead").otherwise("Management")
    return stg.select("level_id", "level_name", "level_rank", group.alias("level_group"))


def scd2_build(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    valid_from: str,
    order: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions of each key from a base row and its changes.

    Both inputs have the same columns. Adds ``version_num``, ``next_valid_from``, ``valid_to`` (the day before the
    next version, never before ``valid_from``) and ``is_current``.
    """
    versions = base.unionByName(changes)
    columns = versions.columns
    numbered = with_neighbours(versions, key, valid_from, order, [valid_from], ahead=1, hot_rows=hot_rows)
    following = F.col(f"{valid_from}_next1")
    return numbered.select(
        *columns,
        F.col("_seq").alias("version_num"),
        following.alias("next_valid_from"),
        # greatest() skips NULLs, so the open version is guarded explicitly.
        F.when(following.isNotNull(), F.greatest(F.date_sub(following, 1), F.col(valid_from))).alias("valid_to"),
        F.when(following.isNull(), 1).otherwise(0).alias("is_current"),
    )


def dim_employee(
    employees: DataFrame,
    job_changes: DataFrame,
    as_of: dt.date | str,
    *,
    change_types: Sequence[str] = ("promotion",),
    base_from_change: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Employee history, one row per version: the hire and one version per promotion.

    Versions are numbered on narrow rows and meet the wide employee row once, after the window. With
    ``base_from_change`` the first version shows the level the employee was promoted from.
    """
    hired = employees.select(
        "employee_id",
        F.col("hire_date").alias("valid_from"),
        F.lit(0).alias("is_change"),
        F.lit(0).cast("long").alias("change_id"),
        F.lit(None).cast("long").alias("new_dept"),
        F.lit(None).cast("long").alias("new_level"),
        F.lit(None).cast("string").alias("new_manager"),
        F.lit(None).cast("long").alias("old_level"),
    )
    moved = job_changes.filter(F.col("change_type").isin(*change_types)).select(
        "employee_id",
        F.col("change_date").alias("valid_from"),
        F.lit(1).alias("is_change"),
        "change_id",
        F.col("to_dept_id").alias("new_dept"),
        F.col("to_level_id").alias("new_level"),
        F.col("to_manager_id").alias("new_manager"),
        F.col("from_level_id").alias("old_level"),
    )
    if base_from_change:
        first = moved.groupBy("employee_id").agg(
            F.min_by("old_level", F.struct("valid_from", "change_id")).alias("first_level")
        )
        hired = hired.drop("new_level").join(first, "employee_id", "left").withColumnRenamed("first_level", "new_level")
    versions = scd2_build(hired, moved, "employee_id", "valid_from", ["is_change", "change_id"], hot_rows)

    # One exit per employee: the latest, with the highest change id deciding between equal dates.
    exits = (
        job_changes.filter(F.col("change_type") == "termination")
        .groupBy("employee_id")
        .agg(F.max(F.struct("change_date", "change_id", "exit_type")).alias("exit"))
        .select("employee_id", F.col("exit.change_date").alias("exit_date"), F.col("exit.exit_type").alias("exit_type"))
    )
    person = employees.select(
        "employee_id", "full_name", "email", "gender", "birth_date", "hire_date", "department_id", "job_title",
        "level_id", "manager_id", "employment_type", "status",
    )
    joined = versions.join(person, "employee_id").join(exits, "employee_id", "left")
    number = F.col("version_num").cast("string")
    padded = F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)
    open_end = F.when(
        (F.col("status") == "terminated") & F.col("exit_date").isNotNull(), F.greatest("exit_date", "valid_from")
    )
    return joined.select(
        F.concat("employee_id", F.lit("-V"), padded).alias("employee_sk"),
        "employee_id",
        "full_name",
        "email",
        "gender",
        "birth_date",
        "hire_date",
        F.coalesce("new_dept", "department_id").alias("department_id"),
        "job_title",
        F.coalesce("new_level", "level_id").alias("level_id"),
        F.coalesce("new_manager", "manager_id").alias("manager_id"),
        "employment_type",
        "status",
        "valid_from",
        F.when(F.col("next_valid_from").isNotNull(), F.col("valid_to")).otherwise(open_end).alias("valid_to"),
        "is_current",
        F.datediff(F.coalesce(F.col("exit_date"), day(as_of)), F.col("hire_date")).alias("tenure_days"),
        "exit_date",
        "exit_type",
    )


def scd2_as_of(dim: DataFrame, key: str, date: dt.date | str | Column) -> DataFrame:
    """The version of each key that is valid on ``date`` (a literal, or a column of ``dim``)."""
    d = date if isinstance(date, Column) else day(date)
    valid = (F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") >= d))
    return dim.filter(as_col(key).isNotNull() & valid)


def current(dim_employee_df: DataFrame) -> DataFrame:
    return dim_employee_df.filter(F.col("is_current") == 1)
