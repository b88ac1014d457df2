"""Facts: reviews, salary events and exits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplelake.functions.ordered import (
    HOT_ROWS,
    delta_to_previous,
    mean_with_previous,
    pct_to_previous,
    with_neighbours,
)
from peoplelake.functions.scalar import ratio


def _with_quarter(df: DataFrame, date: str, dim_date: DataFrame, name: str = "year_quarter") -> DataFrame:
    """Left join to the calendar. One row per day, so its size is bounded and it is broadcast."""
    days = dim_date.select(F.col("date_day").alias("_day"), F.col("year_quarter").alias(name))
    return df.join(F.broadcast(days), F.col(date) == F.col("_day"), "left").drop("_day")


def fct_performance(reviews: DataFrame, dim_date: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per review with the mean of the last four scores, the previous score and the change."""
    base = with_neighbours(reviews, "employee_id", "review_date", ["review_id"], ["score"], back=3, hot_rows=hot_rows)
    rows = base.select(
        "review_id",
        "employee_id",
        "review_date",
        "review_year",
        "review_quarter",
        "score",
        mean_with_previous(base, "score", 4, 6).cast("decimal(7,6)").alias("score_4q_avg"),
        F.col("score_prev1").alias("prev_score"),
        delta_to_previous("score", 2).cast("decimal(4,2)").alias("score_delta"),
        F.col("_seq").alias("review_seq"),
        "manager_id",
    )
    return _with_quarter(rows, "review_date", dim_date)


def fct_salary(salaries: DataFrame, dim_date: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per salary event with the change against the previous one."""
    base = with_neighbours(
        salaries, "employee_id", "effective_date", ["salary_id"], ["salary_amount"], back=1, hot_rows=hot_rows
    )
    rows = base.select(
        "salary_id",
        "employee_id",
        "effective_date",
        "salary_amount",
        "currency",
        "change_reason",
        F.col("salary_amount_prev1").alias("prev_salary"),
        F.col("_seq").alias("salary_seq"),
        delta_to_previous("salary_amount", 2).cast("decimal(13,2)").alias("salary_delta"),
        pct_to_previous("salary_amount", 2).cast("decimal(18,2)").alias("salary_delta_pct"),
    )
    return _with_quarter(rows, "effective_date", dim_date)


def fct_attrition(
    changes: DataFrame, employees: DataFrame, fct_salary_df: DataFrame, fct_performance_df: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """One row per termination with the last salary and the last review of the employee.

    The position of an event within its employee decides which one is last, so equal salary dates go to the highest
    ``salary_id``. The last values are hash aggregates over plain numbers, and the four inputs meet on
    ``employee_id`` with one row per employee on three sides.
    """
    exits = changes.filter(F.col("change_type") == "termination").select(
        F.col("change_id").alias("attrition_id"), "employee_id", F.col("change_date").alias("exit_date"), "exit_type"
    )
    person = employees.select("employee_id", "department_id", "level_id", "hire_date")
    last_salary = fct_salary_df.groupBy("employee_id").agg(F.max_by("salary_amount", "salary_seq").alias("last_salary"))
    last_review = fct_performance_df.groupBy("employee_id").agg(
        F.max_by("score", "review_seq").alias("last_perf_score"),
        F.max_by("score_4q_avg", "review_seq").alias("last_4q_avg_score"),
    )
    days = F.datediff("exit_date", "hire_date")
    rows = (
        exits.join(person, "employee_id")
        .join(last_salary, "employee_id", "left")
        .join(last_review, "employee_id", "left")
        .select(
            "attrition_id",
            "employee_id",
            "exit_date",
            "exit_type",
            "department_id",
            "level_id",
            "hire_date",
            days.alias("tenure_days"),
            ratio(days * 4, F.lit(1461), 2).cast("decimal(8,2)").alias("tenure_years"),
            "last_salary",
            "last_perf_score",
            "last_4q_avg_score",
            F.year("exit_date").alias("exit_year"),
            F.quarter("exit_date").alias("exit_quarter"),
        )
    )
    return _with_quarter(rows, "exit_date", dim_date, "exit_year_quarter")
