"""Percentiles and distinct counts that roll up: sketches are kept per group and merged without the rows.

Quantile sketches (KLL) bound the error of the rank, distinct-count sketches (HLL, theta) the relative error of the
count. Both merge to any coarser group with the same error. They are a choice for groups whose rows are not kept or too
many to rank; the exact operators stay the default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplelake.functions.scalar import month_to_quarter, ratio
from peoplelake.operators.dims import current

#: Size of a quantile sketch. The rank of a quantile is off by less than RANK_ERROR of the rows, with 99 % confidence.
KLL_K, RANK_ERROR = 1600, 0.0025
#: Size of a distinct-count sketch: 2^LG_K registers, a standard error of about 0.4 %.
LG_K = 16


def quantile_sketches(df: DataFrame, group: Sequence[str], col: str, k: int = KLL_K) -> DataFrame:
    """One row per group: ``sketch``, ``n``, and the exact ``low``, ``high`` and ``total`` of the non-NULL values."""
    value = F.col(col).cast("double")
    rows = df.filter(F.col(col).isNotNull())
    return rows.groupBy(*group).agg(
        F.kll_sketch_agg_double(value, k).alias("sketch"), F.count(F.lit(1)).alias("n"), F.min(col).alias("low"),
        F.max(col).alias("high"), F.sum(col).alias("total"),
    )


def roll_up(sketches: DataFrame, group: Sequence[str], k: int = KLL_K) -> DataFrame:
    """The sketches of finer groups merged into coarser ones, without the rows behind them."""
    return sketches.groupBy(*group).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.sum("total").alias("total"),
    )


def quantile(p: str) -> Column:
    """Value at about row ``floor(n * p) + 1`` of a sketched group; ``p`` is a fraction as text, as in ``discrete_percentile``."""
    # a rank is a constant of the plan: just above the fraction, so that a whole number of rows counts as passed
    return F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, float(Fraction(p)) + 1e-6)))


def sketched_percentiles(sketches: DataFrame, group: Sequence[str], ps: Mapping[str, str]) -> DataFrame:
    """The percentiles of ``discrete_percentile`` from sketches."""
    return sketches.select(*group, *[quantile(p).alias(name) for name, p in ps.items()])


def sketched_compensation(
    fct_salary: DataFrame, dim_employee: DataFrame, dim_department: DataFrame, dim_job_level: DataFrame, k: int = KLL_K
) -> DataFrame:
    """``mart_compensation`` with percentiles from sketches, and the sketches themselves for coarser groups.

    Counts, bounds, means and spreads are exact.
    """
    latest = fct_salary.groupBy("employee_id").agg(F.max_by("salary_amount", "salary_seq").alias("salary_amount"))
    group = ["department_id", "level_id"]
    active = current(dim_employee).filter(F.col("status") == "active").select("employee_id", *group)
    bands = quantile_sketches(latest.join(active, "employee_id"), group, "salary_amount", k)
    spread = (F.col("high") - F.col("low")).cast("decimal(12,2)") * 100 * F.col("n")
    return (
        bands.join(dim_department.select("department_id", "department_name"), "department_id")
        .join(dim_job_level.select("level_id", "level_name", "level_group"), "level_id")
        .select(
            "department_id", "department_name", "level_id", "level_name", "level_group", F.col("n").alias("employee_count"),
            F.round("low", 0).cast("decimal(12,0)").alias("salary_min"),
            F.round("high", 0).cast("decimal(12,0)").alias("salary_max"),
            ratio("total", "n", 0).cast("decimal(12,0)").alias("salary_avg"),
            *[F.round(quantile(p), 0).cast("decimal(12,0)").alias(name) for name, p in (("salary_p25", "0.25"), ("salary_median", "0.50"), ("salary_p75", "0.75"))],
            F.round(spread.cast("decimal(22,2)") / F.nullif(F.col("total").cast("decimal(16,2)"), F.lit(0).cast("decimal(16,2)")), 1)
            .cast("decimal(12,1)").alias("salary_spread_pct"),
            "sketch", "n", "low", "high", "total",
        )
    )


def sketched_calibration(df: DataFrame, label: str, score: str, bins: int = 10, k: int = KLL_K) -> DataFrame:
    """``calibration_curve`` with bin edges from one sketch of the scores, so the scores are not ranked."""
    scored = df.filter(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("_s"), F.col(label).alias("_y"))
    edges = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(i / bins)) for i in range(1, bins)])
    inner = quantile_sketches(scored, [], "_s", k).filter("n > 0").select(edges.alias("e")).scalar()
    rows = scored.withColumn("_edges", inner)
    return rows.groupBy(F.size(F.filter("_edges", lambda e: e < F.col("_s"))).alias("bin")).agg(
        F.round(F.avg("_s"), 4).alias("mean_pred"), F.round(F.avg(F.col("_y").cast("double")), 4).alias("frac_pos"), F.count(F.lit(1)).alias("n")
    )


# ---------------------------------------------------------------- distinct counts


def distinct_sketches(df: DataFrame, group: Sequence[str], ids: Mapping[str, Column], lg_k: int = LG_K) -> DataFrame:
    """One row per group with a sketch of the distinct non-NULL ids of every measure; ``ids`` maps names to id columns."""
    return df.groupBy(*group).agg(*[F.hll_sketch_agg(c, lg_k).alias(name) for name, c in ids.items()])


def merged(sketches: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups; an id that is in several finer groups counts once."""
    return sketches.groupBy(*group).agg(*[F.hll_union_agg(n, F.lit(True)).alias(n) for n in names])


def estimates(sketches: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    return sketches.select(*group, *[F.hll_sketch_estimate(n).alias(n) for n in names])


def headcount_sketches(dim_employee: DataFrame, dim_date: DataFrame, start: str, as_of: str, lg_k: int = LG_K) -> DataFrame:
    """Sketches of the employees who were there at the end of each month, by month and department.

    Merged to quarters or years they count everybody who was there at any month's end, which month totals cannot give.
    """
    months = dim_date.filter((F.col("day") == 1) & F.col("date_day").between(start, as_of)).select("year_month_key", "last_day_of_month")
    people = current(dim_employee).filter("hire_date IS NOT NULL").select("employee_id", "department_id", "hire_date", "exit_date")
    # an employee is in the months between two dates: the months are listed, not searched
    first, last = F.trunc("hire_date", "month"), F.trunc(F.coalesce(F.col("exit_date"), F.lit(as_of).cast("date")), "month")
    first = F.greatest(first, F.trunc(F.lit(start).cast("date"), "month"))
    open_end = F.col("exit_date").isNull()
    inside = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    rows = people.select("employee_id", "department_id", open_end.alias("open"), last.alias("last"), F.explode(inside).alias("m"))
    rows = rows.filter(F.col("open") | (F.col("m") < F.col("last"))).withColumn("year_month_key", F.date_format("m", "yyyy-MM"))
    rows = rows.join(F.broadcast(months.select("year_month_key")), "year_month_key", "left_semi")
    return distinct_sketches(rows, ["year_month_key", "department_id"], {"employees": F.col("employee_id")}, lg_k)


def quarterly(sketches: DataFrame, names: Sequence[str]) -> DataFrame:
    """Month sketches merged to quarters and departments."""
    return merged(sketches.withColumn("year_quarter", month_to_quarter("year_month_key")), ["year_quarter", "department_id"], names)


def hiring_sketches(events: DataFrame, stages: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """Sketches of the candidates who reached each stage, by month of the event and department."""
    rows = events.filter(F.col("candidate_id").isNotNull()).withColumn("year_month_key", F.date_format("stage_date", "yyyy-MM"))
    reached = {s: F.when(F.col("stage") == s, F.col("candidate_id")) for s in stages}
    return distinct_sketches(rows, ["year_month_key", "department_id"], reached, lg_k)
