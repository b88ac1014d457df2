"""Rule-based findings: metrics in long form, then one CASE chain per output column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplelake.functions.scalar import ratio
from peoplelake.operators import report
from peoplelake.operators.report import ReportFilter


def _metric(df: DataFrame, name: str, value: str | Column, subject: Column | None = None) -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    s = F.lit(None).cast("string") if subject is None else subject
    return df.select(F.lit(name).alias("metric"), v.cast("decimal(22,4)").alias("value"), s.alias("subject"))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _band(column: str, level: str) -> Column:
    return F.concat_ws(" / ", F.col(column), F.col(level))


def status_metrics(
    attrition: DataFrame,
    headcount: DataFrame,
    perf_dist: DataFrame,
    compensation: DataFrame,
    hiring: DataFrame,
    f: ReportFilter,
) -> DataFrame:
    """The figures behind the findings: (metric, value, subject)."""
    at = report.attrition_kpis(attrition, headcount, f)
    # The department with the highest rate is named only when all departments are in view.
    top = F.lit(None).cast("string")
    if f.dept is None:
        ranked = report.attrition_rank(attrition, headcount, f)
        top = ranked.agg(F.min(F.struct("rank", "department_name"))["department_name"]).scalar()
    comp = report.comp_summary(compensation, f)
    spread_at = F.when(F.col("spread_department").isNotNull(), _band("spread_department", "spread_level"))
    return _stack(
        [
            _metric(at, "attrition_rate", "avg_rate", top),
            _metric(report.perf_summary(perf_dist, headcount, f), "low_score_share", "low_pct"),
            _metric(at, "voluntary_share", "voluntary_pct"),
            _metric(comp, "salary_spread", "max_spread_pct", spread_at),
            _metric(report.hiring_summary(hiring, headcount, f), "days_to_hire", "avg_days_to_hire"),
            _metric(report.hc_kpis(headcount, f), "female_share", "pct_female"),
        ]
    )


def insights(metrics: DataFrame) -> DataFrame:
    """Five findings with their severity."""
    m, v = F.col("metric"), F.col("value")
    kind = (
        F.when(m == "attrition_rate", F.when(v > 8, "alert").when(v > 6, "warn").otherwise("good"))
        .when(m == "low_score_share", F.when(v > 25, "alert").when(v > 15, "warn").otherwise("good"))
        .when(m == "voluntary_share", F.when(v > 70, "warn").otherwise("info"))
        .when(m == "salary_spread", F.when(v > 60, "warn").otherwise("good"))
        .when(m == "days_to_hire", F.when(v > 35, "warn").otherwise("good"))
    )
    return metrics.select(kind.alias("kind"), "metric", "value", "subject").filter(F.col("kind").isNotNull())


def _actions(metrics: DataFrame, action: Column, priority: Column) -> DataFrame:
    rows = metrics.select(priority.alias("priority"), action.alias("action"), "metric", "value", "subject")
    return rows.filter(F.col("action").isNotNull())


def recommendations(metrics: DataFrame) -> DataFrame:
    """Actions whose condition holds; a single default one when none does."""
    m, v = F.col("metric"), F.col("value")
    action = (
        F.when((m == "attrition_rate") & (v > 8), "stay_interviews")
        .when((m == "low_score_share") & (v > 25), "improvement_plans")
        .when((m == "salary_spread") & (v > 60), "pay_equity_review")
        .when((m == "days_to_hire") & (v > 35), "shorten_hiring")
        .when((m == "female_share") & (v < 35), "diversity_pilot")
    )
    priority = (
        F.when(m.isin("attrition_rate", "low_score_share"), "high")
        .when(m.isin("salary_spread", "days_to_hire"), "mid")
        .otherwise("test")
    )
    found = _actions(metrics, action, priority)
    default = (
        found.agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == 0)
        .select(
            F.lit("test").alias("priority"),
            F.lit("keep_monitoring").alias("action"),
            F.lit("none").alias("metric"),
            F.lit(None).cast("decimal(22,4)").alias("value"),
            F.lit(None).cast("string").alias("subject"),
        )
    )
    return found.unionByName(default)


def risk_metrics(risk_detail: DataFrame, f: ReportFilter) -> DataFrame:
    """Figures of the prediction page; hotspot and driver rows are missing when there is none."""
    bands = report.band_counts(risk_detail, f)
    hotspot = report.risk_hotspot(risk_detail, f)
    driver = report.most_common_driver(risk_detail, f)
    return _stack(
        [
            _metric(bands, "high_share", "high_pct"),
            _metric(bands, "high_count", "high"),
            _metric(bands, "medium_count", "medium"),
            _metric(hotspot, "hotspot", "cnt", _band("department_name", "level_name")),
            _metric(driver, "top_driver", "cnt", F.col("driver_1")),
        ]
    )


def ml_insights(metrics: DataFrame) -> DataFrame:
    """Size of the high-risk group, its hotspot, the leading driver, and how to read the score."""
    m, v = F.col("metric"), F.col("value")
    kind = (
        F.when(m == "high_share", F.when(v > 12, "alert").when(v > 8, "warn").otherwise("good"))
        .when(m == "hotspot", "warn")
        .when(m == "top_driver", "info")
    )
    found = metrics.select(kind.alias("kind"), "metric", "value", "subject").filter(F.col("kind").isNotNull())
    reading = metrics.filter(m == "high_share").select(
        F.lit("info").alias("kind"),
        F.lit("score_reading").alias("metric"),
        F.lit(None).cast("decimal(22,4)").alias("value"),
        F.lit("ranking_not_probability").alias("subject"),
    )
    return found.unionByName(reading)


def ml_recommendations(metrics: DataFrame) -> DataFrame:
    """Retention talks and check-ins when there is someone to meet; calibration always."""
    m, v = F.col("metric"), F.col("value")
    action = (
        F.when((m == "high_count") & (v > 0), "retention_talks")
        .when((m == "medium_count") & (v > 0), "regular_check_ins")
        .when(m == "high_share", "calibrate_scores")
    )
    priority = F.when(m == "high_count", "high").when(m == "medium_count", "mid").otherwise("test")
    return _actions(metrics, action, priority)


def attrition_alert(mart_attrition: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Mean rate of the latest quarter with a rate, and whether it is above the threshold. Empty without rates."""
    rated = mart_attrition.filter(F.col("attrition_rate_pct").isNotNull())
    means = rated.groupBy("exit_year_quarter").agg(
        ratio(F.sum("attrition_rate_pct"), F.count(F.lit(1)), 2).alias("rate")
    )
    latest = means.orderBy(F.desc("exit_year_quarter")).limit(1)
    limit = F.lit(str(threshold)).cast("decimal(12,4)")
    return latest.select(
        "exit_year_quarter", "rate", limit.alias("threshold"), (F.col("rate") > limit).cast("int").alias("is_alert")
    )
