"""Reports cover whole dimensions and drop nothing by default."""

from pyspark.sql import functions as F

from peoplelake.operators import report
from peoplelake.operators.features import observed_values
from peoplelake.operators.metrics import average_precision, calibration_curve, roc_auc
from peoplelake.operators.report import ReportFilter
from peoplelake.sources.sinks import _plain_number

import pytest

ALL = ReportFilter(granularity="month")


def departments(spark):
    return spark.createDataFrame([(1, "One"), (2, "Two")], "department_id long, department_name string")


def test_trend_has_departments_without_headcount(spark):
    rows = [("2020-01", 1, "One", 1, "Mid", 7), ("2020-02", 1, "One", 1, "Mid", 9)]
    heads = spark.createDataFrame(rows, "year_month_key string, department_id long, department_name string, level_id long, level_name string, headcount long")
    got = {(r.period, r.department_id): r.headcount for r in report.hc_trend(heads, departments(spark), ALL).collect()}
    assert got == {("2020-01", 1): 7, ("2020-02", 1): 9, ("2020-01", 2): 0, ("2020-02", 2): 0}


def risks(spark, n=3):
    rows = [(f"e{i}", 1, "Intern" if i == 0 else "Mid", 1, "high", 0.9 - i / 10_000, 10) for i in range(n)]
    return spark.createDataFrame(rows, "employee_id string, department_id long, level_name string, level_id long, risk_band string, risk_score double, tenure_days int")


def test_heatmap_keeps_levels_outside_the_dimension(spark):
    levels = spark.createDataFrame([(1, "Mid"), (2, "Lead")], "level_id long, level_name string")
    got = {(r.department_name, r.level_name): (r.high_risk, r.max_cell) for r in report.risk_heatmap(risks(spark), departments(spark), levels, ALL).collect()}
    want = {(d, n): (0, 2) for d in ("One", "Two") for n in ("Mid", "Lead")} | {("One", "Mid"): (2, 2), ("One", "Intern"): (1, 2)}
    assert got == want


def test_selection_is_whole_unless_cut(spark):
    assert report.risk_filtered(risks(spark, 700), ALL).count() == 700
    assert [r.employee_id for r in report.risk_filtered(risks(spark, 700), ALL, top=2).collect()] == ["e0", "e1"]


def test_numbers_read_back_as_they_were(spark):
    values = [0.0, 1.0, -2.5, 1 / 3, 1e-9, 123456789.125, 2e-15, 1e15, 6.02e23, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(_plain_number(F.col("v"))).collect()]
    assert [None if g is None else float(g) for g in got] == values and got[1] == "1" and "E" not in "".join(g or "" for g in got[:8])


def test_values_that_are_no_codes(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("gender"), F.lit("x").alias("employment_type"))
    assert observed_values(df)["employment_type"] == ["x"] and len(observed_values(df)["gender"]) == 50
    with pytest.raises(ValueError):
        observed_values(df, most=50)


def test_rows_without_a_score_do_not_count(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (0, None)]
    df = spark.createDataFrame(rows, "y int, s double")
    assert roc_auc(df, "y", "s").first()[0] == 1.0 and average_precision(df, "y", "s").first()[0] == 1.0
    assert sum(r.n for r in calibration_curve(df, "y", "s").collect()) == 2
