"""The daily run: load, models, quality gate, scores, export, alert. Nothing is published after a failed gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from peoplelake.operators import checks, exports, features, rules
from peoplelake.plans.warehouse import Warehouse, run_models
from peoplelake.schemas import TABLES
from peoplelake.sources import loads, sinks

# Turns the feature frame of the day into rows of the score table.
Scorer = Callable[[DataFrame, dt.date], DataFrame]


@dataclass(frozen=True)
class DailyResult:
    loaded: dict[str, int]
    tests: DataFrame
    scores: DataFrame
    alert: DataFrame


def export_sections(tables: dict[str, DataFrame], scores: DataFrame, work: str) -> dict:
    """All sections of the export bundle as DataFrames. The risk totals, which five of them use, are written to ``work`` once."""
    dept, level, employee = tables["dim_department"], tables["dim_job_level"], tables["dim_employee"]
    totals = sinks.materialize(exports.risk_totals(scores, employee), f"{work}/risk_totals")
    return {
        "departments": exports.exp_departments(dept),
        "levels": exports.exp_levels(level),
        "headcount": exports.exp_headcount(tables["mart_headcount"]),
        "attrition": exports.exp_attrition(tables["mart_attrition"]),
        "compensation": exports.exp_compensation(tables["mart_compensation"]),
        "hiring": exports.exp_hiring(tables["mart_hiring"]),
        "perf_dist": exports.perf_dist(tables["fct_performance"], employee),
        "perf_by_dept": exports.perf_by_dept(tables["fct_performance"], employee, dept),
        "risk": {
            "bands": exports.risk_bands(totals),
            "top": exports.risk_detail(scores, employee, dept, level, tables["fct_performance"]),
            "by_dept": exports.risk_by_dept(totals, dept),
            "bands_by_dept": exports.risk_bands_by_dept(totals, dept),
            "bands_by_level": exports.risk_bands_by_level(totals, level),
            "bands_by_dept_level": exports.risk_bands_by_dept_level(totals, dept, level),
        },
    }


def run_daily(
    spark: SparkSession,
    load: loads.LoadConfig,
    warehouse_root: str,
    publish_root: str,
    *,
    as_of: dt.date,
    headcount_start: dt.date,
    calendar: DataFrame,
    scorer: Scorer,
    threshold: float = 10.0,
    full_load: bool = False,
) -> DailyResult:
    loaded = loads.run_load(spark, load, full_load=full_load)
    raw = {t.target: loads.read_raw(spark, load.root, t) for t in TABLES}
    warehouse = Warehouse(
        spark, raw, warehouse_root, as_of=as_of, headcount_start=headcount_start, calendar=calendar
    )
    tables = run_models(warehouse)

    tests = checks.declared_tests(tables)
    checks.quality_gate(tests)

    rows = features.build_features(
        tables["dim_employee"], tables["fct_performance"], tables["fct_salary"], as_of, for_training=False
    )
    scores_path = f"{publish_root}/attrition_scores"
    sinks.write_scores(scorer(rows, as_of), scores_path)
    scores = spark.read.parquet(scores_path)
    sinks.export_json_bundle(export_sections(tables, scores, f"{warehouse_root}/_work"), f"{publish_root}/export")
    return DailyResult(loaded, tests, scores, rules.attrition_alert(tables["mart_attrition"], threshold))
