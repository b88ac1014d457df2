"""The model chain: staging views, core tables and marts, in dependency order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from peoplelake.functions.ordered import HOT_ROWS
from peoplelake.operators import dims, facts, marts
from peoplelake.operators.staging import STAGING
from peoplelake.sources.sinks import materialize


class Warehouse:
    """Names to DataFrames for one as-of date.

    Staging models are views. Core and mart models are written once below ``root`` and read back, because each has
    several consumers; ``model(name)`` gives the plan that builds one of them from its inputs. ``write`` (frame, path,
    name) writes a model and reads it back.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame] | Callable[[str], DataFrame],
        root: str,
        *,
        as_of: dt.date,
        headcount_start: dt.date,
        calendar: DataFrame,
        hot_rows: int = HOT_ROWS,
        write: Callable[[DataFrame, str, str], DataFrame] = lambda df, path, name: materialize(df, path),
    ):
        self.spark, self.root, self.as_of = spark, root.rstrip("/"), as_of
        self.headcount_start, self.calendar, self.hot_rows, self.write = headcount_start, calendar, hot_rows, write
        self._raw = raw if callable(raw) else raw.__getitem__
        self._written: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self._raw(name)

    def view(self, name: str) -> DataFrame:
        source, build = STAGING[name]
        return build(self.raw(source))

    def model(self, name: str) -> DataFrame:
        if name in STAGING:
            return self.view(name)
        return MODELS[name](self)

    def table(self, name: str) -> DataFrame:
        if name in STAGING:
            return self.view(name)
        if name not in self._written:
            self._written[name] = self.write(self.model(name), f"{self.root}/{name}", name)
        return self._written[name]

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Materialise a derived table under a name of its own."""
        if name not in self._written:
            self._written[name] = materialize(df, f"{self.root}/{name}")
        return self._written[name]


MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "dim_date": lambda w: dims.calendar(w.calendar),
    "dim_department": lambda w: dims.dim_department(w.view("stg_departments")),
    "dim_job_level": lambda w: dims.dim_job_level(w.view("stg_job_levels")),
    "dim_employee": lambda w: dims.dim_employee(
        w.view("stg_employees"), w.view("stg_job_changes"), w.as_of, hot_rows=w.hot_rows
    ),
    "fct_performance": lambda w: facts.fct_performance(
        w.view("stg_performance_reviews"), w.table("dim_date"), w.hot_rows
    ),
    "fct_salary": lambda w: facts.fct_salary(w.view("stg_salary_history"), w.table("dim_date"), w.hot_rows),
    "fct_attrition": lambda w: facts.fct_attrition(
        w.view("stg_job_changes"),
        w.view("stg_employees"),
        w.table("fct_salary"),
        w.table("fct_performance"),
        w.table("dim_date"),
    ),
    "mart_headcount": lambda w: marts.mart_headcount(
        w.table("dim_date"),
        w.table("dim_employee"),
        w.table("dim_department"),
        w.table("dim_job_level"),
        w.headcount_start,
        w.as_of,
    ),
    "mart_attrition": lambda w: marts.mart_attrition(
        w.table("fct_attrition"), w.table("mart_headcount"), w.table("dim_department")
    ),
    "mart_compensation": lambda w: marts.mart_compensation(
        w.table("fct_salary"), w.table("dim_employee"), w.table("dim_department"), w.table("dim_job_level")
    ),
    "mart_hiring": lambda w: marts.mart_hiring(
        w.view("stg_recruitment_events"), w.table("dim_date"), w.table("dim_department"), w.hot_rows
    ),
}

ALL_MODELS = (*STAGING, *MODELS)


def run_models(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Build all models and return them by name, raw tables included."""
    tables = {source: warehouse.raw(source) for source, _ in STAGING.values()}
    for name in ALL_MODELS:
        tables[name] = warehouse.table(name)
    return tables
