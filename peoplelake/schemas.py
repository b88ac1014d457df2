"""Declared schemas of the source tables, the raw layer and the score table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DateType()
_MONEY, _TS = T.DecimalType(12, 2), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


SOURCES: dict[str, T.StructType] = {
    "departments": _schema(("department_id", _L), ("department_name", _S), ("parent_id", _L), ("created_at", _TS)),
    "job_levels": _schema(("level_id", _L), ("level_name", _S), ("level_rank", _L)),
    "employees": _schema(
        ("employee_id", _S), ("full_name", _S), ("email", _S), ("gender", _S), ("birth_date", _D), ("hire_date", _D),
        ("department_id", _L), ("job_title", _S), ("level_id", _L), ("manager_id", _S), ("employment_type", _S),
        ("status", _S),
    ),
    "salary_history": _schema(
        ("salary_id", _L), ("employee_id", _S), ("effective_date", _D), ("salary_amount", _MONEY), ("currency", _S),
        ("change_reason", _S), ("created_at", _TS),
    ),
    "performance_reviews": _schema(
        ("review_id", _L), ("employee_id", _S), ("review_date", _D), ("review_period", _S),
        ("score", T.DecimalType(3, 2)), ("manager_id", _S), ("notes", _S), ("created_at", _TS),
    ),
    "job_changes": _schema(
        ("change_id", _L), ("employee_id", _S), ("change_date", _D), ("change_type", _S), ("from_dept_id", _L),
        ("to_dept_id", _L), ("from_level_id", _L), ("to_level_id", _L), ("from_manager_id", _S),
        ("to_manager_id", _S), ("from_salary", _MONEY), ("to_salary", _MONEY), ("exit_type", _S), ("created_at", _TS),
    ),
    "recruitment_events": _schema(
        ("event_id", _L), ("requisition_id", _S), ("candidate_id", _S), ("employee_id", _S), ("job_title", _S),
        ("department_id", _L), ("stage", _S), ("stage_date", _D), ("source", _S), ("created_at", _TS),
    ),
}

WATERMARKS = _schema(("table_name", _S), ("last_loaded_id", _L), ("last_loaded_at", _TS), ("rows_loaded", _L))

SCORES = _schema(
    ("employee_id", _S), ("scored_at", _D), ("risk_score", T.DecimalType(5, 4)), ("risk_band", _S),
    ("driver_1", _S), ("driver_1_impact", T.DecimalType(8, 4)),
    ("driver_2", _S), ("driver_2_impact", T.DecimalType(8, 4)),
    ("driver_3", _S), ("driver_3_impact", T.DecimalType(8, 4)),
)


@dataclass(frozen=True)
class TableConfig:
    """Routing of one source table into the raw layer."""

    source: str
    target: str
    key: str
    mode: str  # full | replace | incremental_pk


TABLES = (
    TableConfig("departments", "raw_departments", "department_id", "full"),
    TableConfig("job_levels", "raw_job_levels", "level_id", "full"),
    TableConfig("employees", "raw_employees", "employee_id", "replace"),
    TableConfig("salary_history", "raw_salary_history", "salary_id", "incremental_pk"),
    TableConfig("performance_reviews", "raw_performance_reviews", "review_id", "incremental_pk"),
    TableConfig("job_changes", "raw_job_changes", "change_id", "incremental_pk"),
    TableConfig("recruitment_events", "raw_recruitment_events", "event_id", "incremental_pk"),
)
