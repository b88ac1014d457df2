"""Data tests. Each is a frame (test, table, column, failures); a table's row-level tests share one pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from peoplelake.schemas import TABLES
from peoplelake.sources.versions import BUCKET, VersionedTable


class QualityGateError(RuntimeError):
    """Raised when a data test fails; publication stops."""


def _row_tests(df: DataFrame, table: str, tests: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Count the rows that violate each (test, column, predicate), all in one aggregate."""
    counts = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(tests)])
    rows = F.array(
        *[
            F.struct(F.lit(test).alias("test"), F.lit(column).alias("column"), F.col(f"_{i}").alias("failures"))
            for i, (test, column, _) in enumerate(tests)
        ]
    )
    return counts.select(F.inline(rows)).select("test", F.lit(table).alias("table"), "column", "failures")


def _keyed_tests(df: DataFrame, table: str, key: str, tests: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Row tests and uniqueness of ``key`` in one pass: violations are counted per key while its rows are."""
    keyed = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(tests)])
    many = F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_many")
    counts = keyed.agg(many, *[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(tests))])
    cells = [("unique", key, "_many"), *[(test, column, f"_{i}") for i, (test, column, _) in enumerate(tests)]]
    rows = [F.struct(F.lit(t).alias("test"), F.lit(c).alias("column"), F.col(n).alias("failures")) for t, c, n in cells]
    return counts.select(F.inline(F.array(*rows))).select("test", F.lit(table).alias("table"), "column", "failures")


def _nulls(column: str) -> Column:
    return F.col(column).isNull()


def _outside_list(column: str, values: Sequence, ignore_case: bool = False) -> Column:
    value = F.lower(column) if ignore_case else F.col(column)
    return F.col(column).isNotNull() & ~value.isin(*values)


def _outside_range(column: str, low, high) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).between(low, high)


def test_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return _row_tests(df, table, [("not_null", c, _nulls(c)) for c in columns])


def test_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.count_if(F.col("_n") > 1).alias("failures")).select(
        F.lit("unique").alias("test"), F.lit(table).alias("table"), F.lit(column).alias("column"), "failures"
    )


def test_accepted_values(
    df: DataFrame, table: str, column: str, values: Sequence, ignore_case: bool = False
) -> DataFrame:
    """NULL passes."""
    return _row_tests(df, table, [("accepted_values", column, _outside_list(column, values, ignore_case))])


def test_range(df: DataFrame, table: str, column: str, low, high) -> DataFrame:
    return _row_tests(df, table, [("range", column, _outside_range(column, low, high))])


def test_expression(df: DataFrame, table: str, name: str, bad: Column) -> DataFrame:
    """Rows for which ``bad`` is true."""
    return _row_tests(df, table, [("expression", name, bad)])


def test_relationships(df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL reference has no parent."""
    keys = parent.select(F.col(parent_key).alias(column)).distinct()
    orphans = df.filter(F.col(column).isNotNull()).select(column).join(keys, column, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("relationships").alias("test"), F.lit(table).alias("table"), F.lit(column).alias("column"), "failures"
    )


@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table."""

    table: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple] = field(default_factory=dict)
    expressions: Mapping[str, str] = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.accepted) + len(self.expressions)

    def row_tests(self) -> list[tuple[str, str, Column]]:
        """(test, column, predicate of the rows that fail)."""
        rows = [("not_null", c, _nulls(c)) for c in self.not_null]
        # Raw codes are compared without case, as in the source database; staging lower-cases them.
        ignore_case = self.table.startswith("raw_")
        rows += [("accepted_values", c, _outside_list(c, v, ignore_case)) for c, v in self.accepted.items()]
        return rows + [("expression", name, F.expr(bad)) for name, bad in self.expressions.items()]

    def run(self, df: DataFrame) -> list[DataFrame]:
        rows = self.row_tests()
        if not self.unique:
            return [_row_tests(df, self.table, rows)] if rows else []
        return [_keyed_tests(df, self.table, self.unique[0], rows)] + [test_unique(df, self.table, c) for c in self.unique[1:]]


def _key(table: str, key: str, *not_null: str, **accepted: tuple) -> TableTests:
    return TableTests(table, (key, *not_null), (key,), accepted)


# Allowed codes.
STATUS = ("active", "terminated", "on_leave")
KINDS = ("full_time", "part_time", "contract")
CHANGES = ("promotion", "transfer", "demotion", "termination", "rehire")
EXITS = ("voluntary", "involuntary", "retirement")

DECLARED: tuple[TableTests, ...] = (
    # raw layer
    _key("raw_employees", "employee_id", "hire_date", status=STATUS),
    _key("raw_departments", "department_id"),
    _key("raw_job_levels", "level_id"),
    _key("raw_salary_history", "salary_id", "employee_id", "salary_amount"),
    _key("raw_performance_reviews", "review_id", "employee_id", "score"),
    _key("raw_job_changes", "change_id", "employee_id"),
    _key("raw_recruitment_events", "event_id"),
    # staging
    _key("stg_employees", "employee_id", "hire_date", status=STATUS, employment_type=KINDS),
    _key("stg_salary_history", "salary_id", "salary_amount"),
    _key("stg_performance_reviews", "review_id", "score"),
    _key("stg_job_changes", "change_id", change_type=CHANGES),
    # core
    TableTests(
        "dim_employee",
        ("employee_sk", "employee_id"),
        ("employee_sk",),
        {"is_current": (0, 1)},
        {"valid_window": "valid_to < valid_from"},
    ),
    _key("dim_department", "department_id"),
    _key("dim_job_level", "level_id"),
    _key("fct_performance", "review_id", "employee_id"),
    _key("fct_attrition", "attrition_id", "employee_id", exit_type=EXITS),
    _key("fct_salary", "salary_id"),
)

# References between the source tables (table, column, parent table, parent key).
REFERENCES = (
    ("raw_departments", "parent_id", "raw_departments", "department_id"),
    ("raw_employees", "department_id", "raw_departments", "department_id"),
    ("raw_employees", "level_id", "raw_job_levels", "level_id"),
    ("raw_employees", "manager_id", "raw_employees", "employee_id"),
    ("raw_salary_history", "employee_id", "raw_employees", "employee_id"),
    ("raw_performance_reviews", "employee_id", "raw_employees", "employee_id"),
    ("raw_performance_reviews", "manager_id", "raw_employees", "employee_id"),
    ("raw_job_changes", "employee_id", "raw_employees", "employee_id"),
    ("raw_job_changes", "from_dept_id", "raw_departments", "department_id"),
    ("raw_job_changes", "to_dept_id", "raw_departments", "department_id"),
    ("raw_job_changes", "from_level_id", "raw_job_levels", "level_id"),
    ("raw_job_changes", "to_level_id", "raw_job_levels", "level_id"),
    ("raw_job_changes", "from_manager_id", "raw_employees", "employee_id"),
    ("raw_job_changes", "to_manager_id", "raw_employees", "employee_id"),
    ("raw_recruitment_events", "employee_id", "raw_employees", "employee_id"),
    ("raw_recruitment_events", "department_id", "raw_departments", "department_id"),
)


#: Column of the failed tests of a row, written with it.
REASONS = "_reasons"


@dataclass(frozen=True)
class Tested:
    """A published table with its test results, and the rows that failed with the reasons for it."""

    table: DataFrame
    results: DataFrame
    failing: DataFrame


def publish_tested(df: DataFrame, path: str, tests: TableTests) -> Tested:
    """Publish a table and count its row tests in the pass that writes it.

    Rows that fail go to files of their own with a list of ``test:column`` reasons, so they are set aside without a
    second look at the others; the table holds both. Only uniqueness reads the written keys once more.
    """
    spark, rows = df.sparkSession, tests.row_tests()
    failed = [F.when(bad, F.lit(f"{test}:{column}")) for test, column, bad in rows]
    reasons = F.filter(F.array(*failed), lambda r: r.isNotNull()) if failed else F.array().cast("array<string>")
    seen = Observation(f"tests of {tests.table}")
    flagged = df.withColumn(REASONS, reasons)
    counts = [F.count_if(F.array_contains(REASONS, f"{test}:{column}")).alias(f"_{i}") for i, (test, column, _) in enumerate(rows)]
    flagged = flagged.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    table = VersionedTable(spark, path, flagged.schema)
    table.publish(flagged, F.when(F.size(REASONS) > 0, 1).otherwise(0))
    metrics = seen.get
    cells = [(test, tests.table, column, metrics.get(f"_{i}", 0)) for i, (test, column, _) in enumerate(rows)]
    results = [spark.createDataFrame(cells, "test string, table string, column string, failures long")] if cells else []
    results += [test_unique(table.read(), tests.table, c) for c in tests.unique]
    bad = [f for f in table.files() if f"{BUCKET}=1/" in f.path]
    return Tested(table.read().drop(REASONS), reduce(DataFrame.unionByName, results), table.read(bad))


def declared_tests(tables: Mapping[str, DataFrame], declared: Iterable[TableTests] = DECLARED) -> DataFrame:
    """Results of the declared tests for the tables at hand."""
    frames = [f for t in declared if t.table in tables for f in t.run(tables[t.table])]
    return reduce(DataFrame.unionByName, frames)


def reference_tests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphans for every declared reference."""
    frames = [test_relationships(tables[t], t, c, tables[p], k) for t, c, p, k in REFERENCES if t in tables and p in tables]
    return reduce(DataFrame.unionByName, frames)


def exit_tests(stg_job_changes: DataFrame) -> DataFrame:
    """Employees with more than one termination; the history keeps only their latest exit."""
    ends = stg_job_changes.filter(F.col("change_type") == "termination")
    return test_unique(ends, "stg_job_changes", "employee_id")


def quality_gate(results: DataFrame) -> None:
    """Raise when a test has failures. The result frame has one row per declared test."""
    failed = results.filter(F.col("failures") > 0).orderBy("table", "column", "test").collect()
    if failed:
        text = ", ".join(f"{r['table']}.{r['column']} {r['test']}: {r['failures']}" for r in failed)
        raise QualityGateError(text)


# pytest collects functions named test_*; these are library functions.
for _f in (test_not_null, test_unique, test_accepted_values, test_range, test_expression, test_relationships):
    _f.__test__ = False

assert {t.target for t in TABLES} <= {t.table for t in DECLARED}
