"""Point-in-time features: one row per employee active at a cutoff, built only from earlier events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplelake.functions.ordered import running_totals
from peoplelake.functions.scalar import day, years_between
from peoplelake.operators.dims import current

HORIZON_DAYS = 180
LABEL = "left_180d"
CATEGORICAL = ("gender", "employment_type")
# What a feature shows for an employee without reviews or salary events.
DEFAULTS = {
    "num_reviews": 0, "num_managers": 0, "avg_score": 0, "last_score": 0, "last_4q_avg": 0, "last_score_delta": 0,
    "num_salary_changes": 0, "current_salary": 0, "last_salary_delta_pct": 0, "days_since_last_raise": 9999,
}


def feat_population(dim_employee: DataFrame, cutoff: dt.date | str) -> DataFrame:
    """Employees hired by the cutoff and not gone by it. Hire and exit decide, not the version window."""
    c = day(cutoff)
    active = (F.col("hire_date") <= c) & (F.col("exit_date").isNull() | (F.col("exit_date") > c))
    return current(dim_employee).filter(active).select(
        "employee_id", "gender", "birth_date", "hire_date", "department_id", "level_id", "employment_type", "exit_date"
    )


def feat_performance(fct_performance: DataFrame, cutoff: dt.date | str) -> DataFrame:
    """Review features up to the cutoff; the last review is an aggregate, not a second pass.

    Managers are counted apart: a distinct count in the same grouping would send all other totals out per employee and
    manager, which are about as many rows as there are reviews.
    """
    rows = fct_performance.filter(F.col("review_date") <= day(cutoff))
    totals = rows.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("num_reviews"),
        # Exact hundredths, then one division.
        (F.sum((F.col("score") * 100).cast("long")).cast("double") / (F.count("score") * 100).cast("double")).alias(
            "avg_score"
        ),
        # Plain numbers by the review's position keep this a hash aggregate; a struct would force a sort.
        F.max_by("score", "review_seq").cast("double").alias("last_score"),
        F.max_by("score_4q_avg", "review_seq").cast("double").alias("last_4q_avg"),
        F.max_by("score_delta", "review_seq").cast("double").alias("last_score_delta"),
    )
    managers = rows.groupBy(F.col("employee_id").alias("_managed")).agg(F.count_distinct("manager_id").alias("num_managers"))
    both = totals.join(managers, F.col("employee_id").eqNullSafe(F.col("_managed")))
    return both.select(
        "employee_id", "num_reviews", "num_managers", "avg_score", "last_score", "last_4q_avg", "last_score_delta"
    )


def feat_salary(fct_salary: DataFrame, cutoff: dt.date | str) -> DataFrame:
    c = day(cutoff)
    return (
        fct_salary.filter(F.col("effective_date") <= c)
        .groupBy("employee_id")
        .agg(
            F.count(F.lit(1)).alias("num_salary_changes"),
            F.max_by("salary_amount", "salary_seq").cast("double").alias("current_salary"),
            F.max_by("salary_delta_pct", "salary_seq").cast("double").alias("last_salary_delta_pct"),
            F.datediff(c, F.max("effective_date")).alias("days_since_last_raise"),
        )
    )


def dept_attrition_rate(dim_employee: DataFrame, cutoff: dt.date | str) -> DataFrame:
    """Share of everyone hired by the cutoff who had left by it, per department."""
    c = day(cutoff)
    hired = current(dim_employee).filter(F.col("hire_date") <= c)
    gone = F.count_if(F.col("exit_date") <= c).cast("double")
    return hired.groupBy("department_id").agg((gone / F.count(F.lit(1)).cast("double")).alias("dept_attrition_rate"))


def label_within(exit_date: Column | str, cutoff: dt.date | str, horizon: int = HORIZON_DAYS) -> Column:
    """1 when the exit falls in (cutoff, cutoff + horizon]."""
    x = F.col(exit_date) if isinstance(exit_date, str) else exit_date
    c = day(cutoff)
    return F.when((x > c) & (x <= F.date_add(c, horizon)), 1).otherwise(0)


def build_features(
    dim_employee: DataFrame,
    fct_performance: DataFrame,
    fct_salary: DataFrame,
    cutoff: dt.date | str,
    *,
    horizon: int = HORIZON_DAYS,
    for_training: bool = True,
) -> DataFrame:
    c = day(cutoff)
    rows = (
        feat_population(dim_employee, cutoff)
        .join(feat_performance(fct_performance, cutoff), "employee_id", "left")
        .join(feat_salary(fct_salary, cutoff), "employee_id", "left")
        .join(dept_attrition_rate(dim_employee, cutoff), "department_id", "left")
    )
    label = [label_within("exit_date", cutoff, horizon).alias(LABEL)] if for_training else []
    return rows.select(
        "employee_id",
        "gender",
        "department_id",
        "level_id",
        "employment_type",
        *[F.coalesce(F.col(name), F.lit(value)).alias(name) for name, value in DEFAULTS.items()],
        years_between("birth_date", c).cast("double").alias("age"),
        F.datediff(c, F.col("hire_date")).alias("tenure_days_at_cutoff"),
        F.coalesce("dept_attrition_rate", F.lit(0.0)).alias("dept_attrition_rate"),
        *label,
    )


def feature_columns(df: DataFrame) -> list[str]:
    """All columns but the key and the label."""
    return [c for c in df.columns if c not in ("employee_id", LABEL)]


def observed_values(df: DataFrame, columns: Sequence[str] = CATEGORICAL, most: int = 1000) -> dict[str, list[str]]:
    """Observed values per categorical column, sorted; the model keeps them. More than ``most`` in all are an error."""
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    rows = df.select(F.inline(cells)).filter("value IS NOT NULL").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} values in {', '.join(columns)}: not codes, or raise the limit")
    return {c: sorted(r["value"] for r in rows if r["name"] == c) for c in columns}


def one_hot(df: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each categorical column by one 0/1 column per given value; NULL and new values give zeros."""
    keep = [F.col(c) for c in df.columns if c not in values]
    flags = [
        F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for c, allowed in values.items() for v in allowed
    ]
    return df.select(*keep, *flags)


def align_features(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("employee_id",)) -> DataFrame:
    """Exactly ``columns`` as doubles, in order, next to ``keep``; a missing column is 0 and others are dropped."""
    have = set(df.columns)
    cells = [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)).alias(c) for c in columns
    ]
    return df.select(*[c for c in keep if c in have], *cells)


def _hash_rank(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """Add each row's rank (``_rank``, from 1) and the size (``_one_total``) of its class, in seeded hash order.

    The first four hex digits cut a class into at most 65,536 even chunks, so no class is sorted in one task.
    """
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))
    keyed = df.withColumns({"_digest": digest, "_chunk": F.conv(F.left(digest, F.lit(4)), 16, 10).cast("int")})
    ranked = running_totals(keyed.withColumn("_one", F.lit(1)), [label], "_chunk", ["_digest", id_col], ["_one"])
    return ranked.withColumn("_rank", F.col("_one_before") + 1)


def stratified_split(df: DataFrame, label: str, id_col: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` (train / test); each class gives the rounded share ``test`` of its rows to the test part."""
    ranked = _hash_rank(df, label, id_col, seed)
    size = F.round(F.col("_one_total") * F.lit(str(test)).cast("decimal(6,4)"), 0)
    return ranked.select(*df.columns, F.when(F.col("_rank") <= size, "test").otherwise("train").alias("split"))


def stratified_kfold(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` (0 .. k-1); class sizes per fold differ by at most one."""
    ranked = _hash_rank(df, label, id_col, seed)
    return ranked.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias("fold"))


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, as (n_neg, n_pos, weight)."""
    counts = df.agg(F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos"))
    weight = F.col("n_neg").cast("double") / F.greatest(F.col("n_pos"), F.lit(1)).cast("double")
    return counts.withColumn("weight", weight)
