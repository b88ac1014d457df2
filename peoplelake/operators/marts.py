"""Marts. Every one reduces to group totals before its first wide exchange."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.functions.ordered import HOT_ROWS, ranked_histogram, split_crowded
from peoplelake.functions.scalar import as_col, day, month_to_quarter, ratio, safe_rate
from peoplelake.operators.dims import current

STAGES = ("applied", "screening", "interview", "offer")


def snapshot_counts(
    df: DataFrame,
    start_col: str,
    end_col: str,
    group: Sequence[str],
    range: tuple[dt.date | str, dt.date | str],  # noqa: A002
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Month-end totals of the intervals that are open, per group and month.

    An interval counts in a month when it starts on or before the month's last day and ends after it (NULL: never).
    ``df`` has one row per entity. Months are those whose first day lies in ``range``. Each interval adds its
    measures in its first month and takes them back in the month it ends: two rows, however long it is. After
    partial aggregation (month, group) totals remain, and a running sum over months restores the level.
    """
    measures = dict(measures or {"entities": F.lit(1)})
    low, high = (day(d) for d in range)
    first_month = F.when(low == F.trunc(low, "month"), low).otherwise(F.add_months(F.trunc(low, "month"), 1))
    last_month = F.trunc(high, "month")
    enter = F.greatest(F.trunc(as_col(start_col), "month"), first_month)
    leave = F.trunc(as_col(end_col), "month")
    counted = (
        as_col(start_col).isNotNull() & (enter <= last_month) & (as_col(end_col).isNull() | (leave > enter))
    )
    names = list(measures)
    opened = df.filter(counted).select(
        *group,
        enter.alias("_enter"),
        leave.alias("_leave"),
        *[measure.cast("long").alias(name) for name, measure in measures.items()],
    )
    moves = opened.select(
        *group,
        *names,
        F.explode(
            F.array(
                F.struct(F.col("_enter").alias("month"), F.lit(1).alias("sign")),
                F.struct(F.col("_leave").alias("month"), F.lit(-1).alias("sign")),
            )
        ).alias("_move"),
    ).filter(F.col("_move.month") <= last_month)
    deltas = moves.groupBy(*group, F.col("_move.month").alias("_month")).agg(
        *[F.sum(F.col(n) * F.col("_move.sign")).alias(n) for n in names], F.sum("_move.sign").alias("_open")
    )
    return _levels(deltas, group, names, last_month)


def _levels(deltas: DataFrame, group: Sequence[str], names: Sequence[str], last_month: Column) -> DataFrame:
    """Month-end levels from changes per group and month (``_month``, ``_open``); at most months x groups rows from here on."""
    steps = Window.partitionBy(*group).orderBy("_month")
    levels = deltas.select(
        *group,
        "_month",
        F.lead("_month").over(steps).alias("_next"),
        *[F.sum(n).over(steps.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n in [*names, "_open"]],
    ).filter(F.col("_open") > 0)
    until = F.coalesce(F.add_months("_next", -1), last_month)
    return levels.select(
        F.explode(F.sequence("_month", until, F.expr("interval 1 month"))).alias("month_start"), *group, *names
    ).select(
        F.date_format("month_start", "yyyy-MM").alias("year_month_key"),
        F.last_day("month_start").alias("snapshot_date"),
        *group,
        *names,
    )


def mart_headcount(
    dim_date: DataFrame,
    dim_employee: DataFrame,
    dim_department: DataFrame,
    dim_job_level: DataFrame,
    start: dt.date | str,
    as_of: dt.date | str,
    *,
    tenure_at_snapshot: bool = False,
) -> DataFrame:
    """Month-end headcount by department and level over current versions (one row per employee).

    Mean tenure uses the tenure column of the dimension, i.e. tenure today or at exit; ``tenure_at_snapshot``
    measures it on the snapshot day instead (mean snapshot day minus mean hire day, both additive).
    """
    gender, kind = F.col("gender"), F.col("employment_type")
    measures = {
        "headcount": F.lit(1),
        "headcount_female": F.when(gender == "female", 1).otherwise(0),
        "headcount_male": F.when(gender == "male", 1).otherwise(0),
        "headcount_ft": F.when(kind == "full_time", 1).otherwise(0),
        "tenure_sum": F.unix_date("hire_date") if tenure_at_snapshot else F.coalesce("tenure_days", F.lit(0)),
    }
    counts = snapshot_counts(
        current(dim_employee), "hire_date", "exit_date", ["department_id", "level_id"], (start, as_of), measures
    )
    tenure = F.col("tenure_sum")
    if tenure_at_snapshot:
        tenure = F.unix_date("snapshot_date") * F.col("headcount") - tenure
    return _headcount_columns(counts, tenure, dim_date, dim_department, dim_job_level)


def _headcount_columns(
    counts: DataFrame, tenure: Column, dim_date: DataFrame, dim_department: DataFrame, dim_job_level: DataFrame
) -> DataFrame:
    months = dim_date.filter(F.col("day") == 1).select("year_month_key")
    return (
        counts.join(F.broadcast(months), "year_month_key", "left_semi")
        .join(dim_department.select("department_id", "department_name"), "department_id")
        .join(dim_job_level.select("level_id", "level_name", "level_group"), "level_id")
        .select(
            "year_month_key",
            "snapshot_date",
            "department_id",
            "department_name",
            "level_id",
            "level_name",
            "level_group",
            "headcount",
            "headcount_female",
            "headcount_male",
            "headcount_ft",
            ratio(tenure * 4, F.col("headcount") * 1461, 2).cast("decimal(8,2)").alias("avg_tenure_years"),
            safe_rate("headcount_female", "headcount", 1).cast("decimal(5,1)").alias("pct_female"),
        )
    )


#: What an employee adds in its first month and takes back in the month of exit; tenure as sums that any day completes.
HEADCOUNT_STATE = ("headcount", "headcount_female", "headcount_male", "headcount_ft", "tenure_fixed", "open_count", "open_hired")


def headcount_moves(dim_employee: DataFrame) -> DataFrame:
    """Changes of the headcount measures per (department_id, level_id, month), from the current versions of employees."""
    gender, kind, gone = F.col("gender"), F.col("employment_type"), F.col("exit_date")
    parts = {
        "headcount": F.lit(1),
        "headcount_female": F.when(gender == "female", 1).otherwise(0),
        "headcount_male": F.when(gender == "male", 1).otherwise(0),
        "headcount_ft": F.when(kind == "full_time", 1).otherwise(0),
        "tenure_fixed": F.when(gone.isNotNull(), F.datediff(gone, F.col("hire_date"))).otherwise(0),
        "open_count": F.when(gone.isNull(), 1).otherwise(0),
        "open_hired": F.when(gone.isNull(), F.unix_date("hire_date")).otherwise(0),
    }
    enter, leave = F.trunc("hire_date", "month"), F.trunc("exit_date", "month")
    rows = current(dim_employee).filter(enter.isNotNull() & (leave.isNull() | (leave > enter)))
    moves = F.array(F.struct(enter.alias("month"), F.lit(1).alias("sign")), F.struct(leave.alias("month"), F.lit(-1).alias("sign")))
    rows = rows.select("department_id", "level_id", *[v.cast("long").alias(n) for n, v in parts.items()], F.explode(moves).alias("_move"))
    rows = rows.filter("_move.month IS NOT NULL").withColumn("month", F.col("_move.month"))
    return _summed(rows, {n: F.col(n) * F.col("_move.sign") for n in HEADCOUNT_STATE})


def _summed(rows: DataFrame, values: Mapping[str, Column] | None = None) -> DataFrame:
    values = values or {n: F.col(n) for n in HEADCOUNT_STATE}
    sums = rows.groupBy("department_id", "level_id", "month").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    return sums.filter(" OR ".join(f"{n} <> 0" for n in HEADCOUNT_STATE))


def add_moves(state: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The state after some employees' rows were replaced: ``added`` and ``removed`` are the moves of the new and the old rows."""
    back = removed.select("department_id", "level_id", "month", *[(-F.col(n)).alias(n) for n in HEADCOUNT_STATE])
    return _summed(state.unionByName(added).unionByName(back))


def headcount_from_state(
    state: DataFrame, dim_date: DataFrame, dim_department: DataFrame, dim_job_level: DataFrame, start: dt.date | str, as_of: dt.date | str
) -> DataFrame:
    """``mart_headcount`` from the stored month changes: a running sum over months x groups rows, no employee is read."""
    low, high = day(start), day(as_of)
    first_month = F.when(low == F.trunc(low, "month"), low).otherwise(F.add_months(F.trunc(low, "month"), 1))
    last_month = F.trunc(high, "month")
    # what came before the first month is the level it begins with
    deltas = state.groupBy("department_id", "level_id", F.greatest("month", first_month).alias("_month")).agg(
        *[F.sum(n).alias(n) for n in HEADCOUNT_STATE], F.sum("headcount").alias("_open")
    )
    counts = _levels(deltas.filter(F.col("_month") <= last_month), ["department_id", "level_id"], HEADCOUNT_STATE, last_month)
    tenure = F.col("tenure_fixed") + F.col("open_count") * F.unix_date(high) - F.col("open_hired")
    return _headcount_columns(counts, tenure, dim_date, dim_department, dim_job_level)


def mart_attrition(fct_attrition: DataFrame, mart_headcount_df: DataFrame, dim_department: DataFrame) -> DataFrame:
    """Exits and attrition rate by quarter and department. The rate is NULL where no headcount month exists."""
    kind = F.col("exit_type")
    exits = fct_attrition.groupBy("exit_year_quarter", "exit_year", "exit_quarter", "department_id").agg(
        F.count(F.lit(1)).alias("exits_total"),
        *[F.count_if(kind == k).alias(f"exits_{k}") for k in ("voluntary", "involuntary", "retirement")],
        ratio(F.sum("tenure_years"), F.count("tenure_years"), 2).alias("avg_tenure_at_exit"),
        ratio(F.sum("last_perf_score"), F.count("last_perf_score"), 2).alias("avg_last_perf_score"),
        ratio(F.sum("last_salary"), F.count("last_salary"), 0).alias("avg_last_salary"),
    )
    monthly = mart_headcount_df.groupBy("year_month_key", "department_id").agg(F.sum("headcount").alias("total"))
    quarterly = monthly.groupBy(month_to_quarter("year_month_key").alias("exit_year_quarter"), "department_id").agg(
        F.sum("total").alias("month_sum"), F.count(F.lit(1)).alias("months")
    )
    return (
        exits.join(quarterly, ["exit_year_quarter", "department_id"], "left")
        .join(dim_department.select("department_id", "department_name"), "department_id")
        .select(
            "exit_year_quarter",
            "exit_year",
            "exit_quarter",
            "department_id",
            "department_name",
            "exits_total",
            "exits_voluntary",
            "exits_involuntary",
            "exits_retirement",
            ratio("month_sum", "months", 0).cast("decimal(18,0)").alias("avg_headcount"),
            safe_rate(F.col("exits_total") * F.col("months"), "month_sum", 2)
            .cast("decimal(12,2)")
            .alias("attrition_rate_pct"),
            safe_rate("exits_voluntary", "exits_total", 1).cast("decimal(5,1)").alias("voluntary_pct"),
            F.col("avg_tenure_at_exit").cast("decimal(8,2)").alias("avg_tenure_at_exit"),
            F.col("avg_last_perf_score").cast("decimal(4,2)").alias("avg_last_perf_score"),
            F.col("avg_last_salary").cast("decimal(14,0)").alias("avg_last_salary"),
        )
    )


def _percentile(value: str, p: str) -> Column:
    """Value at row ``floor(n * p) + 1`` of the ordered group, from a ranked histogram; integers throughout."""
    share = Fraction(p)
    target = F.expr(f"n_total * {share.numerator} div {share.denominator}") + 1
    hit = (F.col("n_before") < target) & (target <= F.col("n_before") + F.col("n"))
    return F.max(F.when(hit, F.col(value)))


def discrete_percentile(
    df: DataFrame, group: Sequence[str], col: str, ps: Mapping[str, str]
) -> DataFrame:
    """Exact percentiles by row position, ``ps`` maps output names to fractions written as text.

    Not ``percentile_disc``: of 1..4 this rule picks 2 for 0.25. Rows collapse to distinct values first.
    """
    ranked = ranked_histogram(df, group, col)
    return ranked.groupBy(*group).agg(*[_percentile(col, p).alias(name) for name, p in ps.items()])


def mart_compensation(
    fct_salary: DataFrame, dim_employee: DataFrame, dim_department: DataFrame, dim_job_level: DataFrame
) -> DataFrame:
    """Salary bands of active employees by department and level, from each employee's latest salary."""
    latest = fct_salary.groupBy("employee_id").agg(F.max_by("salary_amount", "salary_seq").alias("salary_amount"))
    group = ["department_id", "level_id"]
    # The joins below drop unplaced employees anyway; dropping them here keeps both passes over the histogram equal.
    placed = (F.col("status") == "active") & F.col("department_id").isNotNull() & F.col("level_id").isNotNull()
    active = current(dim_employee).filter(placed).select("employee_id", *group)
    ranked = ranked_histogram(latest.join(active, "employee_id"), group, "salary_amount")
    s, n = F.col("salary_amount"), F.col("n")
    total = F.sum(s.cast("decimal(12,2)") * n.cast("decimal(10,0)"))
    bands = ranked.groupBy(*group).agg(
        F.sum("n").alias("employee_count"),
        F.min(s).alias("low"),
        F.max(s).alias("high"),
        total.alias("total"),
        *[_percentile("salary_amount", p).alias(f"p{p[2:]}") for p in ("0.25", "0.50", "0.75")],
    )

    def whole(column, name):
        return F.round(column, 0).cast("decimal(12,0)").alias(name)

    return (
        bands.join(dim_department.select("department_id", "department_name"), "department_id")
        .join(dim_job_level.select("level_id", "level_name", "level_group"), "level_id")
        .select(
            "department_id",
            "department_name",
            "level_id",
            "level_name",
            "level_group",
            "employee_count",
            whole(F.col("low"), "salary_min"),
            whole(F.col("high"), "salary_max"),
            ratio("total", "employee_count", 0).cast("decimal(12,0)").alias("salary_avg"),
            whole(F.col("p25"), "salary_p25"),
            whole(F.col("p50"), "salary_median"),
            whole(F.col("p75"), "salary_p75"),
            _spread().cast("decimal(12,1)").alias("salary_spread_pct"),
        )
    )


def _spread() -> Column:
    """(max - min) / mean in percent, as one division of exact sums."""
    num = ((F.col("high") - F.col("low")).cast("decimal(12,2)") * 100 * F.col("employee_count")).cast("decimal(22,2)")
    return F.round(num / F.nullif(F.col("total").cast("decimal(16,2)"), F.lit(0).cast("decimal(16,2)")), 1)


def funnel_conversion(
    df: DataFrame, key: Sequence[str] | str, stage_col: str, id_col: str, stages: Sequence[str]
) -> DataFrame:
    """Distinct ids per stage and the step-to-step conversion, per key.

    One de-duplication on (key, stage, id) spreads a hot key over all tasks; what follows is plain counting.
    """
    key = [key] if isinstance(key, str) else list(key)
    pairs = df.filter(F.col(stage_col).isin(*stages) & F.col(id_col).isNotNull()).select(*key, stage_col, id_col)
    counts = pairs.distinct().groupBy(*key).agg(*[F.count_if(F.col(stage_col) == s).alias(f"cnt_{s}") for s in stages])
    steps = [
        safe_rate(f"cnt_{b}", f"cnt_{a}", 1).cast("decimal(12,1)").alias(f"{a}_to_{b}_pct")
        for a, b in zip(stages, stages[1:])
    ]
    return counts.select("*", *steps)


#: Steps of the funnel by number; all other stages are 0.
STEPS = {s: i for i, s in enumerate((*STAGES, "hired"), 1)}


def _requisitions(rows: DataFrame) -> DataFrame:
    """One row per (department, requisition): its dates, and the distinct candidates of each stage."""
    step, hired, offer = F.col("step"), STEPS["hired"], STEPS["offer"]
    reached = rows.groupBy("department_id", "requisition_id", "step", "candidate_id").agg(
        F.min("stage_date").alias("first_date"), F.max("stage_date").alias("last_date")
    )
    return reached.groupBy("department_id", "requisition_id").agg(
        F.min("first_date").alias("funnel_start"),
        F.max(F.when(step == hired, F.col("last_date"))).alias("hired_date"),
        F.max(F.when(step == offer, F.col("last_date"))).alias("offer_date"),
        F.max(F.when(step == hired, 1).otherwise(0)).alias("was_hired"),
        *[F.count_if((step == STEPS[s]) & F.col("candidate_id").isNotNull()).alias(f"reached_{s}") for s in STAGES],
    )


def mart_hiring(
    events: DataFrame, dim_date: DataFrame, dim_department: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Funnel counts, conversion and days to hire by quarter of the first event and department.

    Events are dealt by requisition once, for the distinct candidates and for the totals. Requisitions that may have
    more than ``hot_rows`` events are first spread by stage and candidate.
    """
    step = F.lit(0)
    for name, i in STEPS.items():
        step = F.when(F.col("stage") == name, i).otherwise(step)
    # Only the stages before the hire count candidates.
    candidate = F.when(F.col("stage").isin(*STAGES), F.col("candidate_id")).alias("candidate_id")
    rows = events.select("department_id", "requisition_id", step.alias("step"), candidate, "stage_date")
    ordinary, crowded = split_crowded(rows, ["department_id", "requisition_id"], hot_rows)
    funnel = _requisitions(ordinary.repartition("department_id", "requisition_id")).unionByName(_requisitions(crowded))
    days = dim_date.select(F.col("date_day").alias("funnel_start"), "year_quarter")
    hired = F.col("was_hired") == 1
    to_hire = F.when(hired, F.datediff("hired_date", "funnel_start"))
    to_offer = F.when(hired, F.datediff("offer_date", "funnel_start"))
    quarters = (
        funnel.join(F.broadcast(days), "funnel_start", "left")
        .groupBy(
            "year_quarter",
            F.year("funnel_start").alias("year"),
            F.quarter("funnel_start").alias("quarter"),
            "department_id",
        )
        .agg(
            # (department, requisition) is unique here, so a count is the distinct count.
            F.count("requisition_id").alias("total_requisitions"),
            *[F.sum(f"reached_{s}").alias(f"cnt_{s}") for s in STAGES],
            F.sum("was_hired").alias("cnt_hired"),
            ratio(F.sum(to_hire), F.count(to_hire), 1).cast("decimal(10,1)").alias("avg_days_to_hire"),
            ratio(F.sum(to_offer), F.count(to_offer), 1).cast("decimal(10,1)").alias("avg_days_to_offer"),
        )
    )

    def rate(num, den, name):
        return safe_rate(num, den, 1).cast("decimal(12,1)").alias(name)

    return quarters.join(dim_department.select("department_id", "department_name"), "department_id").select(
        "year_quarter",
        "year",
        "quarter",
        "department_id",
        "department_name",
        "total_requisitions",
        "cnt_applied",
        "cnt_screening",
        "cnt_interview",
        "cnt_offer",
        "cnt_hired",
        rate("cnt_screening", "cnt_applied", "screening_rate_pct"),
        rate("cnt_interview", "cnt_screening", "interview_rate_pct"),
        rate("cnt_offer", "cnt_interview", "offer_rate_pct"),
        rate("cnt_hired", "cnt_offer", "offer_accept_rate_pct"),
        rate("cnt_hired", "cnt_applied", "overall_hire_rate_pct"),
        "avg_days_to_hire",
        "avg_days_to_offer",
    )
