"""Scalar expressions. All of them are built-in Column expressions and stay inside code generation."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dashboard thresholds as (good limit, warning limit, direction).
STATUS_LIMITS = {
    "attrition": ("6", "10", "low"),
    "perf": ("3.5", "3", "high"),
    "hire": ("5", "3", "high"),
    "tth": ("30", "35", "low"),
    "spread": ("60", "80", "low"),
    "female": ("35", "25", "high"),
}
STATUS_LABELS = {"ok": "On-track", "warn": "At-Risk", "bad": "Off-track"}
TENURE_DAYS = (730, 1825)
RISK_HIGH, RISK_MEDIUM = "0.6", "0.3"


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def number(text: str) -> Column:
    """Exact decimal literal."""
    return F.lit(Decimal(text))


def ratio(num, den, scale: int) -> Column:
    """``num / den`` rounded half up, NULL when ``den`` is zero.

    Works on exact decimals with 20 fractional digits before rounding, so the result does not depend on the
    order in which partitions were merged.
    """
    n = as_col(num).cast("decimal(22,4)")
    d = F.nullif(as_col(den).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(n / d, scale)


def safe_rate(num, den, scale: int) -> Column:
    """Percentage ``num * 100 / den`` with the same zero guard."""
    return ratio(as_col(num) * 100, den, scale)


def weighted_mean(value, weight, scale: int) -> Column:
    """Aggregate expression ``sum(value * weight) / sum(weight)``; NULL values count as zero."""
    v, w = as_col(value), as_col(weight)
    total = F.sum(F.coalesce(v, F.lit(0)).cast("decimal(14,4)") * F.coalesce(w, F.lit(0)))
    return ratio(total, F.sum(F.coalesce(w, F.lit(0))), scale)


def day(value: dt.date | str) -> Column:
    return F.to_date(F.lit(str(value)))


def quarter_key(date) -> Column:
    """``YYYY-Qn`` of a date."""
    d = as_col(date)
    return F.concat(F.year(d), F.lit("-Q"), F.quarter(d))


def month_to_quarter(month) -> Column:
    """``YYYY-MM`` to ``YYYY-Qn``."""
    m = as_col(month)
    return F.concat(m.substr(1, 4), F.lit("-Q"), F.ceil(m.substr(6, 2).cast("int") / 3))


def year_before(key) -> Column:
    """Shift a ``YYYY-MM`` or ``YYYY-Qn`` key back by one year."""
    k = as_col(key)
    return F.concat((k.substr(1, 4).cast("int") - 1).cast("string"), F.expr(f"substring({key}, 5)"))


def years_between(date, ref) -> Column:
    """Years from ``date`` to ``ref`` at 365.25 days, one decimal; NULL gives 0."""
    return F.coalesce(ratio(F.datediff(as_col(ref), as_col(date)) * 4, F.lit(1461), 1), F.lit(0)).cast(
        "decimal(6,1)"
    )


def tenure_years(days, scale: int = 1) -> Column:
    return ratio(as_col(days) * 4, F.lit(1461), scale)


def tenure_group(days) -> Column:
    d = as_col(days)
    low, high = TENURE_DAYS
    return F.when(d < low, "lt2").when(d < high, "2to5").when(d >= high, "gt5")


def risk_band(score) -> Column:
    s = as_col(score)
    return F.when(s >= number(RISK_HIGH), "high").when(s >= number(RISK_MEDIUM), "medium").otherwise("low")


def status_of(kind: str, value) -> Column:
    """ok / warn / bad, or neutral when the value is missing."""
    v = as_col(value)
    if kind not in STATUS_LIMITS:
        return F.lit("neutral")
    good, warn, direction = STATUS_LIMITS[kind]
    reached = (lambda limit: v <= number(limit)) if direction == "low" else (lambda limit: v >= number(limit))
    known = v.isNotNull() & ~F.isnan(v.cast("double"))
    return (
        F.when(~known, "neutral").when(reached(good), "ok").when(reached(warn), "warn").otherwise("bad")
    )


def status_label(status) -> Column:
    s = as_col(status)
    out = F.when(s == "ok", STATUS_LABELS["ok"])
    for name in ("warn", "bad"):
        out = out.when(s == name, STATUS_LABELS[name])
    return out.otherwise("-")


def delta(cur, prev, invert_good: bool = False) -> Column:
    """Change against an earlier period as a struct (diff, pct, direction, good).

    ``pct`` is 100 when the earlier value is 0 and the value changed. All fields are NULL when a side is NULL.
    """
    c, p = as_col(cur), as_col(prev)
    diff = c - p
    pct = F.coalesce(safe_rate(diff, F.abs(p), 4), F.when(diff != 0, number("100")).otherwise(number("0")))
    rises = (diff < 0) if invert_good else (diff > 0)
    known = c.isNotNull() & p.isNotNull()
    return F.struct(
        F.when(known, diff).alias("diff"),
        F.when(known, pct).cast("decimal(22,4)").alias("pct"),
        F.when(known, F.when(diff > 0, "up").when(diff < 0, "down").otherwise("flat")).alias("direction"),
        F.when(known & (diff != 0), rises.cast("int")).alias("good"),
    )


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Final cast for publication; arithmetic stays decimal up to here."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
