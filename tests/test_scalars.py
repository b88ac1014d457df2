"""Scalar expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from peoplelake.functions import scalar as s


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def num(x):
    return F.lit(None).cast("double") if x is None else F.lit(float(x))


STEP = 0.001


@pytest.mark.parametrize("kind", sorted(s.STATUS_LIMITS))
def test_status_changes_at_its_limits(spark, kind):
    good, warn, direction = s.STATUS_LIMITS[kind]
    away = STEP if direction == "low" else -STEP
    cases = [(good, "ok"), (float(good) - away, "ok"), (float(good) + away, "warn"), (warn, "warn"), (float(warn) + away, "bad")]
    for v, want in [*cases, (None, "neutral"), (float("nan"), "neutral")]:
        assert value(spark, s.status_of(kind, num(v))) == want


def test_status_of_an_unknown_kind(spark):
    assert value(spark, s.status_of("no such kind", num(1))) == "neutral"


def test_tenure_groups_change_at_their_limits(spark):
    low, high = s.TENURE_DAYS
    for days, want in [(0, "lt2"), (low - 1, "lt2"), (low, "2to5"), (high - 1, "2to5"), (high, "gt5"), (10 * high, "gt5"), (None, None)]:
        assert value(spark, s.tenure_group(F.lit(days).cast("int"))) == want


def test_tenure_years(spark):
    assert [float(value(spark, s.tenure_years(F.lit(d)))) for d in (0, 1461, 2 * 1461 + 37)] == [0.0, 4.0, 8.1]


def test_risk_bands_change_at_their_limits(spark):
    high, medium = float(s.RISK_HIGH), float(s.RISK_MEDIUM)
    for v, want in [(1, "high"), (high, "high"), (high - STEP, "medium"), (medium, "medium"), (medium - STEP, "low"), (0, "low")]:
        assert value(spark, s.risk_band(num(v))) == want


def test_delta_against_plain_arithmetic(spark):
    for cur in (None, 0, 3, 17, 250):
        for prev in (None, 0, 3, 40):
            for invert in (False, True):
                d = value(spark, s.delta(F.lit(cur).cast("long"), F.lit(prev).cast("long"), invert))
                if cur is None or prev is None:
                    assert tuple(d) == (None, None, None, None)
                    continue
                diff = cur - prev
                share = 100 * diff / prev if prev else 100.0 * (diff != 0)
                assert d["diff"] == diff and float(d["pct"]) == pytest.approx(share, abs=1e-4)
                assert d["direction"] == ("up" if diff > 0 else "down" if diff < 0 else "flat")
                assert d["good"] == (None if diff == 0 else int((diff > 0) != invert))


def test_month_to_quarter(spark):
    for m in range(1, 13):
        assert value(spark, s.month_to_quarter(F.lit(f"1999-{m:02d}"))) == f"1999-Q{(m + 2) // 3}"


def test_years_between(spark):
    ref = dt.date(2011, 3, 7)
    for days in (0, 200, 366, 9000):
        got = value(spark, s.years_between(F.lit(ref - dt.timedelta(days=days)), F.lit(ref)))
        assert float(got) == pytest.approx(days / 365.25, abs=0.051)
    assert float(value(spark, s.years_between(F.lit(None).cast("date"), F.lit(ref)))) == 0.0


@pytest.mark.parametrize(
    ("n", "d", "scale", "want"), [(1, 3, 2, 0.33), (5, 1000, 2, 0.01), (-5, 1000, 2, -0.01), (1, 0, 2, None), (285, 1000, 2, 0.29)]
)
def test_ratio_rounds_half_up(spark, n, d, scale, want):
    got = value(spark, s.ratio(F.lit(n), F.lit(d), scale))
    assert (None if got is None else float(got)) == want


def test_year_before(spark):
    df = spark.createDataFrame([("2025-03", "2025-Q3")], "m string, q string")
    assert tuple(df.select(s.year_before("m"), s.year_before("q")).first()) == ("2024-03", "2024-Q3")


def test_day_takes_dates_and_text(spark):
    assert value(spark, s.day(dt.date(2020, 2, 29))) == value(spark, s.day("2020-02-29"))
