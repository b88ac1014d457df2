"""As-of join: facts meet the version of their key that held at their time, without a range join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.functions.ordered import HOT_ROWS, hot_keys


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str,
    carry: Mapping[str, str] | Sequence[str],
    *,
    tie: Sequence[str] = (),
    until: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every fact with the carried columns of the last version of its key that begins at or before ``at``.

    ``carry`` maps new column names to columns of the versions. Among versions that begin together the last in the order
    of ``tie`` counts. With ``until`` a version holds up to that column's day (NULL: for good) and carries nothing
    beyond it. Facts without a version, a key or a time keep NULLs; versions without a key or a beginning are not used.

    Versions and facts are unioned and exchanged once by key, and the last version is carried forward in the order of
    time. A key above ``hot_rows`` rows goes another way: its versions are reduced to one per time, carried over days
    and, inside a day, over its times, and its facts meet them by an equality that adaptive execution can split.
    """
    carry = dict(carry) if isinstance(carry, Mapping) else {c: c for c in carry}
    kept = {**carry, **({"_until": until} if until else {})}
    facts_side = facts.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.struct(*facts.columns).alias("_fact"))
    held = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    held = held.select(
        F.col(key).alias("_key"), F.col(valid_from).cast(facts.schema[at].dataType).alias("_at"), F.struct(*tie, F.lit(0).alias("_none")).alias("_tie"),
        F.struct(*[F.col(c).alias(n) for n, c in kept.items()]).alias("_version"),
    )
    both = held.withColumn("_fact", F.lit(None).cast(facts_side.schema["_fact"].dataType)).unionByName(facts_side, allowMissingColumns=True)
    hot = F.broadcast(hot_keys(both.select("_key"), "_key", hot_rows))
    rows = _carried(both.join(hot, "_key", "left_anti")).unionByName(
        _met_by_time(facts_side.join(hot, "_key", "left_semi"), held.join(hot, "_key", "left_semi"))
    )
    holds = F.col("_version").isNotNull()
    if until:
        holds = holds & (F.col("_version._until").isNull() | (F.col("_version._until") >= F.col("_at")))
    return rows.select("_fact.*", *[F.when(holds, F.col(f"_version.{n}")).alias(n) for n in carry])


def _carried(both: DataFrame) -> DataFrame:
    """_fact, _at, _version of ordinary keys: one window over versions and facts together, versions of a time first."""
    steps = Window.partitionBy("_key").orderBy(F.asc_nulls_first("_at"), F.col("_fact").isNotNull(), "_tie")
    last = F.last("_version", ignorenulls=True).over(steps.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = both.select("_fact", "_at", last.alias("_version")).filter(F.col("_fact").isNotNull())
    return rows


def _met_by_time(facts: DataFrame, versions: DataFrame) -> DataFrame:
    """The same for hot keys: what holds at each of their times, then an equality on (key, time)."""
    one = versions.groupBy("_key", "_at").agg(F.max_by("_version", "_tie").alias("_version"))
    times = one.unionByName(facts.select("_key", "_at").filter("_at IS NOT NULL").distinct(), allowMissingColumns=True)
    times = times.groupBy("_key", "_at").agg(F.max_by("_version", F.col("_version").isNotNull()).alias("_version")).withColumn("_day", F.to_date("_at"))
    days = times.groupBy("_key", "_day").agg(F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_at"))).alias("_of_day"))
    before = Window.partitionBy("_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_key", "_day", F.last("_of_day", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy("_key", "_day").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    times = times.withColumn("_local", F.last("_version", ignorenulls=True).over(inside))
    times = times.join(days, ["_key", "_day"]).select("_key", "_at", F.coalesce("_local", "_carried").alias("_version"))
    return facts.join(times, ["_key", "_at"], "left").select("_fact", "_at", "_version")
