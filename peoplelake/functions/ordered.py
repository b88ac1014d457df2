"""Ordered operators that do not put a whole key into one task.

A plain window sorts all rows of a key in one task. That is the right plan for ordinary keys, but one key may
hold a large share of all rows. Two primitives here give the same results without that limit:

``with_neighbours``  row number and the nearest rows before and after, per key. Keys above ``hot_rows`` rows are
                     cut into one piece per chunk (a date), and a chunk above ``hot_rows`` rows further by ranges of
                     its integer tie-breaker; the pieces are stitched with a per-piece summary.
``running_totals``   totals over all strictly earlier rows of a group, computed as the offset of the row's chunk
                     plus a window inside the chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 5_000_000


#: Keys are counted in this many slots by their hash, which bounds what a task sends.
SLOTS = 16_384


def _slot(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(SLOTS))


def _full_slots(df: DataFrame, key: Sequence[str], hot_rows: int) -> DataFrame:
    """Slots with more than ``hot_rows`` rows. Every key above that is in one of them."""
    counts = df.groupBy(_slot(key).alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    return F.broadcast(counts.filter(F.col("_n") > hot_rows).select("_slot"))


def split_crowded(df: DataFrame, key: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that have at most ``hot_rows`` rows, and the rows of all others; both have all rows of their keys.

    The second part may hold smaller keys as well. When it has none the adaptive planner drops what is done with it.
    """
    rows, full = df.withColumn("_slot", _slot(key)), _full_slots(df, key, hot_rows)
    return rows.join(full, "_slot", "left_anti").drop("_slot"), rows.join(full, "_slot", "left_semi").drop("_slot")


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows; at most ``rows / hot_rows`` of them, which bounds the broadcast.

    Only keys in full slots are counted one by one: a count of every key moves about as many rows as there are, once a
    task sees most keys a few times only.
    """
    rows = df.filter(F.col(key).isNotNull()).select(key)
    crowded = rows.join(_full_slots(rows, [key], hot_rows), _slot([key]) == F.col("_slot"), "left_semi")
    counts = crowded.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(key)


def with_neighbours(
    df: DataFrame,
    key: str,
    chunk: str,
    tie: Sequence[str],
    carry: Sequence[str],
    back: int = 0,
    ahead: int = 0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``_seq`` and, for each carried column c, ``c_prev1..back`` and ``c_next1..ahead``.

    Rows of one key are ordered by ``chunk`` (a date column) and then ``tie``, which must be unique within a
    date. When no key is hot the adaptive planner sees an empty broadcast and drops the second branch.
    """
    hot = F.broadcast(hot_keys(df, key, hot_rows))
    ordinary = _window_neighbours(df.join(hot, key, "left_anti"), key, chunk, tie, carry, back, ahead)
    heavy = _chunked_neighbours(df.join(hot, key, "left_semi"), key, chunk, tie, carry, back, ahead, hot_rows)
    return ordinary.unionByName(heavy)


def _window_neighbours(df, key, chunk, tie, carry, back, ahead):
    w = Window.partitionBy(key).orderBy(chunk, *tie)
    return df.select(
        "*",
        F.row_number().over(w).cast("long").alias("_seq"),
        *[F.lag(c, i).over(w).alias(f"{c}_prev{i}") for c in carry for i in range(1, back + 1)],
        *[F.lead(c, i).over(w).alias(f"{c}_next{i}") for c in carry for i in range(1, ahead + 1)],
    )


def with_pieces(df: DataFrame, key: str, chunk: str, tie: Sequence[str], hot_rows: int) -> DataFrame:
    """Add ``_piece``, which orders the rows of a key coarsely: chunk, leading ties, range of the last tie.

    Only chunks above ``hot_rows`` rows get more than one range. There are at most ``rows / hot_rows`` of them, which
    bounds the broadcast; their ranges have equal width between the exact smallest and largest tie.
    """
    *lead, last = tie
    place = F.coalesce(F.col(chunk).cast("string"), F.lit(""))
    if not isinstance(df.schema[last].dataType, T.IntegralType):
        return df.withColumn("_piece", F.struct(place.alias("c"), *lead))
    crowded = (
        df.groupBy(F.col(key).alias("_wide_key"), place.alias("_wide_chunk"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(last).alias("_low"), F.max(last).alias("_high"))
        .filter(F.col("_n") > hot_rows)
        .select("_wide_key", "_wide_chunk", "_low", F.expr(f"(_high - _low) div (_n div {max(hot_rows, 1)} + 1) + 1").alias("_width"))
    )
    marked = df.withColumn("_place", place)
    match = (F.col(key) == F.col("_wide_key")) & (F.col("_place") == F.col("_wide_chunk"))
    block = F.coalesce(F.expr(f"({last} - _low) div _width"), F.lit(0))
    rows = marked.join(F.broadcast(crowded), match, "left")
    return rows.select(*df.columns, F.struct(F.col("_place").alias("c"), *lead, block.alias("b")).alias("_piece"))


def _chunked_neighbours(df, key, chunk, tie, carry, back, ahead, hot_rows):
    columns = df.columns
    rows = with_pieces(df, key, chunk, tie, hot_rows)
    local = Window.partitionBy(key, "_piece").orderBy(*tie)
    whole = Window.partitionBy(key, "_piece")
    rows = rows.select(
        "*",
        F.row_number().over(local).alias("_rn"),
        F.count(F.lit(1)).over(whole).alias("_cnt"),
        *[F.lag(c, i).over(local).alias(f"_lag_{c}{i}") for c in carry for i in range(1, back + 1)],
        *[F.lead(c, i).over(local).alias(f"_lead_{c}{i}") for c in carry for i in range(1, ahead + 1)],
    )
    # At most back + ahead rows of a piece reach its summary.
    keep = max(ahead, 1)
    edge = (
        rows.filter((F.col("_rn") > F.col("_cnt") - back) | (F.col("_rn") <= keep))
        .groupBy(key, "_piece")
        .agg(
            F.max("_cnt").alias("_size"),
            F.sort_array(F.collect_list(F.struct("_rn", *carry))).alias("_edge"),
        )
        .select(
            key,
            "_piece",
            "_size",
            F.filter("_edge", lambda r: r["_rn"] <= ahead).alias("_head"),
            F.reverse(F.filter("_edge", lambda r: r["_rn"] > F.col("_size") - back)).alias("_tail"),
        )
    )
    # One row per piece: about one per day, plus one per ``hot_rows`` rows of a crowded day.
    steps = Window.partitionBy(key).orderBy("_piece")
    empty = F.slice("_head", 1, 0)

    def nearby(column, shift, count):
        parts = [F.coalesce(shift(column, i).over(steps), empty) for i in range(1, count + 1)]
        return F.slice(F.concat(*parts), 1, count) if parts else empty

    spans = edge.select(
        F.col(key).alias("_span_key"),
        F.col("_piece").alias("_span_piece"),
        F.coalesce(F.sum("_size").over(steps.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        nearby("_tail", F.lag, back).alias("_before"),
        nearby("_head", F.lead, ahead).alias("_after"),
    )
    joined = rows.join(spans, (F.col(key) == F.col("_span_key")) & (F.col("_piece") == F.col("_span_piece")))
    left = F.col("_cnt") - F.col("_rn")
    previous = [
        F.when(F.col("_rn") > i, F.col(f"_lag_{c}{i}"))
        .otherwise(F.get("_before", (F.lit(i) - F.col("_rn")).cast("int"))[c])
        .alias(f"{c}_prev{i}")
        for c in carry
        for i in range(1, back + 1)
    ]
    following = [
        F.when(left >= i, F.col(f"_lead_{c}{i}"))
        .otherwise(F.get("_after", (F.lit(i - 1) - left).cast("int"))[c])
        .alias(f"{c}_next{i}")
        for c in carry
        for i in range(1, ahead + 1)
    ]
    seq = (F.col("_offset") + F.col("_rn")).cast("long").alias("_seq")
    return joined.select(*columns, seq, *previous, *following)


def running_totals(
    df: DataFrame, group: Sequence[str], chunk: str, order: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Add ``m_before`` (sum over earlier rows of the group) and ``m_total`` for each integer measure m.

    ``chunk`` is an integer that rises with ``order``; callers choose it so that the number of chunks is bounded and
    each chunk is small. Callers pass pre-aggregated rows.
    """
    group = list(group)
    # Without a NULL to filter, rows and offsets have the same plan below and share its exchange.
    df = df.withColumn(chunk, F.coalesce(F.col(chunk), F.lit(0)))
    steps = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = df.groupBy(*group, chunk).agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    offsets = offsets.select(
        *[F.col(c).alias(f"_off_{c}") for c in [*group, chunk]],
        *[F.coalesce(F.sum(f"_sum_{m}").over(steps), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy(*group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.select("*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_in_{m}") for m in measures])
    match = F.col(chunk) == F.col(f"_off_{chunk}")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"_off_{c}"))
    joined = local.join(offsets, match)
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{m}") + F.col(f"_in_{m}")).cast("long").alias(f"{m}_before") for m in measures],
        *[F.col(f"{m}_total").cast("long").alias(f"{m}_total") for m in measures],
    )


#: A group's values fall into this many chunks of about equal numbers of rows; a power of two.
CHUNKS = 1024


def with_chunks(df: DataFrame, group: Sequence[str], value: str, chunk: str = "_chunk") -> DataFrame:
    """Add ``chunk``, an integer that rises with a numeric column, with about as many rows in each chunk of a group.

    The edges are approximate quantiles of the rows at hand, so it doesn't matter where the values lie. Callers pass
    distinct values, of which a chunk then holds about one in ``CHUNKS``.
    """
    group, n = list(group), CHUNKS
    v = F.col(value).cast("double")
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    edges = F.percentile_approx(v, shares, F.lit(8 * n)).alias("_edges")
    if group:
        names = [F.col(c).alias(f"_edge_{c}") for c in group]
        found = df.groupBy(*group).agg(edges).select("_edges", *names)
        match = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_edge_{c}")) for c in group])
        rows = df.join(found, match, "left")
    else:
        rows = df.withColumn("_edges", df.agg(edges).scalar())
    return rows.select(*df.columns, _edges_below("_edges", v, n).alias(chunk))


def _edges_below(edges: str, value: Column, n: int) -> Column:
    """How many of the ``n - 1`` sorted edges lie below the value, by halving; ``n`` is a power of two. 0 without edges."""
    halves = F.array(*[F.lit(n >> i) for i in range(1, n.bit_length())])
    return F.aggregate(halves, F.lit(0), lambda at, half: at + F.when(F.get(edges, at + half - 1) < value, half).otherwise(0))


def ranked_histogram(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group with ``n``, ``n_before`` and ``n_total``; NULL values are left out.

    Equal values collapse before anything is sorted.
    """
    hist = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(with_chunks(hist, group, value), group, "_chunk", [value], ["n"]).drop("_chunk")


def _first_row(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """First row per key. Keeping rank 1 only lets the planner cut every key to one row per task before the
    exchange (window group limit), so a key with very many rows costs no more than any other."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def first_by_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Row with the lowest ``order`` per key."""
    return _first_row(df, [key] if isinstance(key, str) else list(key), [F.asc(c) for c in order])


def last_by_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Row with the highest ``order`` per key."""
    return _first_row(df, [key] if isinstance(key, str) else list(key), [F.desc(c) for c in order])


def rolling_mean(
    df: DataFrame, key: str, chunk: str, tie: Sequence[str], col: str, n: int, scale: int, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Mean of a non-NULL numeric column over the row and the ``n - 1`` before it."""
    base = with_neighbours(df, key, chunk, tie, [col], back=n - 1, hot_rows=hot_rows)
    return base.select(*df.columns, mean_with_previous(base, col, n, scale).alias(out))


def mean_with_previous(base: DataFrame, col: str, n: int, scale: int):
    total = F.col(col)
    for i in range(1, n):
        total = total + F.coalesce(F.col(f"{col}_prev{i}"), F.lit(0))
    return F.round(total.cast("decimal(22,4)") / F.least(F.col("_seq"), F.lit(n)).cast("decimal(18,0)"), scale)


def lag_delta(
    df: DataFrame, key: str, chunk: str, tie: Sequence[str], col: str, scale: int, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Difference to the previous row of the key; 0 on the first row."""
    base = with_neighbours(df, key, chunk, tie, [col], back=1, hot_rows=hot_rows)
    return base.select(*df.columns, delta_to_previous(col, scale).alias(out))


def delta_to_previous(col: str, scale: int):
    return F.round(F.col(col) - F.coalesce(F.col(f"{col}_prev1"), F.col(col)), scale)


def pct_change(
    df: DataFrame, key: str, chunk: str, tie: Sequence[str], col: str, scale: int, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Percent change to the previous row of the key; NULL on the first row and after a zero."""
    base = with_neighbours(df, key, chunk, tie, [col], back=1, hot_rows=hot_rows)
    return base.select(*df.columns, pct_to_previous(col, scale).alias(out))


def pct_to_previous(col: str, scale: int):
    prev = F.col(f"{col}_prev1").cast("decimal(14,2)")
    diff = (F.col(col) - F.col(f"{col}_prev1")).cast("decimal(14,2)")
    return F.round(diff * 100 / F.nullif(prev, F.lit(0).cast("decimal(14,2)")), scale)
