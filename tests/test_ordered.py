"""The skew-safe primitives give what a plain sort over all rows gives."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peoplelake.functions.ordered import first_by_key, hot_keys, last_by_key, ranked_histogram, running_totals, split_crowded, with_chunks, with_neighbours, with_pieces
from peoplelake.operators.facts import fct_performance, fct_salary
from peoplelake.operators.dims import dim_employee
from peoplelake.operators.features import stratified_kfold, stratified_split
from peoplelake.operators.marts import discrete_percentile
from verification.lab import lab

BASE = dt.date(2020, 1, 1)
SCHEMA = "k string, d date, i long, v long"


def plain(rows, back, ahead):
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for n, r in enumerate(mine):
            before = tuple(mine[n - j][3] if n - j >= 0 else None for j in range(1, back + 1))
            after = tuple(mine[n + j][3] if n + j < len(mine) else None for j in range(1, ahead + 1))
            out[r[2]] = (n + 1, *before, *after)
    return out


def computed(spark, rows, back, ahead, hot_rows):
    df = with_neighbours(spark.createDataFrame(rows, SCHEMA), "k", "d", ["i"], ["v"], back, ahead, hot_rows)
    names = ["_seq"] + [f"v_prev{j}" for j in range(1, back + 1)] + [f"v_next{j}" for j in range(1, ahead + 1)]
    return {r["i"]: tuple(r[n] for n in names) for r in df.collect()}


def events(n, keys, days, seed):
    rng = random.Random(seed)
    # Half of all rows belong to one key.
    return [
        (rng.choice(["hot"] * len(keys) + keys), BASE + dt.timedelta(days=rng.randrange(days)), i, rng.randrange(100))
        for i in range(n)
    ]


@pytest.mark.parametrize("days", [1, 3, 400])
@pytest.mark.parametrize(("back", "ahead"), [(3, 0), (1, 0), (0, 1), (2, 2)])
def test_hot_key_equals_plain_order(spark, days, back, ahead):
    rows = events(300, ["a", "b", "c"], days, seed=days)
    want = plain(rows, back, ahead)
    assert computed(spark, rows, back, ahead, hot_rows=100) == want
    assert computed(spark, rows, back, ahead, hot_rows=10**6) == want


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=25
    )
)
def test_hot_key_property(spark, drawn):
    rows = [(k, BASE + dt.timedelta(days=d), i, v) for i, (k, d, v) in enumerate(drawn)]
    assert computed(spark, rows, 3, 1, hot_rows=0) == plain(rows, 3, 1)


def test_a_crowded_day_is_split(spark):
    rows = [("hot", BASE, i, i % 7) for i in range(0, 3000, 3)] + [("hot", BASE + dt.timedelta(days=1), 1, 5)]
    pieces = with_pieces(spark.createDataFrame(rows, SCHEMA), "k", "d", ["i"], hot_rows=100)
    sizes = [r["count"] for r in pieces.groupBy("_piece").count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 100 and sum(sizes) == len(rows)
    assert computed(spark, rows[:-1], 3, 1, hot_rows=100) == plain(rows[:-1], 3, 1)


def test_hot_keys_are_few(spark):
    df = spark.createDataFrame(events(300, ["a", "b", "c"], 10, seed=1), SCHEMA)
    assert [r["k"] for r in hot_keys(df, "k", 100).collect()] == ["hot"]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_keys_are_counted_one_by_one_in_full_slots_only(spark):
    """Every key has few rows: no exchange by key is left, which would move a row for each of them."""
    df = spark.range(3000).select(F.concat(F.lit("E"), F.col("id") % 1000).alias("k"))
    assert "hashpartitioning(k#" not in final_plan(hot_keys(df, "k", 1000))
    assert sorted(r["k"] for r in hot_keys(df.unionByName(spark.createDataFrame([("E7",), (None,)], "k string")), "k", 3).collect()) == ["E7"]


def test_crowded_keys_are_split_off_whole(spark):
    data = [(None, i) for i in range(5)] + [("a", i) for i in range(40)] + [(f"k{i}", i) for i in range(50)]
    df = spark.createDataFrame(data, "k string, i int")
    ordinary, crowded = (sorted(map(tuple, part.collect()), key=repr) for part in split_crowded(df, ["k"], 10))
    assert sorted(ordinary + crowded, key=repr) == sorted(data, key=repr)
    assert ("a", 0) in crowded and not {k for k, _ in ordinary} & {k for k, _ in crowded}
    assert (None, 0) in ordinary


def test_null_keys_and_dates_are_kept(spark):
    rows = [("a", None, 1, 5), ("a", BASE, 2, 6), (None, BASE, 3, 7), ("a", BASE, 4, 8)]
    got = computed(spark, rows, 1, 0, hot_rows=1)
    assert got == {1: (1, None), 2: (2, 5), 3: (1, None), 4: (3, 6)}


def test_models_do_not_depend_on_the_hot_path(spark, sf_dir):
    x = lab(spark, sf_dir)
    days = x.table("dim_date")
    for build in (
        lambda hot: fct_performance(x.view("stg_performance_reviews"), days, hot),
        lambda hot: fct_salary(x.view("stg_salary_history"), days, hot),
        lambda hot: dim_employee(x.view("stg_employees"), x.view("stg_job_changes"), "2001-08-01", hot_rows=hot),
    ):
        split, whole = build(1), build(10**9)
        assert split.exceptAll(whole).count() == 0
        assert whole.exceptAll(split).count() == 0


def test_no_single_partition_window_over_rows(spark, sf_dir):
    """Ranking plans exchange rows by (class, chunk), never into one partition."""
    x = lab(spark, sf_dir)
    df = stratified_split(x.view("stg_performance_reviews"), "review_quarter", "review_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(review_quarter" in plan
    assert "_chunk" in plan


def test_keys_are_cut_before_the_exchange(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 4), ("b", None, 1)], "k string, o long, v long")
    last = last_by_key(df, "k", ["o"])
    assert sorted(tuple(r) for r in last.collect()) == [("a", 2, 4), ("b", None, 1)]
    assert sorted(tuple(r) for r in first_by_key(df, "k", ["o"]).collect()) == [("a", 1, 5), ("b", None, 1)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(k")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_running_totals(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["x", None]), i, rng.randrange(5)) for i in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g string, o long, m long").withColumn("c", F.floor(F.col("o") / 100))
    got = {(r["g"], r["o"]): (r["m_before"], r["m_total"]) for r in running_totals(df, ["g"], "c", ["o"], ["m"]).collect()}
    want = {
        (g, o): (sum(m2 for g2, o2, m2 in rows if g2 == g and o2 < o), sum(m2 for g2, _, m2 in rows if g2 == g))
        for g, o, _ in rows
    }
    assert got == want


def test_ranked_histogram_without_group(spark):
    df = spark.createDataFrame([(x,) for x in (5, 1, 5, 2000, None, 1)], "v long")
    got = {r["v"]: (r["n"], r["n_before"], r["n_total"]) for r in ranked_histogram(df, [], "v").collect()}
    assert got == {1: (2, 0, 5), 5: (2, 2, 5), 2000: (1, 4, 5)}


@pytest.mark.parametrize("group", [[], ["g"]])
def test_chunks_are_even_wherever_values_lie(spark, group):
    narrow = spark.range(100_000).select(F.lit("a").alias("g"), (F.lit(0.5) + F.col("id") * 1e-9).alias("v"))
    wide = spark.range(3000).select(F.lit(None).cast("string").alias("g"), (F.pow(F.col("id").cast("double"), 3) - 1e9).alias("v"))
    df = narrow.unionByName(wide) if group else narrow
    chunked = with_chunks(df, group, "v")
    assert chunked.groupBy(*group, "_chunk").count().agg(F.max("count")).first()[0] < 400
    last = chunked.groupBy(*group, "_chunk").agg(F.min("v").alias("a"), F.max("v").alias("b")).orderBy(*group, "_chunk").collect()
    assert all(x["b"] < y["a"] for x, y in zip(last, last[1:]) if not group or x["g"] == y["g"])


@pytest.mark.parametrize("group", [[], ["g"]])
def test_a_chunk_is_found_without_walking_the_edges(spark, group):
    rng = random.Random(11)
    values = [*[rng.choice([rng.randint(0, 40), rng.random() * 1e6]) for _ in range(3000)], None]
    df = spark.createDataFrame([(i % 2, v if v is None else float(v)) for i, v in enumerate(values)], "g int, v double")
    chunks = with_chunks(df, group, "v")
    found = chunks.select(*df.columns, "_chunk").collect()
    shares = F.array(*[F.lit(i / 1024) for i in range(1, 1024)])
    edges = {r[0] if group else None: r["e"] for r in df.groupBy(*group).agg(F.percentile_approx("v", shares, F.lit(8192)).alias("e")).collect()}
    for r in found:
        mine = edges[r["g"] if group else None]
        assert r["_chunk"] == (0 if r["v"] is None else sum(e < r["v"] for e in mine))
    # a filter over an array looks at each of its elements, for every row
    assert "filter(" not in chunks._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7])
def test_percentile_rule(spark, n):
    df = spark.createDataFrame([("g", i) for i in range(1, n + 1)], "g string, v long")
    row = discrete_percentile(df, ["g"], "v", {"p25": "0.25", "p50": "0.5", "p75": "0.75"}).first()
    assert tuple(row)[1:] == tuple(int(n * p) + 1 for p in (0.25, 0.5, 0.75))


def test_split_and_folds_preserve_classes(spark):
    df = spark.range(1000).select(F.concat(F.lit("e"), "id").alias("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    split = {(r["y"], r["split"]): r["count"] for r in stratified_split(df, "y", "id").groupBy("y", "split").count().collect()}
    assert split == {(0, "test"): 180, (0, "train"): 720, (1, "test"): 20, (1, "train"): 80}
    folds = stratified_kfold(df, "y", "id", k=5).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds} == {180, 20} and len(folds) == 10
