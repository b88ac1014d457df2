"""Features, models, explanations, metrics and the daily run."""

import itertools
import math
import random
import threading
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from peoplelake.operators import boosting, checks, explain, features, metrics, models, report, rules
from peoplelake.operators.features import LABEL
from verification import binding
from peoplelake.plans.daily import run_daily
from peoplelake.sources.loads import LoadConfig
from verification.lab import Lab, lab, linear_scores


def test_feature_columns_leave_out_key_and_label(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 3.0)], f"employee_id string, {LABEL} int, last_score double, age double")
    assert features.feature_columns(df) == ["last_score", "age"]


def test_feature_frame(spark, sf_dir):
    x = lab(spark, sf_dir)
    df = x.features(binding.CUTOFF)
    labels = {r[LABEL] for r in df.select(LABEL).distinct().collect()}
    share = df.agg(F.avg(LABEL)).first()[0]
    assert df.count() > 0 and labels <= {0, 1} and 0.05 < share < 0.40
    assert not {"birth_date", "hire_date", "exit_date"} & set(df.columns)
    assert df.columns[-1] == LABEL and LABEL not in x.features(binding.AS_OF, False).columns


def test_features_before_any_event_use_defaults(spark, sf_dir):
    x = lab(spark, sf_dir)
    none = x.table("fct_performance").limit(0), x.table("fct_salary").limit(0)
    df = features.build_features(x.table("dim_employee"), *none, binding.CUTOFF)
    row = df.first()
    assert row["days_since_last_raise"] == 9999 and row["num_reviews"] == 0 and row["last_score"] == 0


def test_review_totals_do_not_travel_per_manager(spark):
    """Totals per employee, the row of a NULL employee included; no aggregate of the last review is keyed by the manager."""
    rows = [
        ("a", "1998-01-01", 3.0, 3.0, 0.0, 1, "m"), ("a", "1998-02-01", 4.0, 3.5, 1.0, 2, "n"), ("a", "1998-03-01", 2.0, 3.0, -2.0, 3, "m"),
        ("a", "1999-01-01", 5.0, 3.5, 3.0, 4, "o"), ("b", "1998-01-01", 1.0, 1.0, 0.0, 1, None), (None, "1998-01-01", 2.0, 2.0, 0.0, 1, "m"),
    ]
    columns = "employee_id string, day string, score decimal(3,2), score_4q_avg decimal(7,6), score_delta decimal(4,2), review_seq long, manager_id string"
    facts = spark.createDataFrame([(k, d, *[Decimal(str(v)) for v in vs], n, m) for k, d, *vs, n, m in rows], columns)
    got = features.feat_performance(facts.withColumn("review_date", F.col("day").cast("date")), binding.CUTOFF)
    assert {tuple(r) for r in got.collect()} == {("a", 3, 2, 3.0, 2.0, 3.0, -2.0), ("b", 1, 0, 1.0, 1.0, 1.0, 0.0), (None, 1, 1, 2.0, 2.0, 2.0, 0.0)}
    plan = got._jdf.queryExecution().sparkPlan().toString()
    keyed = [line.split("functions=")[0] for line in plan.splitlines() if "max_by" in line]
    assert keyed and not any("manager_id" in keys for keys in keyed)


def test_one_hot(spark):
    df = spark.createDataFrame([("a", "male"), ("b", None), ("c", "female")], "employee_id string, gender string")
    seen = features.observed_values(df, ["gender"])
    assert seen == {"gender": ["female", "male"]}
    got = {r["employee_id"]: (r["gender_female"], r["gender_male"]) for r in features.one_hot(df, seen).collect()}
    assert got == {"a": (0, 1), "b": (0, 0), "c": (1, 0)}
    fixed = features.align_features(features.one_hot(df, seen), ["x", "gender_male"])
    assert fixed.columns == ["employee_id", "x", "gender_male"]


def scored(n=300, seed=5, steps=8):
    rng = random.Random(seed)
    return [(int(rng.random() < 0.3), rng.randrange(steps + 1) / steps) for _ in range(n)]


@pytest.fixture(scope="module")
def tied(spark):
    return scored(), spark.createDataFrame(scored(), "y int, p double")


def test_auc_with_ties(tied):
    data, df = tied
    pos, neg = [p for y, p in data if y], [p for y, p in data if not y]
    want = sum(1 if a > b else 0.5 if a == b else 0 for a in pos for b in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df, "y", "p").first()[0] == pytest.approx(want, abs=1e-12)


def test_auc_with_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5)], "y int, p double")
    assert metrics.roc_auc(df, "y", "p").first()[0] is None


def test_average_precision_with_ties(tied):
    data, df = tied
    total, hits, want = sum(y for y, _ in data), 0, 0.0
    for t in sorted({p for _, p in data}, reverse=True):
        now = sum(y for y, p in data if p >= t)
        want += (now - hits) / total * now / sum(1 for _, p in data if p >= t)
        hits = now
    assert metrics.average_precision(df, "y", "p").first()[0] == pytest.approx(want, abs=1e-9)


def test_calibration_bins(tied):
    data, df = tied
    got = metrics.calibration_curve(df, "y", "p").collect()
    assert sum(r["n"] for r in got) == len(data)
    assert sum(r["n"] * r["frac_pos"] for r in got) == pytest.approx(sum(y for y, _ in data), abs=0.05)
    assert len(got) < 10  # nine distinct scores leave bins empty


def test_sweep_flags_nothing(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "y int, p double")
    got = metrics.threshold_sweep(df, "y", "p").orderBy("threshold").collect()
    assert all(r["precision"] == r["recall"] == r["f1"] == 0 for r in got)
    assert [r["is_best"] for r in got] == [1, 0, 0, 0, 0]


def sample(spark, n=400):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        a, b, c = rng.random(), rng.randrange(4), rng.random()
        rows.append((f"e{i}", int(a + 0.2 * b + 0.3 * rng.random() > 0.9), a, float(b), c))
    return spark.createDataFrame(rows, f"employee_id string, {LABEL} int, a double, b double, c double")


COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def trees(spark):
    df = models.with_weight(sample(spark))
    return df, models.train_gbt(df, COLUMNS, maxIter=4, maxDepth=3)


def subset_value(nodes, weights, row, known):
    """Mean margin when only the features in ``known`` are followed."""
    by_tree = {}
    for n in nodes:
        by_tree.setdefault(n["tree"], {})[n["id"]] = n

    def walk(tree, i):
        n = tree[i]
        if n["left"] < 0:
            return n["value"]
        if n["feature"] in known:
            return walk(tree, n["left"] if row[n["feature"]] <= n["threshold"] else n["right"])
        left, right = tree[n["left"]], tree[n["right"]]
        return (left["cover"] * walk(tree, n["left"]) + right["cover"] * walk(tree, n["right"])) / n["cover"]

    return sum(2 * weights[t] * walk(tree, 0) for t, tree in by_tree.items())


def test_tree_contributions_are_shapley_values(trees):
    df, model = trees
    nodes, weights = explain._node_rows(model, df), list(model.stages[-1].treeWeights)
    got = explain.explain_trees(model, explain.tree_margin(model, df)).orderBy("employee_id").limit(5).collect()
    for r in got:
        row = [r[c] for c in COLUMNS]
        value = {s: subset_value(nodes, weights, row, set(s)) for k in range(4) for s in itertools.combinations(range(3), k)}
        impacts = {c["feature"]: c["impact"] for c in r["contributions"]}
        for i, name in enumerate(COLUMNS):
            others = [j for j in range(3) if j != i]
            want = sum(
                math.factorial(k) * math.factorial(2 - k) / 6 * (value[tuple(sorted((*s, i)))] - value[s])
                for k in range(3)
                for s in itertools.combinations(others, k)
            )
            assert impacts[name] == pytest.approx(want, abs=1e-9)
        assert r["base"] == pytest.approx(value[()], abs=1e-9)
        assert r["base"] + sum(impacts.values()) == pytest.approx(r["margin"], abs=1e-9)


def test_tree_scores_and_drivers(trees):
    df, model = trees
    rows = explain.score_rows(explain.top_drivers(explain.explain_trees(model, models.score_active(model, df, "2024-01-01"))))
    for r in rows.collect():
        impacts = [r[f"driver_{i}_impact"] for i in (1, 2, 3)]
        present = [x for x in impacts if x is not None]
        assert all(x >= 0 for x in present) and present == sorted(present, reverse=True)
        assert impacts == present + [None] * (3 - len(present))
        assert r["risk_band"] in ("high", "medium", "low") and 0 <= r["risk_score"] <= 1


def test_shares_of_all_patterns_are_those_of_rows(monkeypatch):
    rng = np.random.default_rng(4)

    def leaf(d):
        low, high = np.where(rng.random(d) < 0.5, -np.inf, -rng.random(d)), np.where(rng.random(d) < 0.5, np.inf, rng.random(d))
        return explain.LeafPath(rng.choice(9, d, replace=False), low, high, rng.random(d), float(rng.normal()))

    leaves, x = [leaf(d) for d in (1, 2, 3, 5, 6, 7, 9)], rng.normal(size=(400, 9))
    x[::7, 2] = np.nan
    want = np.zeros_like(x)
    for path in leaves:
        cells = x[:, path.features]
        want[:, path.features] += explain.path_shares(path, ((cells > path.low) & (cells <= path.high)).astype(float))
    tables = explain.share_tables(leaves)
    assert [t is None for t in tables] == [False] * 5 + [True] * 2
    assert np.allclose(explain._contributions(x, leaves, tables), want, rtol=0, atol=1e-12)
    monkeypatch.setattr(explain, "path_shares", None)  # rows are looked up, not worked out again
    explain._contributions(x, leaves[:5], tables[:5])


def test_linear_contributions_add_up(spark):
    df = models.with_weight(sample(spark))
    model = models.train_logreg(df, COLUMNS, maxIter=30)
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c["impact"])
    rows = explain.explain_linear(model, models.predict(model, df)).withColumn("z", F.col("base") + total)
    gap = rows.select(F.max(F.abs(1 / (1 + F.exp(-F.col("z"))) - F.col("probability")))).first()[0]
    assert gap < 1e-9


def test_training_beats_chance_and_survives_saving(trees, tmp_path):
    df, model = trees
    auc = metrics.roc_auc(models.predict(model, df), LABEL, "probability")
    assert auc.first()[0] > 0.8
    models.save_model(model, str(tmp_path), auc)
    again = models.load_model(str(tmp_path))
    assert models.model_columns(again) == COLUMNS
    same = models.predict(again, df).exceptAll(models.predict(model, df))
    assert same.count() == 0


def test_a_fit_has_no_more_tasks_than_cores():
    assert [models.fit_partitions(n, 12) for n in (0, 1, 20_000, 20_001, 230_000, 2_500_000)] == [1, 1, 1, 2, 12, 12]
    assert models.fit_partitions(60_000_000, 12) == 120


def steps(spark, n=600, weights=(2.0, 1.0)):
    """Columns of few values, one of them constant, so that every way of binning finds the same edges."""
    rng = random.Random(3)
    rows = []
    for _ in range(n):
        a, b, c = rng.randrange(20), rng.randrange(4), rng.randrange(2)
        y = int(a + 3 * b * c + rng.gauss(0, 5) > 14)
        rows.append((y, float(a), float(b), float(c), 7.0, rng.choice(weights) if len(weights) > 2 else weights[y]))
    return spark.createDataFrame(rows, f"{LABEL} int, a double, b double, c double, d double, weight double")


EXACT = {"maxIter": 12, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}


def probabilities(model, df):
    return [r[0] for r in models.predict(model, df).select("probability").collect()]


@pytest.mark.parametrize("weights", [(2.0, 1.0), (1.0, 2.5, 0.5)])
def test_trees_are_those_of_spark(spark, weights):
    df, columns = steps(spark, weights=weights), ["a", "b", "c", "d"]
    trees = GBTClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight", seed=42, **EXACT)
    want = Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), trees]).fit(df)
    got = models.train_gbt(df, columns, **EXACT)
    assert probabilities(got, df) == pytest.approx(probabilities(want, df), abs=1e-9)
    assert got.stages[-1].treeWeights == want.stages[-1].treeWeights and got.stages[-1].getMaxIter() == 12
    assert got.stages[-1].featureImportances.toArray() == pytest.approx(want.stages[-1].featureImportances.toArray(), abs=1e-9)


def test_spread_fit_is_that_of_one_task(spark, monkeypatch):
    df, columns = steps(spark).repartition(3), ["a", "b", "c", "d"]
    want = probabilities(models.train_gbt(df, columns, **EXACT), df)
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    monkeypatch.setattr(boosting, "FRESH_ROUNDS", 5)
    monkeypatch.setattr(models, "ROWS_PER_PARTITION", 200)
    assert probabilities(models.train_gbt(df, columns, **EXACT), df) == pytest.approx(want, abs=1e-9)


def test_more_rounds_take_no_more_jobs(spark):
    df, context = models.with_weight(sample(spark)), spark.sparkContext

    def jobs(rounds):
        context.setJobGroup(f"fit of {rounds}", "")
        try:
            models.train_gbt(df, COLUMNS, maxIter=rounds)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(f"fit of {rounds}"))

    assert jobs(9) == jobs(2) > 0


def test_fit_refuses_what_it_cannot_bin(spark):
    df = steps(spark, 30)
    for column, value in (("a", None), ("b", math.nan), (LABEL, 2), ("weight", -1.0)):
        faulty = df.withColumn(column, F.when(F.col("a") > 10, F.lit(value)).otherwise(F.col(column)))
        with pytest.raises(ValueError, match="label" if column == LABEL else column):
            models.train_gbt(faulty, ["a", "b"], maxIter=1)
    with pytest.raises(ValueError, match="no rows"):
        models.train_gbt(df.limit(0), ["a", "b"], maxIter=1)


def test_one_class_gives_one_leaf(spark):
    df = steps(spark, 30).withColumn(LABEL, F.lit(1)).drop("weight")
    model = models.train_gbt(models.with_weight(df), ["d"], maxIter=2)
    assert set(probabilities(model, df)) == {0.5}  # no negative row: all weights are zero


def test_edges_of_bins():
    assert boosting.edges_of([3.0, 1.0, 1.0, 2.0], 4).tolist() == [1.5, 2.5] and boosting.edges_of([5.0] * 9, 4).tolist() == []
    assert boosting.edges_of(range(100), 4).tolist() == [24.5, 49.5, 74.5]
    assert [boosting._per_node(s, 21) for s in ("0.8", "all", "sqrt", "log2", "onethird", "5", "50")] == [17, 21, 5, 5, 7, 5, 21]


def test_summaries_are_counted_once(spark, sf_dir):
    """Whatever a second count would give, the verdict and its check read the same rows."""
    x, draw = Lab(spark, sf_dir), F.udf(random.random, "double").asNondeterministic()
    rows = sample(spark).withColumn("probability", draw()).withColumn("fold", (F.hash("employee_id") % 2).cast("int"))
    x.__dict__.update(cv=rows, linear_cv=rows, oot=rows, early=rows, parts=rows)
    for row in x.summaries():
        assert row.collect() == row.collect()


def test_evaluations_run_at_once():
    class Waiting(Lab):
        parts = early = None
        cv = oot = linear_cv = property(lambda self: self.met.wait())

        def __init__(self):
            self.met = threading.Barrier(3, timeout=20)

    Waiting().evaluate()


def test_cross_validation_and_verdict(spark):
    df = sample(spark)

    def fit(rows, columns):
        return models.train_logreg(rows, columns, maxIter=10)

    cv = models.kfold_cv(fit, df, COLUMNS, k=3)
    row = cv.first()
    assert row["k"] == 3 and 0.7 < row["auc_roc_mean"] <= 1 and row["auc_roc_std"] >= 0
    oot = models.out_of_time(fit, df, df, COLUMNS)
    assert oot.first()["n_train"] == oot.first()["n_test"] == 400
    judged = metrics.verdict(oot, cv, cv).first()
    assert judged["over_time"] == "generalizes" and judged["signal"] == "mostly_linear"


def test_default_recommendation(spark):
    calm = spark.createDataFrame(
        [("attrition_rate", 1), ("low_score_share", 1), ("voluntary_share", 1), ("salary_spread", 1), ("days_to_hire", 1),
         ("female_share", 50)],
        "metric string, v int",
    ).select("metric", F.col("v").cast("decimal(22,4)").alias("value"), F.lit(None).cast("string").alias("subject"))
    assert [r["action"] for r in rules.recommendations(calm).collect()] == ["keep_monitoring"]
    assert {r["kind"] for r in rules.insights(calm).collect()} == {"good", "info"}


def test_alert_without_rates_is_empty(spark):
    df = spark.createDataFrame([("2024-Q1", None)], "exit_year_quarter string, r int").select(
        "exit_year_quarter", F.col("r").cast("decimal(12,2)").alias("attrition_rate_pct")
    )
    assert rules.attrition_alert(df).count() == 0


def test_report_range_takes_months_in_either_order(spark, sf_dir):
    hc = lab(spark, sf_dir).table("mart_headcount")
    a = report.months_in_range(hc, report.ReportFilter(month_start="1998-01", month_end="1998-06"))
    b = report.months_in_range(hc, report.ReportFilter(month_start="1998-06", month_end="1998-01"))
    assert a.count() == b.count() == 6
    assert report.last_n_months(hc, None).count() == hc.select("year_month_key").distinct().count()


def test_declared_counts():
    by_layer = {"raw": 0, "stg": 0, "core": 0, "expressions": 0}
    for t in checks.DECLARED:
        layer = t.table.split("_")[0]
        by_layer[layer if layer in by_layer else "core"] += len(t) - len(t.expressions)
        by_layer["expressions"] += len(t.expressions)
    assert by_layer == {"raw": 21, "stg": 14, "core": 17, "expressions": 1}
    assert sum(len(t) for t in checks.DECLARED) == 53


def test_gate(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    found = checks.TableTests("t", ("id",), ("id",), {"id": (2,)}, {"never": "id > 5"}).run(df)
    counts = {(r["test"], r["failures"]) for f in found for r in f.collect()}
    assert counts == {("not_null", 1), ("unique", 1), ("accepted_values", 2), ("expression", 0)}
    with pytest.raises(checks.QualityGateError, match="t.id not_null: 1"):
        checks.quality_gate(found[0])
    checks.quality_gate(checks.test_expression(df, "t", "never", F.col("id") > 5))


def daily(spark, sf_dir, root, read):
    return run_daily(
        spark, LoadConfig(read, f"{root}/raw", binding.LOADED_AT), f"{root}/models", f"{root}/published",
        as_of=binding.AS_OF, headcount_start=binding.HEADCOUNT_START, calendar=binding.calendar_span(spark, sf_dir),
        scorer=lambda rows, as_of: explain.score_rows(linear_scores(rows, as_of)),
    )


def test_daily_run_publishes(spark, sf_dir, tmp_path):
    result = daily(spark, sf_dir, tmp_path, lambda n: binding.source_table(spark, sf_dir, n))
    assert result.tests.count() == 53 and result.scores.count() > 0 and result.alert.count() == 1
    assert (tmp_path / "published" / "export" / "risk" / "top" / "_SUCCESS").exists()


def test_failed_gate_publishes_nothing(spark, sf_dir, tmp_path):
    def read(name):
        df = binding.source_table(spark, sf_dir, name)
        return df.withColumn("status", F.lit("unheard of")) if name == "employees" else df

    with pytest.raises(checks.QualityGateError, match="status"):
        daily(spark, sf_dir, tmp_path, read)
    assert not (tmp_path / "published").exists()
