"""Raw layer, models and scores of one data folder, built on first use and shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from peoplelake.functions.ordered import HOT_ROWS
from peoplelake.operators import exports
from peoplelake.operators.explain import explain_trees, linear_contributions, score_linear, score_rows, top_drivers
from peoplelake.operators.features import LABEL, align_features, build_features, feature_columns, observed_values, one_hot, stratified_split
from peoplelake.operators.models import (
    kfold_predictions,
    kfold_summary,
    load_model,
    out_of_time_predictions,
    out_of_time_summary,
    save_model,
    score_active,
    train_gbt,
    train_logreg,
    with_weight,
)
from verification import binding
from peoplelake.plans.warehouse import Warehouse
from peoplelake.schemas import TABLES
from peoplelake.sources.loads import add_lineage
from peoplelake.sources.sinks import materialize, run_dir, write_scores

# A fixed linear score, so that bands and drivers can be recomputed in SQL. Weights and centers are exact decimals.
INTERCEPT = "0.35"
WEIGHTS = {
    "last_score": "-0.12",
    "days_since_last_raise": "0.0003",
    "tenure_days_at_cutoff": "-0.0001",
    "num_reviews": "-0.005",
}
CENTERS = {"last_score": "3", "days_since_last_raise": "400", "tenure_days_at_cutoff": "900", "num_reviews": "10"}


def linear_scores(features: DataFrame, as_of) -> DataFrame:
    """Features with contributions, score, band and drivers of the fixed linear score."""
    return top_drivers(score_linear(linear_contributions(features, WEIGHTS, CENTERS), INTERCEPT, as_of))


#: Writes a raw table or a model (frame, path, name) and reads it back.
Write = Callable[[DataFrame, str, str], DataFrame]


def _materialized(df: DataFrame, path: str, name: str) -> DataFrame:
    return materialize(df, path)


class Lab:
    def __init__(self, spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS, write: Write = _materialized):
        self.spark, self.sf_dir, self.write = spark, sf_dir, write
        self.root = run_dir(spark, "lab")
        self._raw: dict[str, DataFrame] = {}
        self.warehouse = Warehouse(
            spark,
            self.raw,
            f"{self.root}/models",
            as_of=binding.AS_OF,
            headcount_start=binding.HEADCOUNT_START,
            calendar=binding.calendar_span(spark, sf_dir),
            hot_rows=hot_rows,
            write=write,
        )

    def star(self, table: str) -> DataFrame:
        return binding.star(self.spark, self.sf_dir, table)

    def source(self, name: str) -> DataFrame:
        return binding.source_table(self.spark, self.sf_dir, name)

    def raw(self, target: str) -> DataFrame:
        if target not in self._raw:
            name = next(t.source for t in TABLES if t.target == target)
            rows = add_lineage(self.source(name), f"star.{name}", binding.LOADED_AT)
            self._raw[target] = self.write(rows, f"{self.root}/raw/{target}", target)
        return self._raw[target]

    def view(self, name: str) -> DataFrame:
        return self.warehouse.view(name)

    def table(self, name: str) -> DataFrame:
        return self.warehouse.table(name)

    def model(self, name: str) -> DataFrame:
        return self.warehouse.model(name)

    def features(self, cutoff, for_training: bool = True) -> DataFrame:
        rows = build_features(
            self.table("dim_employee"),
            self.table("fct_performance"),
            self.table("fct_salary"),
            cutoff,
            for_training=for_training,
        )
        return self.warehouse.put(f"features_{cutoff}_{for_training}", rows)

    @cached_property
    def labelled(self) -> DataFrame:
        """Training features with the linear score: the input of the metric queries."""
        return self.warehouse.put("labelled", linear_scores(self.features(binding.CUTOFF), binding.CUTOFF))

    @cached_property
    def codes(self) -> dict[str, list[str]]:
        return observed_values(self.features(binding.CUTOFF))

    @cached_property
    def columns(self) -> list[str]:
        return feature_columns(one_hot(self.features(binding.CUTOFF), self.codes))

    @cached_property
    def parts(self) -> DataFrame:
        """Model matrix of the training cutoff with its split."""
        rows = align_features(one_hot(self.features(binding.CUTOFF), self.codes), self.columns, ("employee_id", LABEL))
        return self.warehouse.put("parts", stratified_split(rows, LABEL, "employee_id"))

    @cached_property
    def tree_model(self) -> PipelineModel:
        """Boosted trees with all published settings on the training part: fitted once, stored and loaded again."""
        path = f"{self.root}/tree_model"
        save_model(train_gbt(with_weight(self.parts.filter("split = 'train'")), self.columns), path)
        return load_model(path)

    @cached_property
    def cv(self) -> DataFrame:
        """Held-out predictions of the tree model's folds."""
        return self.warehouse.put("cv", kfold_predictions(train_gbt, self.parts.drop("split"), self.columns))

    @cached_property
    def linear_cv(self) -> DataFrame:
        return self.warehouse.put("linear_cv", kfold_predictions(train_logreg, self.parts.drop("split"), self.columns))

    @cached_property
    def early(self) -> DataFrame:
        """Training features of the earlier cutoff."""
        return self.features(binding.EARLIER_CUTOFF)

    @cached_property
    def oot(self) -> DataFrame:
        """Predictions at the training cutoff by a tree model fitted at the earlier one."""
        codes = observed_values(self.early)
        columns = feature_columns(one_hot(self.early, codes))
        train, test = (align_features(one_hot(r, codes), columns, ("employee_id", LABEL)) for r in (self.early, self.features(binding.CUTOFF)))
        rows = out_of_time_predictions(train_gbt, train, test, columns).select("employee_id", LABEL, "probability")
        return self.warehouse.put("oot", rows)

    def evaluate(self) -> None:
        """Predictions of all three evaluations at once: their fits don't need each other, and each waits for many short stages."""
        _ = self.parts, self.early
        with ThreadPoolExecutor(max_workers=3) as pool:
            list(pool.map(lambda name: getattr(self, name), ("cv", "oot", "linear_cv")))

    def summaries(self) -> list[DataFrame]:
        """The summary of each evaluation (out of time, folds, folds of the baseline), counted once: whoever reads it gets the same row."""
        self.evaluate()
        rows = {
            "oot_summary": lambda: out_of_time_summary(self.oot, self.early),
            "cv_summary": lambda: kfold_summary(self.cv),
            "linear_cv_summary": lambda: kfold_summary(self.linear_cv),
        }
        with ThreadPoolExecutor(max_workers=len(rows)) as pool:
            return list(pool.map(lambda name: self.warehouse.put(name, rows[name]()), rows))

    def tree_scores(self, rows: DataFrame, as_of) -> DataFrame:
        """Score rows of the stored tree model, with the drivers of every employee."""
        today = align_features(one_hot(rows, self.codes), self.columns)
        scored = score_active(self.tree_model, today, as_of)
        return score_rows(top_drivers(explain_trees(self.tree_model, scored)))

    @cached_property
    def scores(self) -> DataFrame:
        """Score table with two scoring days."""
        path = f"{self.root}/attrition_scores"
        for cutoff in (binding.CUTOFF, binding.AS_OF):
            write_scores(score_rows(linear_scores(self.features(cutoff, False), cutoff)), path)
        return self.spark.read.parquet(path)

    @cached_property
    def risk_totals(self) -> DataFrame:
        return self.warehouse.put("risk_totals", exports.risk_totals(self.scores, self.table("dim_employee")))

    @cached_property
    def risk_detail(self) -> DataFrame:
        rows = exports.risk_detail(
            self.scores,
            self.table("dim_employee"),
            self.table("dim_department"),
            self.table("dim_job_level"),
            self.table("fct_performance"),
        )
        return self.warehouse.put("risk_detail", rows)

    @cached_property
    def perf_dist(self) -> DataFrame:
        rows = exports.perf_dist(self.table("fct_performance"), self.table("dim_employee"))
        return self.warehouse.put("perf_dist", rows)

    @cached_property
    def perf_by_dept(self) -> DataFrame:
        rows = exports.perf_by_dept(
            self.table("fct_performance"), self.table("dim_employee"), self.table("dim_department")
        )
        return self.warehouse.put("perf_by_dept", rows)


_LABS: dict[tuple[str, str], Lab] = {}


def lab(spark: SparkSession, sf_dir: str) -> Lab:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LABS:
        _LABS[key] = Lab(spark, sf_dir)
    return _LABS[key]
