"""Attrition models: boosted trees, the logistic baseline, scoring and evaluation runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.functions.scalar import day, risk_band
from peoplelake.operators import boosting
from peoplelake.operators.features import LABEL, class_weight, stratified_kfold
from peoplelake.operators.metrics import average_precision, average_precision_by, roc_auc, roc_auc_by
from peoplelake.sources.sinks import materialize, run_dir

#: A round's tasks are worth starting from this many rows on; with a task for every core, they grow to the most.
ROWS_PER_PARTITION, MOST_ROWS_PER_PARTITION = 20_000, 500_000
# The published training parameters.
TREE_PARAMS = {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}


def with_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add ``weight``: negatives per positive for positive rows, 1 for the others."""
    ratio = class_weight(df, label).select("weight").scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def fit_partitions(rows: int, cores: int) -> int:
    """Partitions for a fit of many short stages: no more than there are cores, unless they would hold too many rows."""
    return max(1, min(-(-rows // ROWS_PER_PARTITION), max(cores, -(-rows // MOST_ROWS_PER_PARTITION))))


def train_gbt(
    df: DataFrame, columns: Sequence[str], label: str = LABEL, weight: str | None = "weight", seed: int = 42, **params
) -> PipelineModel:
    """Boosted trees with Spark's model and rules; ``operators.boosting`` fits them, columns are sampled per node.

    A spread fit is many short stages, so there are no more tasks than ``fit_partitions`` asks for.
    """
    trees = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **{**TREE_PARAMS, **params})
    if weight is not None:
        trees = trees.setWeightCol(weight)
    cores = df.sparkSession.sparkContext.defaultParallelism
    assemble = VectorAssembler(inputCols=list(columns), outputCol="features")
    return PipelineModel([assemble, boosting.fit(df, columns, trees, lambda rows: fit_partitions(rows, cores))])


def train_logreg(
    df: DataFrame, columns: Sequence[str], label: str = LABEL, weight: str | None = "weight", **params
) -> PipelineModel:
    """Standardised logistic regression with an L2 penalty of strength 1.

    The published penalty is half the squared coefficients against the sum of the weighted losses; Spark takes the mean
    loss, so its ``regParam`` is one over the sum of the weights.
    """
    total = df.agg(F.sum(weight) if weight is not None else F.count(F.lit(1))).first()[0]
    settings = {"maxIter": 1000, "tol": 1e-9, "regParam": 1.0 / total if total else 0.0, "standardization": False, **params}
    line = LogisticRegression(labelCol=label, featuresCol="features", **settings)
    if weight is not None:
        line = line.setWeightCol(weight)
    assemble = VectorAssembler(inputCols=list(columns), outputCol="raw_features")
    scale = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    model = Pipeline(stages=[assemble, scale, line]).fit(df)
    # a fitted line keeps its training summary, and with it the session, which tasks can't take along once it observes metrics
    path = run_dir(df.sparkSession, "logreg")
    save_model(model, path)
    return load_model(path)


def model_columns(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input rows with ``probability`` of leaving as a double."""
    keep = [c for c in df.columns if c != "probability"]
    out = model.transform(df.select(*keep))
    return out.select(*keep, vector_to_array("probability")[1].alias("probability"))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """All features of a tree model with their importance and rank."""
    values = zip(model_columns(model), model.stages[-1].featureImportances.toArray().tolist())
    ranked = sorted(values, key=lambda v: (-v[1], v[0]))
    rows = [(name, value, i + 1) for i, (name, value) in enumerate(ranked)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


def score_active(model: PipelineModel, features: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Score rows: four decimals for the score, the band from the unrounded one."""
    p = F.col("probability")
    return predict(model, features).select(
        *features.columns,
        day(as_of).alias("scored_at"),
        F.round(p.cast("decimal(20,16)"), 4).cast("decimal(5,4)").alias("risk_score"),
        risk_band(p).alias("risk_band"),
    )


def _evaluate(scored: DataFrame, label: str) -> DataFrame:
    auc, ap = roc_auc(scored, label, "probability"), average_precision(scored, label, "probability")
    return scored.agg(
        F.count(F.lit(1)).alias("n_test"), F.round(F.avg(F.col(label).cast("double")), 4).alias("base_rate_test")
    ).select("*", F.round(auc.scalar(), 4).alias("auc_roc"), F.round(ap.scalar(), 4).alias("auc_pr"))


Fit = Callable[[DataFrame, Sequence[str]], PipelineModel]


def out_of_time_predictions(fit: Fit, train: DataFrame, test: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """The test rows with the probability of a model fitted at an earlier cutoff."""
    return predict(fit(with_weight(train, label), columns), test)


def out_of_time_summary(predictions: DataFrame, train: DataFrame, label: str = LABEL) -> DataFrame:
    seen = train.agg(
        F.count(F.lit(1)).alias("n_train"), F.round(F.avg(F.col(label).cast("double")), 4).alias("base_rate_train")
    )
    return _evaluate(predictions, label).select(
        seen.select("n_train").scalar().alias("n_train"), "n_test",
        seen.select("base_rate_train").scalar().alias("base_rate_train"), "base_rate_test", "auc_roc", "auc_pr",
    )


def out_of_time(fit: Fit, train: DataFrame, test: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """Fit at an earlier cutoff, measure at a later one."""
    return out_of_time_summary(out_of_time_predictions(fit, train, test, columns, label), train, label)


def kfold_predictions(
    fit: Fit, df: DataFrame, columns: Sequence[str], label: str = LABEL, id_col: str = "employee_id", k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Every row with its fold and the probability of the model that was fitted on the other folds.

    The weight comes from all rows, as in the published evaluation. One fit per fold, all at once; each writes what it
    predicts, so that metrics start from files and not from the models.
    """
    folds = stratified_kfold(with_weight(df, label), label, id_col, k, seed)
    folds = materialize(folds, run_dir(df.sparkSession, "folds"))

    def held(i: int) -> DataFrame:
        model = fit(folds.filter(F.col("fold") != i), columns)
        rows = predict(model, folds.filter(F.col("fold") == i)).select(id_col, "fold", label, "probability")
        return materialize(rows, run_dir(df.sparkSession, f"fold-{i}"))

    with ThreadPoolExecutor(max_workers=k) as pool:
        held_out = list(pool.map(held, range(k)))
    return reduce(DataFrame.unionByName, held_out)


def kfold_summary(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """Mean and population deviation of both ranking metrics over the folds, measured together and grouped by fold."""
    auc = roc_auc_by(predictions, ["fold"], label, "probability")
    ap = average_precision_by(predictions, ["fold"], label, "probability")
    return auc.join(ap, "fold").agg(
        F.count(F.lit(1)).alias("k"),
        *[
            F.round(how(c), 4).alias(f"{c}_{name}")
            for c in ("auc_roc", "auc_pr")
            for name, how in (("mean", F.avg), ("std", F.stddev_pop))
        ],
    )


def kfold_cv(
    fit: Fit, df: DataFrame, columns: Sequence[str], label: str = LABEL, id_col: str = "employee_id", k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Both ranking metrics over class-preserving folds."""
    return kfold_summary(kfold_predictions(fit, df, columns, label, id_col, k, seed), label)


def save_model(model: PipelineModel, path: str, metrics: DataFrame | None = None) -> None:
    """Model with its column list (kept by the assembler stage) and, next to it, its metrics."""
    model.write().overwrite().save(f"{path}/model")
    if metrics is not None:
        metrics.coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")
