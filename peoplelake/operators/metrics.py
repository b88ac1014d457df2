"""Model metrics as DataFrame operators.

Ranking metrics first collapse rows to distinct scores. Running counts then come from chunks of about equally many distinct scores, so no
task holds all scores, wherever they lie.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplelake.functions.ordered import ranked_histogram, running_totals, with_chunks

# Thresholds of the sweep; features tried alone, with the direction in which risk grows.
THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
SIGNED_FEATURES = {
    "last_score": -1, "days_since_last_raise": 1, "dept_attrition_rate": 1, "last_4q_avg": -1,
    "tenure_days_at_cutoff": -1,
}


def _score_counts(df: DataFrame, group: Sequence[str], label: str, score: str, sign: int) -> DataFrame:
    """Distinct scores with class counts, and the counts before them in ``sign`` order; rows without a score don't count."""
    counts = df.filter(F.col(score).isNotNull()).groupBy(*group, F.col(score).cast("double").alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    counts = counts.withColumn("_s", F.col("_s") * F.lit(float(sign)))
    return running_totals(with_chunks(counts, group, "_s"), group, "_chunk", ["_s"], ["pos", "neg"])


def _area(name: str = "auc_roc") -> Column:
    """Doubled rank sum over doubled pair count: integers up to the final division."""
    twice = F.sum(F.col("pos").cast("decimal(19,0)") * (F.col("neg_before") * 2 + F.col("neg")))
    pairs = F.max("pos_total").cast("decimal(19,0)") * F.max("neg_total") * 2
    return (twice.cast("double") / F.nullif(pairs.cast("double"), F.lit(0.0))).alias(name)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve; ties count half. NULL when a class is missing."""
    return _score_counts(df, [], label, score, 1).agg(_area())


def roc_auc_by(df: DataFrame, group: Sequence[str], label: str, score: str) -> DataFrame:
    return _score_counts(df, group, label, score, 1).groupBy(*group).agg(_area())


def _precision_area() -> Column:
    hits = F.col("pos_before") + F.col("pos")
    flagged = hits + F.col("neg_before") + F.col("neg")
    share = F.col("pos").cast("double") / F.nullif(F.col("pos_total"), F.lit(0)).cast("double")
    return F.sum(share * hits.cast("double") / flagged.cast("double"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Sum of precision times recall step over distinct thresholds, highest first."""
    return _score_counts(df, [], label, score, -1).agg(F.round(_precision_area(), 10).alias("auc_pr"))


def average_precision_by(df: DataFrame, group: Sequence[str], label: str, score: str) -> DataFrame:
    counts = _score_counts(df, group, label, score, -1)
    return counts.groupBy(*group).agg(F.round(_precision_area(), 10).alias("auc_pr"))


def brier_score(df: DataFrame, label: str, score: str) -> DataFrame:
    error = F.col(score).cast("double") - F.col(label)
    return df.agg(F.round(F.avg(error * error), 10).alias("brier_score"))


def _confusion(label: str, flagged: Column) -> list[Column]:
    y = F.col(label)
    return [
        F.count_if((y == 0) & ~flagged).alias("tn"),
        F.count_if((y == 0) & flagged).alias("fp"),
        F.count_if((y == 1) & ~flagged).alias("fn"),
        F.count_if((y == 1) & flagged).alias("tp"),
    ]


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    return df.agg(*_confusion(label, F.col(score).cast("double") >= threshold))


def _share(num: Column, den: Column) -> Column:
    """Double division that is 0 when undefined."""
    return F.coalesce(num.cast("double") / F.nullif(den, F.lit(0)).cast("double"), F.lit(0.0))


def _prf(hit: Column, wrong: Column, missed: Column) -> tuple[Column, Column, Column]:
    return _share(hit, hit + wrong), _share(hit, hit + missed), _share(hit * 2, hit * 2 + wrong + missed)


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, and the macro and weighted means."""
    c = {name: F.col(name) for name in ("tn", "fp", "fn", "tp")}
    p0, r0, f0 = _prf(c["tn"], c["fn"], c["fp"])
    p1, r1, f1 = _prf(c["tp"], c["fp"], c["fn"])
    n0, n1 = c["tn"] + c["fp"], c["tp"] + c["fn"]
    total = n0 + n1
    accuracy = _share(c["tn"] + c["tp"], total)

    def row(name, p, r, f, n):
        cells = [F.round(x, 6).alias(k) for k, x in (("precision", p), ("recall", r), ("f1", f))]
        return F.struct(F.lit(name).alias("class"), *cells, n.alias("support"))

    def mixed(a, b):
        return (a * n0.cast("double") + b * n1.cast("double")) / F.nullif(total, F.lit(0)).cast("double")

    rows = F.array(
        row("0", p0, r0, f0, n0),
        row("1", p1, r1, f1, n1),
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        row("weighted avg", mixed(p0, p1), mixed(r0, r1), mixed(f0, f1), total),
    )
    return confusion_matrix(df, label, score, threshold).select(F.inline(rows))


def threshold_sweep(
    df: DataFrame, label: str, score: str, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Precision, recall, F1 and flagged rows per threshold; ``is_best`` marks the first best F1.

    All thresholds are counted in one pass over the rows.
    """
    s, y = F.col(score).cast("double"), F.col(label)
    counts = df.agg(
        F.count_if(y == 1).alias("pos"),
        *[F.count_if(s >= t).alias(f"n{i}") for i, t in enumerate(thresholds)],
        *[F.count_if((s >= t) & (y == 1)).alias(f"tp{i}") for i, t in enumerate(thresholds)],
    )

    def row(i, t):
        hit, flagged = F.col(f"tp{i}"), F.col(f"n{i}")
        p, r, f = _prf(hit, flagged - hit, F.col("pos") - hit)
        return F.struct(
            F.lit(float(t)).alias("threshold"),
            F.round(p, 3).alias("precision"),
            F.round(r, 3).alias("recall"),
            F.round(f, 3).alias("f1"),
            flagged.alias("n_flagged"),
        )

    table = counts.select(F.array(*[row(i, t) for i, t in enumerate(thresholds)]).alias("rows"))
    by_f1 = F.transform("rows", lambda r: F.struct(r["f1"].alias("f1"), (-r["threshold"]).alias("t")))
    ranked = table.select("rows", F.array_max(by_f1).alias("best")).select(F.inline("rows"), "best")
    is_best = (F.col("f1") == F.col("best.f1")) & (F.col("threshold") == -F.col("best.t"))
    return ranked.select("threshold", "precision", "recall", "f1", "n_flagged", is_best.cast("int").alias("is_best"))


def calibration_curve(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score and positive share per quantile bin; empty bins are left out.

    Edges are exact linear-interpolated quantiles. Each needs the scores at two ranks, read off the histogram of
    distinct scores, so the rows are never sorted as a whole.
    """
    scored = df.filter(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("_s"), F.col(label).alias("_y"))
    hist = ranked_histogram(scored, [], "_s")
    position = [(F.col("n_total") - 1) * i / F.lit(bins) for i in range(bins + 1)]

    def at(rank: Column) -> Column:
        """Score of the row with this 0-based rank."""
        return F.max(F.when((F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n")), F.col("_s")))

    parts = hist.agg(
        F.max("n_total").alias("n_total"),
        *[at(F.floor(p)).alias(f"lo{i}") for i, p in enumerate(position)],
        *[at(F.ceil(p)).alias(f"hi{i}") for i, p in enumerate(position)],
    )
    edges = parts.select(
        F.array(
            *[
                F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (p - F.floor(p))
                for i, p in enumerate(position)
            ]
        ).alias("edges")
    ).scalar()
    # A score belongs to the number of inner edges below it.
    inner = F.slice("_edges", 2, bins - 1)
    bin_no = F.size(F.filter(inner, lambda e: e < F.col("_s")))
    return (
        scored.withColumn("_edges", edges)
        .groupBy(bin_no.alias("bin"))
        .agg(
            F.round(F.avg("_s"), 4).alias("mean_pred"),
            F.round(F.avg(F.col("_y").cast("double")), 4).alias("frac_pos"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def single_feature_auc(
    df: DataFrame, label: str, features: Mapping[str, int] = SIGNED_FEATURES
) -> DataFrame:
    """ROC AUC of each signed feature alone, over one long form of the rows."""
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), (F.col(f).cast("double") * F.lit(float(s))).alias("value"))
            for f, s in features.items()
        ]
    )
    long = df.select(F.col(label), F.inline(cells))
    return roc_auc_by(long, ["feature"], label, "value")


def verdict(oot: DataFrame, cv: DataFrame, baseline: DataFrame) -> DataFrame:
    """Three judgements on one-row inputs: drift over time, stability over folds, linear against trees."""
    o, c = oot.select("auc_roc").scalar(), cv.select("auc_roc_mean").scalar()
    std, lin = cv.select("auc_roc_std").scalar(), baseline.select("auc_roc_mean").scalar()
    one = oot.select(
        o.alias("oot_auc"), c.alias("cv_auc"), std.alias("cv_std"), lin.alias("linear_auc"),
        F.round(c - o, 6).alias("drop"),
    )
    return one.select(
        "*",
        F.when(F.col("drop") <= 0.04, "generalizes").otherwise("drifts").alias("over_time"),
        F.when(F.col("cv_std") <= 0.02, "stable").otherwise("unstable").alias("over_folds"),
        F.when(F.col("linear_auc") >= F.col("cv_auc"), "mostly_linear").otherwise("nonlinear_gain").alias("signal"),
    )
