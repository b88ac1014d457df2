"""Quality of documents by hierarchical empirical Bayes: document evidence shrunk to the path, the host and the corpus.

A logistic regression on surface features of the text gives each document's evidence. Hosts and paths get Beta
posteriors of the share of good documents: a path is drawn to its host and a host to the corpus, each by a prior weight
that the method of moments takes from how much such groups differ. The score multiplies the document's likelihood
ratio with the odds of its path.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.llm.common import set_aside, written
from peoplelake.llm.words import text_chunks, word_bounds, word_hashes

#: Labelled rows that the classifier is fitted on: those with the smallest hashes of their ids.
FIT_ROWS = 40_000
KEEP_FROM = 0.5
FEATURES = ("words", "word_length", "upper", "digits", "pipes", "marks", "symbols", "lines", "distinct")
#: Log-odds are cut here, so that no document's evidence is infinite.
LOGIT_BOUND = 30.0


def _byte_class(chars: str) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[[ord(c) for c in chars]] = 1
    return out


CLASSES = {
    "upper": _byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _byte_class("0123456789"), "pipes": _byte_class("|"),
    "marks": _byte_class("!?"), "symbols": _byte_class("#$%&*+<=>@[\\]^_`{}~/"), "lines": _byte_class("\n"),
}


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text; an empty text has zeros."""
    n = len(offsets) - 1
    starts, ends, first = word_bounds(data, offsets)
    words = np.diff(first)
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    many = np.maximum(words, 1)
    out = np.zeros((n, len(FEATURES)))
    filled = np.flatnonzero(np.diff(offsets) > 0)
    out[:, 0] = np.log1p(words)
    spelt = words > 0
    if spelt.any():
        out[spelt, 1] = np.add.reduceat(ends - starts, first[:-1][spelt])
        pairs = np.repeat(np.arange(n), words).astype(np.uint64) << np.uint64(48) | word_hashes(data, starts, ends) >> np.uint64(16)
        out[:, 8] = np.bincount((np.unique(pairs) >> np.uint64(48)).astype(np.int64), minlength=n) / many
    out[:, 1] /= many
    for i, name in enumerate(FEATURES):
        if name in CLASSES and len(filled):
            out[filled, i] = np.add.reduceat(CLASSES[name][data], offsets[:-1][filled], dtype=np.int64)
    for i, name in enumerate(FEATURES):
        if name in CLASSES:
            out[:, i] /= size
    return out


def with_features(docs: DataFrame, name: str = "quality_features") -> DataFrame:
    """``docs`` with an array column of FEATURES of the whole text (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, n, data, offsets in text_chunks(batch):
                values = pa.array(text_features(data, offsets).ravel())
                lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * len(FEATURES), values)
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))]))


@dataclass(frozen=True)
class Evidence:
    """Document classifier: weights of the features, intercept and the share of good rows it was fitted on."""

    weights: tuple[float, ...]
    intercept: float
    base: float

    def probability(self, features: Column) -> Column:
        terms = F.zip_with(features, F.array(*[F.lit(w) for w in self.weights]), lambda x, w: x * w)
        margin = F.aggregate(terms, F.lit(self.intercept), lambda s, x: s + x)
        return F.lit(1.0) / (1.0 + F.exp(-F.greatest(F.lit(-LOGIT_BOUND), F.least(F.lit(LOGIT_BOUND), margin))))


def fit_evidence(features: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Evidence:
    """Fit on at most ``fit_rows`` labelled rows. Several labels of one document count by their mean; null labels don't.

    Without labels of both kinds there is no evidence: every document gets the smoothed share of good labels.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    rows = features.select("doc_id", "quality_features").join(known, "doc_id")
    rows = written(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "quality_fit")
    n, good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    base = (good + 1) / (n + 2)
    if good in (0, n):
        return Evidence((0.0,) * len(FEATURES), math.log(base / (1 - base)), base)
    model = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-3, maxIter=200)
    model = model.fit(rows.select("label", array_to_vector("quality_features").alias("x")))
    return Evidence(tuple(map(float, model.coefficients)), float(model.intercept), base)


def _strength(mean: float, n: float, groups: float, spread: float, noise: float) -> float:
    """Prior weight of a Beta distribution from the variance between groups that sampling does not explain."""
    between = (spread - noise) / n if n else 0.0
    if groups < 2 or between <= 0:
        return 1e6
    return min(1e6, max(1.0, mean * (1 - mean) / between - 1))


@dataclass(frozen=True)
class Sites:
    """Documents and expected good ones of every path (n, s) and of its host (hn, hs), the share in the corpus, and the
    weights with which a host is drawn to the corpus and a path to its host."""

    counts: DataFrame
    mean: float
    host_weight: float
    path_weight: float


def site_posteriors(scored: DataFrame, host: str, path: str) -> Sites:
    """Counts and prior weights of all paths. ``scored`` has a probability for each document; null hosts and paths are
    groups of their own."""
    paths = written(scored.groupBy(host, path).agg(F.count(F.lit(1)).alias("n"), F.sum("probability").alias("s")), "paths")
    n, s = paths.agg(F.sum("n"), F.sum("s")).first()
    mean = s / n if n else 0.5
    hosts = paths.groupBy(host).agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    spread = hosts.agg(
        F.count(F.lit(1)), F.sum(F.col("hn") * F.pow(F.col("hs") / F.col("hn") - mean, 2)), F.lit(mean * (1 - mean)) * F.count(F.lit(1))
    ).first()
    host_weight = _strength(mean, n or 0, spread[0], spread[1] or 0.0, spread[2] or 0.0)
    key = F.struct(F.coalesce(host, F.lit("")), F.col(host).isNull())
    both = paths.withColumn("_k", key).join(hosts.withColumn("_k", key).select("_k", "hn", "hs"), "_k").drop("_k")
    host_mean = (F.col("hs") + host_weight * mean) / (F.col("hn") + host_weight)
    inner = both.agg(
        F.count(F.lit(1)), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - host_mean, 2)), F.sum(host_mean * (1 - host_mean)),
    ).first()
    return Sites(both.select(host, path, "n", "s", "hn", "hs"), mean, host_weight, _strength(mean, n or 0, inner[0], inner[1] or 0.0, inner[2] or 0.0))


@dataclass(frozen=True)
class QualityModel:
    evidence: Evidence
    sites: Sites
    host: str
    path: str

    def score(self, featured: DataFrame, fitted: bool = True) -> DataFrame:
        """``featured`` with probability, prior, site_docs, quality_score (0 to 1) and keep.

        A document's prior is the posterior of its path without the document itself, which the ``fitted`` ones are part of.
        """
        host, path, sites = self.host, self.path, self.sites
        counts = sites.counts.select(F.col(host).alias("_host"), F.col(path).alias("_path"), "n", "s", "hn", "hs")
        rows = featured.withColumn("probability", self.evidence.probability(F.col("quality_features")))
        rows = rows.join(counts, F.col(host).eqNullSafe(F.col("_host")) & F.col(path).eqNullSafe(F.col("_path")), "left").drop("_host", "_path")
        own, one = (F.col("probability"), F.lit(1)) if fitted else (F.lit(0.0), F.lit(0))
        host_mean = (F.col("hs") - own + sites.host_weight * sites.mean) / (F.col("hn") - one + sites.host_weight)
        prior = (F.col("s") - own + sites.path_weight * host_mean) / (F.col("n") - one + sites.path_weight)
        odds = lambda p: F.log(p / (1 - p))
        prior = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.coalesce(prior, F.lit(sites.mean))))
        base = math.log(self.evidence.base / (1 - self.evidence.base))
        rows = rows.withColumn("prior", prior)
        logit = odds(F.col("probability")) - base + odds(F.col("prior"))
        score = 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-2 * LOGIT_BOUND), F.least(F.lit(2 * LOGIT_BOUND), logit))))
        return rows.withColumn("site_docs", F.col("n")).drop("n", "s", "hn", "hs").withColumn("quality_score", score).withColumn("keep", F.col("quality_score") >= KEEP_FROM)


def fit_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", fit_rows: int = FIT_ROWS) -> tuple[QualityModel, DataFrame]:
    """Evidence and posteriors of all of ``docs`` (doc_id, text, host and path columns), and the features without texts."""
    featured = written(with_features(docs.select("doc_id", "text", host, path)).drop("text"), "quality")
    evidence = fit_evidence(featured, labels, fit_rows)
    scored = featured.withColumn("probability", evidence.probability(F.col("quality_features")))
    sites = site_posteriors(scored, host, path)
    return QualityModel(evidence, replace(sites, counts=written(sites.counts, "sites")), host, path), featured


def document_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality_score, keep and what they rest on, for every document.

    Null texts count as empty, null sources and languages as groups of their own; repeated rows are scored each.
    """
    model, featured = fit_quality(docs, labels)
    return model.score(featured).select("doc_id", "quality_score", "keep", "probability", "prior", "site_docs")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of ``docs`` that are not rejected, with the same columns."""
    model, _ = fit_quality(docs, labels)
    rows, names = set_aside(docs, ("doc_id", "text", "source", "lang"))
    return model.score(with_features(rows)).filter("keep").select(*names)
