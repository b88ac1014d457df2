"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words in lower case without punctuation, their first bytes as a stem, pairs of neighbours
and pairs with one word between them, hashed to ``2**HASH_BITS`` coordinates. Every coordinate has its own learning
rate; L1 keeps all but a few thousand weights at exactly zero, and only those are sent to the tasks that score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplelake.llm.common import written
from peoplelake.llm.words import LOWER, MULTIPLIERS, mixed, text_chunks, word_bounds, word_hashes

HASH_BITS = 20
STEM_BYTES = 6
#: Labelled rows to learn from at most: those with the smallest hashes of their ids.
FIT_ROWS = 24_000
#: One learner for so many rows; learners' weights are averaged.
ROWS_PER_LEARNER = 6_000
#: Coordinates in fewer of a learner's rows are left out: their gradients don't add up to L1.
LEAST_ROWS = 3
EPOCHS = 6
PREDICT_FROM = 0.7
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 0.1

LETTERS = np.zeros(256, bool)
LETTERS[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def feature_ids(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, coordinate) arrays of words, stems, neighbours and skip-grams of every text."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, LETTERS)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = word_hashes(data, starts, ends)
    shift = np.uint64(64 - HASH_BITS)
    stems = word_hashes(data, starts, np.minimum(ends, starts + STEM_BYTES), MULTIPLIERS[1])
    out = [(rows, words >> shift), (rows, stems >> shift)]
    for gap in (1, 2):
        pairs = mixed(words[:-gap] * np.uint64(MULTIPLIERS[1]) + words[gap:] * np.uint64(2 * gap + 1))
        same = rows[:-gap] == rows[gap:]
        out.append((rows[:-gap][same], pairs[same] >> shift))
    return [(r, c.astype(np.int64)) for r, c in out]


def _values(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Feature values: repeats count by their logarithm, and long texts, which hold more of everything, less."""
    return np.log2(1.0 + counts) / np.log2(2.0 + words / 64.0)


def sparse_rows(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, coordinate, value) of all features, each pair once; only coordinates that are ``wanted``, if given."""
    parts = feature_ids(data, offsets)
    n_words = np.bincount(parts[0][0], minlength=len(offsets) - 1)
    if wanted is not None:
        parts = [(r[k], c[k]) for r, c in parts for k in [wanted[c]]]
    keys = np.concatenate([(r.astype(np.int64) << HASH_BITS) | c for r, c in parts])
    keys, counts = np.unique(keys, return_counts=True)
    rows = keys >> HASH_BITS
    return rows, keys & ((1 << HASH_BITS) - 1), _values(counts, n_words[rows])


Example = tuple[np.ndarray, np.ndarray, float]


def ftrl(examples: list[Example], size: int, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights of ``size`` coordinates and intercept; rates are ALPHA / (BETA + sqrt(sum of squared gradients))."""
    z, n = np.zeros(size), np.zeros(size)
    bias, bias_n = 0.0, 0.0
    order = np.random.default_rng(seed)

    def weights(z, root):
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + root) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            at, x, y = examples[i]
            z_at, n_at = z[at], n[at]
            root = np.sqrt(n_at)
            w = weights(z_at, root)
            slip = 1.0 / (1.0 + np.exp(-np.clip(w @ x + bias, -35, 35))) - y
            g = slip * x
            n_at = n_at + g * g
            z[at] = z_at + g - (np.sqrt(n_at) - root) / ALPHA * w
            n[at] = n_at
            bias_n += slip * slip
            bias -= ALPHA * slip / (BETA + np.sqrt(bias_n))
    return weights(z, np.sqrt(n)), float(bias)


def threshold_shift(margins: np.ndarray, labels: np.ndarray) -> float:
    """What to add to margins so that PREDICT_FROM is where F1 is highest; the middle of the gap below that margin."""
    if not labels.any():
        return 0.0
    order = np.argsort(-margins, kind="stable")
    m, hits = margins[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(m) + 1) + labels.sum())
    best = int(np.argmax(f1))
    cut = (m[best] + m[min(best + 1, len(m) - 1)]) / 2
    return float(np.log(PREDICT_FROM / (1 - PREDICT_FROM)) - cut)


def learnt(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates, weights and intercept from (coordinates, values) rows; each half is scored by the other half's weights
    to place the threshold."""
    counts = np.zeros(1 << HASH_BITS, np.int32)
    for at, _ in rows:
        counts[at] += 1
    found = np.flatnonzero(counts >= LEAST_ROWS)
    place = np.full(1 << HASH_BITS, -1, np.int32)
    place[found] = np.arange(len(found))
    examples = []
    for (at, x), y in zip(rows, labels.tolist(), strict=True):
        local = place[at]
        examples.append((local[local >= 0], x[local >= 0], y))
    margins = np.zeros(len(examples))
    for half in (0, 1):
        w, bias = ftrl(examples[1 - half :: 2], len(found))
        margins[half::2] = [w[at] @ x + bias for at, x, _ in examples[half::2]]
    w, bias = ftrl(examples, len(found))
    return found[w != 0], w[w != 0], bias + threshold_shift(margins, labels)


@dataclass(frozen=True)
class ToxicModel:
    """Non-zero coordinates in ascending order, their weights, and the intercept; at most 2**HASH_BITS of each."""

    at: np.ndarray
    weights: np.ndarray
    intercept: float


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicModel:
    """Learn from at most ``fit_rows`` labelled rows of ``docs`` (doc_id, text); null labels don't count.

    Without labels every score is one half; with labels of one kind all scores go their way.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg((F.avg("toxic") >= 0.5).cast("double").alias("label"))
    chosen = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().join(known, "doc_id")
    chosen = written(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "toxic_labels")
    n = chosen.count()
    if not n:
        return ToxicModel(np.zeros(0, np.int64), np.zeros(0), 0.0)
    learners = max(1, n // ROWS_PER_LEARNER)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.withColumn("learner", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(learners)))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])
        examples = []
        for _, n, data, offsets in text_chunks(pa.RecordBatch.from_pandas(pdf[["text"]], preserve_index=False)):
            row, at, x = sparse_rows(data, offsets)
            cut = np.searchsorted(row, np.arange(n + 1))
            at, x = at.astype(np.int32), x.astype(np.float32)
            examples += [(at[a:b], x[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        at, weights, bias = learnt(examples, pdf["label"].to_numpy())
        return pd.DataFrame({"at": np.append(at, -1), "weight": np.append(weights, bias)})

    parts = rows.groupBy("learner").applyInPandas(learn, "at long, weight double")
    found = parts.groupBy("at").agg((F.sum("weight") / learners).alias("weight")).orderBy("at").toPandas()
    weights = found[found["at"] >= 0]
    return ToxicModel(weights["at"].to_numpy(np.int64), weights["weight"].to_numpy(), float(found.loc[found["at"] < 0, "weight"].sum()))


def toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: more likely toxic) of every whole text; a null or empty text gets the base score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        wanted, weights = np.zeros(1 << HASH_BITS, bool), np.zeros(1 << HASH_BITS)
        wanted[model.at], weights[model.at] = True, model.weights
        for batch in batches:
            for row, n, data, offsets in text_chunks(batch):
                rows, at, x = sparse_rows(data, offsets, wanted)
                margin = np.bincount(rows, weights=weights[at] * x, minlength=n) + model.intercept
                score = 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, n), pa.array(score)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def held_out(doc_id):
    """Rows that take no part in learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; what is held out is not learnt from. Null ids never are."""
    model = fit_toxicity(docs.filter(~held_out(F.col("doc_id"))), labels, fit_rows)
    rows = toxicity(docs, model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))
