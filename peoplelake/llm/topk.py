"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... segments of equal length; mean m and deviation s of each segment of length L bound the
inner product, ``q.x <= sum of L * (mq * mx + sq * sx)``, and with it the distance from below. In every block of
candidates a query's bounds are taken coarse to fine: a candidate goes on only while its bound reaches the k-th best
score known so far, and survivors of the finest level are scored exactly. The known score starts from an exact search
in a bounded seed sample, which is never more than a start. Queries and candidates meet block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.llm.common import written

#: Rows of a block of candidates and of a block of queries: the memory of a task is their product.
CANDIDATE_ROWS, QUERY_ROWS = 8192, 1024
#: Candidates in the seed sample.
SEED_ROWS = 1024
SCALE = 256
LEVELS = (1, 2, 4, 8)
#: Bounds are raised by this share of the vectors' lengths for what rounding may have taken from them.
SLACK = 1e-9


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Components as floor(scale * x); null for null vectors and vectors with null or non-finite components.

    Products and their sums are exact as long as the score stays below 2**53.
    """
    x = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: F.coalesce((F.abs(v) < F.lit(math.inf)) & ~F.isnan(v), F.lit(False)))
    return F.when(vector.isNotNull() & good, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def segment_statistics(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows of sqrt(L) * (means, deviations) over ``parts`` segments: their inner products are the bounds."""
    pieces = np.array_split(x, min(parts, max(1, x.shape[1])), axis=1)
    out = [f(p) * math.sqrt(p.shape[1]) for f in (lambda p: p.mean(axis=1), lambda p: p.std(axis=1)) for p in pieces if p.shape[1]]
    return np.stack(out, axis=1) if out else np.zeros((len(x), 1))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def block_search(q_ids, q, x_ids, x, k: int, floor: np.ndarray) -> list[tuple[int, int, float]]:
    """(query, candidate, score) of what may be in a query's top k; ``floor`` is a score known to be in reach (or -inf)."""
    out = []
    norms = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    stats = [(segment_statistics(q, p), segment_statistics(x, p)) for p in LEVELS if p <= max(1, x.shape[1])]
    coarse = stats[0][0] @ stats[0][1].T
    for i in range(len(q)):
        slack = SLACK * norms[0][i] * norms[1]
        alive = np.flatnonzero(coarse[i] + slack >= floor[i])
        alive = alive[x_ids[alive] != q_ids[i]]
        for mine, theirs in stats[1:]:
            bound = theirs[alive] @ mine[i]
            alive = alive[bound + slack[alive] >= floor[i]]
        scores = x[alive] @ q[i]
        for j in _best(scores, x_ids[alive], k):
            out.append((i, int(alive[j]), float(scores[j])))
    return out


def top_k(vectors: DataFrame, id_column: str, vector_column: str, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products of quantised vectors with all other rows.

    Fewer where there are fewer; ties go to the smaller id. Vectors that quantise to null take no part, and vectors of
    different lengths don't meet. Rows with the same id are no candidates of each other; null ids take no part.
    """
    base = vectors.select(F.col(id_column).cast("long").alias("id"), quantised(F.col(vector_column)).alias("x"), is_query.alias("is_query"))
    base = written(base.filter("id IS NOT NULL AND x IS NOT NULL").withColumn("dim", F.size("x")), "vectors")
    sizes = base.groupBy("dim").agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("is_query"), 1)).alias("queries"))
    sizes = sizes.select(
        "dim", F.ceil(F.col("rows") / CANDIDATE_ROWS).cast("int").alias("x_blocks"), F.ceil(F.col("queries") / QUERY_ROWS).cast("int").alias("q_blocks")
    ).filter("q_blocks > 0")
    base = base.join(sizes, "dim").withColumn("h", F.xxhash64("id"))
    queries = base.filter("is_query").withColumn("q_block", F.pmod("h", "q_blocks").cast("int"))
    rows = base.withColumn("x_block", F.pmod(F.xxhash64("id", F.lit(1)), "x_blocks").cast("int"))

    seeds = written(base.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(SEED_ROWS).select("id", "x", "dim"), "seeds")
    sample = {int(d): (g["id"].to_numpy(), np.stack(g["x"].to_numpy()).astype(np.float64)) for d, g in seeds.toPandas().groupby("dim")}
    shared = vectors.sparkSession.sparkContext.broadcast(sample)

    def floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["floor"] = -np.inf
            for dim, part in pdf.groupby("dim"):
                if dim in shared.value:
                    ids, x = shared.value[dim]
                    scores = np.stack(part["x"].to_numpy()).astype(np.float64) @ x.T
                    scores[part["id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
                    if len(ids) > k:
                        pdf.loc[part.index, "floor"] = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
            yield pdf

    fields = "id long, x array<long>, dim int, q_block int, x_blocks int, floor double"
    queries = queries.select("id", "x", "dim", "q_block", "x_blocks").mapInPandas(floors, fields)
    queries = written(queries, "queries")
    left = queries.withColumn("x_block", F.explode(F.sequence(F.lit(0), F.col("x_blocks") - 1)))
    right = rows.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
    left = left.select("id", "x", "dim", "q_block", "x_block", "floor")
    right = right.select("id", "x", "dim", "q_block", "x_block", F.lit(0.0).alias("floor"))

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_id": "int64", "vec_id": "int64", "score": "int64"}
        if a.empty or b.empty:
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in columns.items()})
        q_ids, x_ids = a["id"].to_numpy(), b["id"].to_numpy()
        q, x = (np.stack(v["x"].to_numpy()).astype(np.float64) for v in (a, b))
        found = block_search(q_ids, q, x_ids, x, k, a["floor"].to_numpy())
        return pd.DataFrame(
            {"query_id": q_ids[[f[0] for f in found]], "vec_id": x_ids[[f[1] for f in found]], "score": [int(f[2]) for f in found]}
        ).astype(columns)

    keys = ["dim", "q_block", "x_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    # only the first k ranks are asked for, so every task keeps k rows a query before they are exchanged
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
