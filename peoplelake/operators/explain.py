"""Per-employee drivers: contributions of each feature to a score, and the largest ones that raise it."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.functions.scalar import day, number, risk_band
from peoplelake.operators.models import model_columns
from peoplelake.sources.sinks import run_dir


def _pairs(cells: Mapping[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("feature"), c.alias("impact")) for name, c in cells.items()])


def linear_contributions(df: DataFrame, weights: Mapping[str, str], centers: Mapping[str, str]) -> DataFrame:
    """Add ``contributions``: weight x (value - center) per feature, as exact decimals."""
    cells = {
        name: ((F.col(name).cast("decimal(12,2)") - number(centers[name])) * number(w)).cast("decimal(16,6)")
        for name, w in weights.items()
    }
    return df.withColumn("contributions", _pairs(cells))


def score_linear(df: DataFrame, intercept: str, as_of) -> DataFrame:
    """Turn linear contributions into score rows: intercept plus contributions, clipped to 0..1."""
    zero = F.lit(Decimal(0)).cast("decimal(20,6)")
    total = F.aggregate("contributions", zero, lambda acc, c: (acc + c["impact"]).cast("decimal(20,6)"))
    clipped = F.greatest(F.least(total + number(intercept), number("1")), number("0"))
    return df.withColumns(
        {
            "scored_at": day(as_of),
            "risk_score": F.round(clipped, 4).cast("decimal(5,4)"),
            "risk_band": risk_band(clipped),
        }
    )


def explain_linear(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Contributions of a standardised logistic model: coefficient x (value - mean) / deviation, in log odds."""
    scale, line = model.stages[1], model.stages[2]
    coef, mean, std = line.coefficients.toArray(), scale.mean.toArray(), scale.std.toArray()
    cells = {
        name: (F.col(name).cast("double") - F.lit(float(mean[i]))) * F.lit(float(coef[i] / std[i]) if std[i] else 0.0)
        for i, name in enumerate(model_columns(model))
    }
    return df.withColumn("contributions", _pairs(cells)).withColumn("base", F.lit(float(line.intercept)))


def top_drivers(df: DataFrame, n: int = 3, contributions: str = "contributions") -> DataFrame:
    """``driver_i`` and ``driver_i_impact``: the strictly positive contributions, largest first, NULL padded."""
    positive = F.filter(contributions, lambda c: c["impact"] > 0)
    keyed = F.transform(positive, lambda c: F.struct((-c["impact"]).alias("s"), c["feature"].alias("feature")))
    out = df.withColumn("_top", F.slice(F.array_sort(keyed), 1, n))
    for i in range(n):
        best = F.get("_top", F.lit(i))
        impact = F.round((-best["s"]).cast("decimal(20,8)"), 4).cast("decimal(8,4)")
        out = out.withColumns({f"driver_{i + 1}": best["feature"], f"driver_{i + 1}_impact": impact})
    return out.drop("_top")


def score_rows(df: DataFrame) -> DataFrame:
    """Columns of the score table."""
    drivers = [c for i in (1, 2, 3) for c in (f"driver_{i}", f"driver_{i}_impact")]
    return df.select("employee_id", "scored_at", "risk_score", "risk_band", *drivers)


# ---------------------------------------------------------------- trees


def _node_rows(model: PipelineModel, df: DataFrame) -> list:
    """Nodes of all trees; their number is set by the training parameters, not by the data."""
    path = run_dir(df.sparkSession, "trees")
    model.stages[-1].write().save(path)
    nodes = df.sparkSession.read.parquet(f"{path}/data")
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.rawCount").cast("double").alias("cover"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.split.numCategories").alias("categories"),
    ).collect()


@dataclass(frozen=True)
class LeafPath:
    """One leaf: a row keeps to it while ``low < value <= high`` for each feature; ``reach`` is the share of training
    rows that pass a condition, ``value`` what the leaf adds to the margin."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    reach: np.ndarray
    value: float


def leaf_paths(nodes: Sequence, tree_weights: Sequence[float]) -> tuple[list[LeafPath], float]:
    """Conditions of every leaf, several on one feature drawn together, and the mean margin; work in proportion to the nodes."""
    by_tree: dict[int, dict[int, object]] = {}
    for node in nodes:
        by_tree.setdefault(node["tree"], {})[node["id"]] = node
    leaves, base = [], 0.0
    for tree, members in by_tree.items():
        # The margin of the classifier is twice the weighted sum of the trees.
        scale = 2.0 * tree_weights[tree]
        stack = [(0, {})]
        while stack:
            node_id, path = stack.pop()
            node = members[node_id]
            if node["left"] < 0:
                low, high, reach = (np.array(v, dtype=np.float64) for v in zip(*path.values())) if path else (np.zeros(0),) * 3
                base += scale * node["value"] * math.prod(reach)
                if path:
                    leaves.append(LeafPath(np.array(list(path)), low, high, reach, scale * node["value"]))
                continue
            if node["categories"] >= 0:
                raise ValueError("trees with categorical splits can't be explained; use one column per value")
            low, high, share = path.get(node["feature"], (-math.inf, math.inf, 1.0))
            for child, left in ((node["left"], True), (node["right"], False)):
                part = share * members[child]["cover"] / node["cover"] if node["cover"] else 0.0
                edge = (low, min(high, node["threshold"])) if left else (max(low, node["threshold"]), high)
                stack.append((child, {**path, node["feature"]: (*edge, part)}))
    return leaves, base


def path_shares(leaf: LeafPath, met: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf for rows of fulfilled conditions (0 or 1).

    The weights of a feature's coalitions are the integral over u of the product of ``reach * (1 - u) + met * u`` of all
    other conditions. It is a polynomial of degree d - 1, for which d / 2 Gauss points are exact.
    """
    d = len(leaf.reach)
    points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    u = (points + 1) / 2
    factors = leaf.reach[None, :, None] * (1 - u) + met[:, :, None] * u
    before = np.cumprod(np.concatenate([np.ones_like(factors[:, :1]), factors[:, :-1]], axis=1), axis=1)
    after = np.cumprod(np.concatenate([np.ones_like(factors[:, :1]), factors[:, :0:-1]], axis=1), axis=1)[:, ::-1]
    return leaf.value * (met - leaf.reach) * ((before * after) @ (weights / 2))


#: Leaves of up to this many conditions have the shares of all patterns worked out beforehand.
TABLE_CONDITIONS = 6


def share_tables(leaves: Sequence[LeafPath]) -> list[np.ndarray | None]:
    """Shares of each feature (rows) for every pattern of fulfilled conditions (columns); None for longer paths."""

    def table(leaf: LeafPath) -> np.ndarray | None:
        d = len(leaf.features)
        if d > TABLE_CONDITIONS:
            return None
        patterns = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
        return np.ascontiguousarray(path_shares(leaf, patterns.astype(np.float64)).T)

    return [table(leaf) for leaf in leaves]


def _contributions(x: np.ndarray, leaves: Sequence[LeafPath], tables: Sequence[np.ndarray | None]) -> np.ndarray:
    """Sum over the leaves for a block of rows; of long paths only patterns that occur in the block are worked out."""
    columns, out = np.ascontiguousarray(x.T), np.zeros(x.shape[::-1])
    for leaf, table in zip(leaves, tables, strict=True):
        code = np.zeros(len(x), dtype=np.int64)
        for i, (feature, low, high) in enumerate(zip(leaf.features, leaf.low, leaf.high, strict=True)):
            cells = columns[feature]
            code |= ((cells > low) & (cells <= high)).astype(np.int64) << i
        if table is None:
            found, code = np.unique(code, return_inverse=True)
            patterns = (found[:, None] >> np.arange(len(leaf.features))) & 1
            table = path_shares(leaf, patterns.astype(np.float64)).T
        for feature, shares in zip(leaf.features, table, strict=True):
            out[feature] += shares[code]
    return np.ascontiguousarray(out.T)


def explain_trees(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Exact Shapley values of the boosted trees per row, path-dependent, in margin (log odds) units.

    ``base`` plus all contributions equals the margin. The paths to the leaves depend on the model only and travel as one
    broadcast of a few hundred numbers per leaf; rows stay where they are and are worked on in Arrow batches.
    """
    columns = model_columns(model)
    trees = model.stages[-1]
    leaves, base = leaf_paths(_node_rows(model, df), list(trees.treeWeights))
    shared = df.sparkSession.sparkContext.broadcast((leaves, share_tables(leaves)))
    keep = [f for f in df.schema.fields if f.name != "contributions"]
    schema = T.StructType([*keep, T.StructField("_impacts", T.ArrayType(T.DoubleType()))])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths, tables = shared.value
        for batch in batches:
            x = batch[columns].to_numpy(dtype=np.float64)
            yield batch.assign(_impacts=list(_contributions(x, paths, tables)))

    out = df.select(*[f.name for f in keep]).mapInPandas(explain, schema)
    cells = {name: F.get("_impacts", F.lit(i)) for i, name in enumerate(columns)}
    return out.withColumn("contributions", _pairs(cells)).withColumn("base", F.lit(base)).drop("_impacts")


def tree_margin(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``margin``, the log odds the tree model predicts."""
    raw = model.transform(df).select(*df.columns, (vector_to_array("rawPrediction")[1] * 2).alias("margin"))
    return raw
