"""Boosted trees for two classes on binned columns, by the rules of Spark ML's classifier.

Logistic loss, the first tree on the labels, every other one on the residuals and shrunk; splits by the largest gain in
variance, leaves with the mean residual. A row is binned once and stays where it is for all rounds. Up to ``TASK_ROWS`` rows
are fitted in one task, so that a round waits for nobody; more stay spread, with one job per level of a tree.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplelake.sources.sinks import run_dir

#: Rows one task fits: below a gigabyte, as a row takes about 100 bytes with 21 columns. A spread fit starts from its trees again
#: after so many rounds, so that it has a short lineage without writing a file.
TASK_ROWS, FRESH_ROUNDS = 5_000_000, 25
# Rows of a block, whose arrays stay in a core's cache; cells of bins counted together; quantiles that edges come from.
BLOCK_ROWS, GROUP_CELLS, QUANTILES = 131_072, 2048, 2048
NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
    "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)
CHUNKS = "part int, number int, bins binary, positive binary, weight binary"


@dataclass(frozen=True)
class Plan:
    """What a fit needs to know besides its rows: the upper edges of every column's bins, and the settings."""

    edges: Sequence[np.ndarray]
    rounds: int
    depth: int
    step: float
    sample: float
    features: int
    seed: int
    min_rows: int
    min_share: float
    min_gain: float
    #: Weights of label 0 and 1 where each class has one, which counting the classes then gives.
    weights: tuple[float, float] | None = None

    @cached_property
    def sizes(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]

    @cached_property
    def dtype(self) -> type:
        return np.uint8 if max(self.sizes) <= 256 else np.uint16 if max(self.sizes) <= 65536 else np.uint32

    @cached_property
    def groups(self) -> list[tuple[int, int, list[int]]]:
        """Columns counted together, as (first cell, cells, columns): their bins together make up to ``GROUP_CELLS`` cells."""
        groups: list[tuple[int, list[int]]] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            at = next((i for i, (cells, _) in enumerate(groups) if cells * self.sizes[f] <= GROUP_CELLS), None)
            if at is None:
                groups.append((self.sizes[f], [f]))
            else:
                groups[at] = (groups[at][0] * self.sizes[f], [f, *groups[at][1]])
        starts = np.cumsum([0, *[cells for cells, _ in groups]]).tolist()
        return [(start, cells, members) for start, (cells, members) in zip(starts, groups)]

    @property
    def cells(self) -> int:
        return sum(cells for _, cells, _ in self.groups)

    def tables(self, cells: np.ndarray) -> np.ndarray:
        """Rows, weights and weighted residuals per (node, column, bin), from what blocks count per (node, cell)."""
        if self.weights is not None:
            none, some = cells[:, 0], cells[:, 1]
            cells = np.stack([none + some, none * self.weights[0] + some * self.weights[1], cells[:, 2]], axis=1)
        out = np.zeros((len(cells), 3, len(self.sizes), max(self.sizes)))
        for start, n, members in self.groups:
            part = cells[:, :, start : start + n]
            for f in members:  # the first column is the slowest in the cells
                part = part.reshape(len(cells), 3, self.sizes[f], -1)
                out[:, :, f, : self.sizes[f]] = part.sum(axis=3)
                part = part.sum(axis=2)
        return out


class Block:
    """Rows that are worked on together; ``rows`` has those at each node that may still be split, inside and outside the sample."""

    def __init__(self, plan: Plan, key: Sequence[int], bins: np.ndarray, positive: np.ndarray, weight: np.ndarray):
        self.plan, self.key, self.bins, self.weight = plan, list(key), bins, weight
        self.sign = np.where(positive == 1, 1.0, -1.0)
        self.margin = np.zeros(len(weight))
        most = max(cells for _, cells, _ in plan.groups)
        # one line per row, so that a row is fetched as a whole; the class, if it is counted, is the slowest
        self.codes = np.zeros((len(weight), len(plan.groups)), dtype=np.uint16 if 2 * most <= 65536 else np.int64)
        for i, (_, _, members) in enumerate(plan.groups):
            code = positive.astype(np.int64) if plan.weights is not None else np.zeros(len(weight), dtype=np.int64)
            for f in members:
                code = code * plan.sizes[f] + bins[f]
            self.codes[:, i] = code

    def begin(self, number: int) -> None:
        with np.errstate(over="ignore"):
            self.residual = self.sign.copy() if number == 0 else 4.0 * self.sign / (1.0 + np.exp(2.0 * self.sign * self.margin))
        self.weighted = self.weight * self.residual
        if self.plan.sample >= 1.0:
            drawn = np.ones(len(self.weight), dtype=bool)
        else:
            drawn = np.random.default_rng([self.plan.seed, number, *self.key]).random(len(self.weight), dtype=np.float32) < self.plan.sample
        self.rows = {1: (np.flatnonzero(drawn), np.flatnonzero(~drawn))}

    def add_cells(self, node: int, out: np.ndarray) -> None:
        """Add a node's rows of the sample to its cells: by class or as rows and weights, and the weighted residuals."""
        inside = self.rows[node][0]
        codes, weighted = self.codes.take(inside, axis=0).T.astype(np.intp), self.weighted.take(inside)
        weight = None if self.plan.weights is not None else self.weight.take(inside)
        for code, (start, n, _) in zip(codes, self.plan.groups):
            if weight is None:
                out[:2, start : start + n] += np.bincount(code, minlength=2 * n).reshape(2, n)
                out[2, start : start + n] += np.bincount(code, weights=weighted, minlength=2 * n).reshape(2, n).sum(axis=0)
            else:
                out[0, start : start + n] += np.bincount(code, minlength=n)
                out[1, start : start + n] += np.bincount(code, weights=weight, minlength=n)
                out[2, start : start + n] += np.bincount(code, weights=weighted, minlength=n)

    def split(self, node: int, feature: int, upto: int) -> None:
        cells, sides = self.bins[feature], ([], [])
        for rows in self.rows.pop(node):
            right = cells.take(rows) > upto
            sides[0].append(rows.compress(~right))
            sides[1].append(rows.compress(right))
        self.rows[2 * node], self.rows[2 * node + 1] = map(tuple, sides)

    def finish(self, values: Mapping[int, float]) -> np.ndarray:
        """Move the leaves' rows by their values; sums of squared residuals, for the statistics that a model keeps."""
        leaf, squares = np.zeros(len(self.weight), dtype=np.intp), np.zeros(len(values))
        for i, node in enumerate(values):
            inside, outside = self.rows.pop(node)
            leaf[inside] = leaf[outside] = i
            self.residual[outside] = 0.0
        squares += np.bincount(leaf, weights=self.weighted * self.residual, minlength=len(values))
        self.margin += np.array(list(values.values())).take(leaf)
        return squares

    def rest(self) -> Block:
        """Between two rounds only the margin is kept."""
        for name in ("residual", "weighted", "rows"):
            self.__dict__.pop(name, None)
        return self


class Blocks:
    """The rows of one task."""

    def __init__(self, plan: Plan, blocks: Sequence[Block]):
        self.plan, self.blocks = plan, blocks

    def begin(self, number: int) -> None:
        for block in self.blocks:
            block.begin(number)

    def tables(self, nodes: Sequence[int]) -> np.ndarray:
        cells = np.zeros((len(nodes), 3, self.plan.cells))
        for block in self.blocks:
            for node, out in zip(nodes, cells):
                block.add_cells(node, out)
        return self.plan.tables(cells)

    def split(self, found: Mapping[int, tuple[int, int]]) -> None:
        for block in self.blocks:
            for node, (feature, upto) in found.items():
                block.split(node, feature, upto)

    def finish(self, values: Mapping[int, float]) -> dict[int, float]:
        return dict(zip(values, sum((b.finish(values) for b in self.blocks), np.zeros(len(values))).tolist()))

    def replay(self, number: int, levels: Iterable[Mapping[int, tuple[int, int]]]) -> Blocks:
        self.begin(number)
        for found in levels:
            self.split(found)
        return self

    def advance(self, trees: Sequence[tuple[int, list, Mapping[int, float]]]) -> dict[int, float]:
        """Move all rows by trees; the squares of the last one's leaves."""
        squares: dict[int, float] = {}
        for number, levels, values in trees:
            squares = self.replay(number, levels).finish(values)
        for block in self.blocks:
            block.rest()
        return squares


class Spread:
    """Rows that stay in their partitions: each call is a job that sums what the tasks find, in the order of the partitions."""

    def __init__(self, plan: Plan, chunks: DataFrame):
        level = StorageLevel.MEMORY_AND_DISK
        start = chunks.rdd.mapPartitionsWithIndex(lambda i, rows: [(Blocks(plan, blocks_of(plan, rows, i)), {})])
        self.start = self.now = start.persist(level)
        self.level, self.trees = level, []

    def begin(self, number: int) -> None:
        self.number, self.levels = number, []

    def tables(self, nodes: Sequence[int]) -> np.ndarray:
        number, levels, nodes = self.number, list(self.levels), list(nodes)
        return sum(self.now.map(lambda part: part[0].replay(number, levels).tables(nodes)).collect())

    def split(self, found: Mapping[int, tuple[int, int]]) -> None:
        self.levels.append(dict(found))

    def finish(self, values: Mapping[int, float]) -> dict[int, float]:
        self.trees.append((self.number, list(self.levels), dict(values)))
        fresh = len(self.trees) % FRESH_ROUNDS == 0
        trees = list(self.trees) if fresh else self.trees[-1:]

        def moved(part):
            return part[0], part[0].advance(trees)

        before, self.now = self.now, (self.start if fresh else self.now).map(moved).persist(self.level)
        parts = self.now.map(lambda part: part[1]).collect()
        if before is not self.start:
            before.unpersist()
        return {node: math.fsum(p[node] for p in parts) for node in values}

    def close(self) -> None:
        self.now.unpersist()
        self.start.unpersist()


@dataclass
class Node:
    """Rows, weights and weighted residuals of a node, and its split unless it is a leaf."""

    sums: np.ndarray
    feature: int = -1
    upto: int = -1
    gain: float = -1.0
    squares: float = 0.0

    @property
    def mean(self) -> float:
        return float(self.sums[2] / self.sums[1]) if self.sums[1] > 0 else 0.0


def _best(plan: Plan, tables: np.ndarray, allowed: np.ndarray, least: float) -> list[tuple[int, int, float, np.ndarray, np.ndarray] | None]:
    """The best split of each node as (column, last bin of the left side, gain, left sums, right sums); the first of equal ones."""
    left = np.cumsum(tables, axis=3)
    total, left = left[..., -1:], left[..., :-1]
    right = total - left
    good = (left[:, 0] >= plan.min_rows) & (right[:, 0] >= plan.min_rows) & allowed[:, :, None]
    good &= (left[:, 1] > 0) & (right[:, 1] > 0) & (left[:, 1] >= least) & (right[:, 1] >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(good, left[:, 2] ** 2 / left[:, 1] + right[:, 2] ** 2 / right[:, 1], -np.inf)
    flat = score.reshape(len(tables), score.shape[1] * score.shape[2])
    out = []
    for i, at in enumerate(flat.argmax(axis=1) if flat.shape[1] else ()):
        f, upto = divmod(int(at), score.shape[2])
        here = total[i, :, f, 0]
        more = flat[i, at] - (here[2] ** 2 / here[1] if here[1] > 0 else 0.0)
        # what rounding leaves is no gain
        if not (flat[i, at] > -np.inf and more > 1e-9 * flat[i, at] and more / here[1] >= plan.min_gain):
            out.append(None)
        else:
            out.append((f, upto, float(more / here[1]), left[i, :, f, upto], right[i, :, f, upto]))
    return out or [None] * len(tables)


def grow(work: Blocks | Spread, plan: Plan, number: int) -> dict[int, Node]:
    """One tree, level by level, as nodes by number: the children of ``n`` are ``2n`` and ``2n + 1``.

    Only the smaller child of a split is counted; the other one is what is left of its parent.
    """
    rng = np.random.default_rng([plan.seed, number])
    work.begin(number)
    tables = dict(zip([1], work.tables([1])))
    nodes = {1: Node(tables[1][:, 0].sum(axis=1))}
    least = plan.min_share * nodes[1].sums[1]
    for depth in range(plan.depth):
        if not tables:
            break
        draws = rng.random((len(tables), len(plan.sizes))).argsort(axis=1).argsort(axis=1) < plan.features
        best = {n: b for n, b in zip(tables, _best(plan, np.stack(list(tables.values())), draws, least)) if b is not None}
        if not best:
            break
        work.split({n: b[:2] for n, b in best.items()})
        for n, (feature, upto, gain, left, right) in best.items():
            nodes[n].feature, nodes[n].upto, nodes[n].gain = feature, upto, gain
            nodes[2 * n], nodes[2 * n + 1] = Node(left), Node(right)
        parents, tables = tables, {}
        if depth + 1 < plan.depth:
            small = [2 * n + int(nodes[2 * n + 1].sums[0] < nodes[2 * n].sums[0]) for n in best]
            for child, table in zip(small, work.tables(small)):
                rest = parents[child // 2] - table
                rest[1:, rest[0] == 0] = 0.0
                tables |= {child: table, child ^ 1: rest}
            tables = dict(sorted(tables.items()))
    rate = 1.0 if number == 0 else plan.step
    for n, squares in work.finish({n: rate * node.mean for n, node in nodes.items() if node.feature < 0}).items():
        while n:
            nodes[n].squares += squares
            n //= 2
    return nodes


def node_rows(plan: Plan, tree: int, nodes: Mapping[int, Node]) -> list[tuple[int, dict]]:
    """Nodes as a stored model has them, numbered from the root down the left side first."""
    order, stack = {}, [1]
    while stack:
        n = stack.pop()
        order[n] = len(order)
        if nodes[n].feature >= 0:
            stack += [2 * n + 1, 2 * n]

    def row(n: int, node: Node) -> dict:
        inner, (count, weight, total) = node.feature >= 0, (float(v) for v in node.sums)
        split = {
            "featureIndex": node.feature, "numCategories": -1,
            "leftCategoriesOrThreshold": [float(plan.edges[node.feature][node.upto])] if inner else [],
        }
        return {
            "id": order[n], "prediction": node.mean, "impurity": (node.squares - total * node.mean) / weight if weight > 0 else 0.0,
            "impurityStats": [weight, total, node.squares], "rawCount": round(count), "gain": node.gain,
            "leftChild": order[2 * n] if inner else -1, "rightChild": order[2 * n + 1] if inner else -1, "split": split,
        }

    return [(tree, row(n, nodes[n])) for n in order]


def blocks_of(plan: Plan, chunks: Iterable, part: int) -> list[Block]:
    """Blocks of about ``BLOCK_ROWS`` rows from chunks of any size, in the order of the chunks."""
    blocks, held = [], []

    def close() -> None:
        bins, positive, weight = (np.concatenate(arrays, axis=-1) for arrays in zip(*held))
        blocks.append(Block(plan, (part, len(blocks)), bins, positive, weight))
        held.clear()

    for chunk in sorted(chunks, key=lambda c: (c["part"], c["number"])):
        positive = np.frombuffer(chunk["positive"], dtype=np.uint8)
        bins = np.frombuffer(chunk["bins"], dtype=plan.dtype).reshape(len(plan.sizes), len(positive))
        held.append((bins, positive, np.frombuffer(chunk["weight"], dtype=np.float64)))
        if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
            close()
    if held:
        close()
    return blocks


def _chunks(df: DataFrame, plan: Plan) -> DataFrame:
    """Rows of (columns, label, weight) as binned chunks, which are as long as the Arrow batches make them up to ``BLOCK_ROWS``."""
    edges, dtype, n = plan.edges, plan.dtype, len(plan.sizes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def chunk() -> pa.RecordBatch:
            bins, positive, weight = (np.concatenate(arrays, axis=-1) for arrays in zip(*held))
            cells = [[part], [number], [bins.tobytes()], [positive.tobytes()], [weight.tobytes()]]
            types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=["part", "number", "bins", "positive", "weight"])

        for batch in batches:
            if not batch.num_rows:
                continue
            values = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            bins = np.stack([np.searchsorted(e, v, side="left").astype(dtype) for e, v in zip(edges, values[:n])])
            held.append((bins, values[n].astype(np.uint8), values[n + 1].astype(np.float64)))
            if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                yield chunk()
                number, held = number + 1, []
        if held:
            yield chunk()

    return df.mapInArrow(pack, CHUNKS)


def edges_of(points: Sequence[float], bins: int) -> np.ndarray:
    """Upper edges of at most ``bins`` bins: midway between values, between all of them or where equal shares of them end."""
    values, counts = np.unique(np.asarray(points, dtype=np.float64), return_counts=True)
    with np.errstate(invalid="ignore"):
        edges = values[:-1] / 2 + values[1:] / 2
    if len(edges) > bins - 1:
        upto, ends = np.cumsum(counts)[:-1], np.arange(1, bins) * (counts.sum() / bins)
        edges = edges[np.unique(np.abs(upto[None, :] - ends[:, None]).argmin(axis=1))]
    return edges[~np.isnan(edges)]


def _per_node(strategy: str, columns: int) -> int:
    """Columns tried at a node, by Spark's names for a single tree."""
    named = {"all": columns, "auto": columns, "onethird": math.ceil(columns / 3), "sqrt": math.ceil(math.sqrt(columns))}
    named["log2"] = max(1, math.ceil(math.log2(columns)))
    if strategy.lower() in named:
        return named[strategy.lower()]
    return min(columns, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * columns)


def _stored(spark, trees: GBTClassifier, columns: int, rounds: int, nodes: DataFrame, path: str) -> GBTClassificationModel:
    """Spark's own model from its nodes, by way of its file format."""

    def described(kind: str, uid: str, **more) -> str:
        tree = kind.endswith("RegressionModel")
        left_out = ("featureSubsetStrategy", "lossType", "maxIter", "probabilityCol", "rawPredictionCol", "stepSize", "subsamplingRate", "validationTol", "thresholds")
        # a tree has its defaults anyway, and reading them takes time for every tree
        given, defaults = ({p.name: v for p, v in m.items()} for m in (trees._paramMap, trees._defaultParamMap))
        maps = ({k: v for k, v in given.items() if k not in left_out}, {}) if tree else (given, defaults)
        head = {"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        return json.dumps({**head, **dict(zip(("paramMap", "defaultParamMap"), maps)), **more})

    own = described("classification.GBTClassificationModel", trees.uid, numFeatures=columns, numTrees=rounds)
    members = [
        (i, described("regression.DecisionTreeRegressionModel", f"dtr_{trees.uid}_{i}"), 1.0 if i == 0 else trees.getStepSize()) for i in range(rounds)
    ]
    nodes.write.parquet(f"{path}/data")
    spark.createDataFrame([(own,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(members, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return GBTClassificationModel.load(path)


def fit(df: DataFrame, columns: Sequence[str], trees: GBTClassifier, partitions) -> GBTClassificationModel:
    """The model of ``trees`` for the rows of ``df``; ``partitions`` gives a spread fit's tasks for a number of rows."""
    spark, label = df.sparkSession, F.col(trees.getLabelCol()).cast("double")
    weight = F.col(trees.getWeightCol()).cast("double") if trees.isDefined("weightCol") and trees.getWeightCol() else F.lit(1.0)
    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)], label.alias("_label"), weight.alias("_weight"))
    cells = [f"_{i}" for i in range(len(columns))]

    def faults(bad) -> F.Column:
        return F.count_if(F.coalesce(bad, F.lit(True)))

    # one text instead of an expression per number
    shares = F.split(F.lit(",".join(str(i / QUANTILES) for i in range(QUANTILES + 1))), ",").cast("array<double>")
    seen = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *[faults(F.isnan(c) | F.col(c).isNull()).alias(f"bad{c}") for c in cells],
        faults(~F.col("_label").isin(0.0, 1.0)).alias("bad_label"),
        faults(F.isnan("_weight") | (F.col("_weight") < 0) | (F.col("_weight") == math.inf)).alias("bad_weight"),
        *[how(F.when(F.col("_label") == i, F.col("_weight"))).alias(f"{name}{i}") for i in (0, 1) for name, how in (("low", F.min), ("high", F.max))],
        *[F.percentile_approx(c, shares, F.lit(10_000)).alias(c) for c in cells],
    ).first()
    faulty = [name for name, c in [*zip(columns, cells), ("the label", "_label"), ("the weight", "_weight")] if seen[f"bad{c}"]]
    if faulty or not seen["rows"]:
        raise ValueError(f"can't fit trees: {'values missing or out of range in ' + ', '.join(faulty) if faulty else 'no rows'}")
    even = all(seen[f"low{i}"] == seen[f"high{i}"] for i in (0, 1))
    plan = Plan(
        [edges_of(seen[c], trees.getMaxBins()) for c in cells], trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize(),
        trees.getSubsamplingRate(), _per_node(trees.getFeatureSubsetStrategy(), len(columns)), trees.getSeed() % (1 << 63),
        trees.getMinInstancesPerNode(), trees.getMinWeightFractionPerNode(), trees.getMinInfoGain(),
        (seen["low0"] or 0.0, seen["low1"] or 0.0) if even else None,
    )
    path = run_dir(spark, "trees-fit")
    if seen["rows"] <= TASK_ROWS:
        return _stored(spark, trees, len(columns), plan.rounds, _in_one_task(_chunks(rows, plan), plan), path)
    work = Spread(plan, _chunks(rows.coalesce(partitions(seen["rows"])), plan))
    try:
        found = [row for i in range(plan.rounds) for row in node_rows(plan, i, grow(work, plan, i))]
    finally:
        work.close()
    return _stored(spark, trees, len(columns), plan.rounds, spark.createDataFrame(found, NODES).coalesce(1), path)


def _in_one_task(chunks: DataFrame, plan: Plan) -> DataFrame:
    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [row for batch in batches for row in batch.to_pylist()]
        work = Blocks(plan, blocks_of(plan, given, 0))
        del given
        for i in range(plan.rounds if work.blocks else 0):
            found = node_rows(plan, i, grow(work, plan, i))
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.int32()), pa.array([n for _, n in found], _NODE)], names=["treeID", "nodeData"])

    return chunks.repartition(1).mapInArrow(fitted, NODES)


_NODE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
])
