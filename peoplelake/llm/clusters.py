"""Centroid clustering with heap-ordered bounds.

Every vector has an upper bound of the distance to its own centroid and a lower bound of the distance to any other. All
bounds of a cluster loosen by the same amount when centroids move, so the cluster keeps one heap of (lower - upper)
gaps, each offset by the drift that the cluster had gathered when the gap was measured. A round pops the heap only while
the top gap has expired, rescans exactly those vectors, and pushes each into the heap of its cluster; all others keep
their cluster without being looked at.

Vectors lie in blocks of a bucketed table that never moves again; a block's heaps are a small row that travels to it.
A round returns the exact change of every cluster's sum and count, a few numbers per block.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplelake.llm.common import shared_dir, written

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Vectors of a block: what a task holds at once.
BLOCK_ROWS = 1024
#: Blocks in a bucket, and the most buckets that Spark takes by default.
BUCKET_BLOCKS, MOST_BUCKETS = 64, 100_000
#: Components are cut here; squared distances of vectors beyond it don't fit into a long anyway.
LARGEST = 1 << 52
LONG = (1 << 63) - 1
#: Gaps are taken smaller by this share of the distances for what rounding may have added.
SLACK = 1e-9


@dataclass(frozen=True)
class Clusters:
    """``assigned`` has the id (named as given), cluster and squared distance of every vector; ``centroids`` by cluster."""

    assigned: DataFrame
    centroids: list[list[int]]
    rescanned: list[int]


def held(x: np.ndarray) -> np.ndarray:
    """``x``, or Python's integers of it where 64 bits don't hold squared distances of such components, or their sums."""
    most = math.isqrt(LONG // max(1, x.shape[1])) // 2
    return x.astype(object) if x.size and int(np.abs(x).max()) > most else x


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every centroid."""
    x, centroids = held(x), held(centroids)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def own_and_gap(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row (ties: the smaller number) and the gap between it and the next one."""
    squared = squared_distances(x, centroids)
    own = squared.argmin(axis=1) if squared.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in squared], np.int64)
    distance = np.sqrt(squared.astype(np.float64))
    upper = distance[np.arange(len(x)), own]
    if len(centroids) == 1:
        return own, np.full(len(x), np.inf)
    distance[np.arange(len(x)), own] = np.inf
    lower = distance.min(axis=1)
    return own, lower - upper - SLACK * (lower + upper + 1.0)


class Heaps:
    """A heap of (offset gap, place in the block) for every cluster."""

    def __init__(self, cluster: np.ndarray, key: np.ndarray, k: int):
        self.cluster, self.key = cluster.copy(), key.copy()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]
        for place in np.flatnonzero(cluster >= 0).tolist():
            self.heaps[cluster[place]].append((key[place], place))
        for heap in self.heaps:
            heapq.heapify(heap)

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Places popped because their gap is used up by the drift of their cluster; new vectors have always expired."""
        out = np.flatnonzero(self.cluster < 0).tolist()
        for heap, moved in zip(self.heaps, drift.tolist(), strict=True):
            while heap and heap[0][0] <= moved:
                out.append(heapq.heappop(heap)[1])
        return np.array(sorted(out), np.int64)

    def push(self, places: np.ndarray, own: np.ndarray, key: np.ndarray) -> None:
        self.cluster[places], self.key[places] = own, key
        for place, cluster, value in zip(places.tolist(), own.tolist(), key.tolist(), strict=True):
            heapq.heappush(self.heaps[cluster], (value, place))


def drifts(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How much every cluster's gaps shrink: the way of its own centroid and the longest way of any other."""
    way = np.array([math.sqrt(float(((a - b) ** 2).sum())) for a, b in zip(before.astype(object), after.astype(object), strict=True)])
    way *= 1 + SLACK
    if len(way) == 1:
        return np.zeros(1)
    order = np.argsort(-way, kind="stable")
    longest_other = np.full(len(way), way[order[0]])
    longest_other[order[0]] = way[order[1]]
    return way + longest_other


def _quantised(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int, scale: int) -> DataFrame:
    """id and x of the vectors that take part."""
    x = F.transform(F.col("v"), lambda v: v.cast("double"))
    good = F.forall(x, lambda v: F.coalesce((F.abs(v) < F.lit(math.inf)) & ~F.isnan(v), F.lit(False)))
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") == dimensions) & good)
    most = F.lit(float(LARGEST))
    return rows.select("id", F.transform(x, lambda v: F.floor(F.greatest(-most, F.least(most, v * scale))).cast("long")).alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors with the k smallest SHA-256 of ``seed:id``; null ids come last, equal ids by their components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select(order.isNull().alias("missing"), order.alias("order"), "x").orderBy("missing", "order", "x").limit(k)
    return [list(r.x) for r in first.collect()]


def _blocks(rows: DataFrame, dimensions: int) -> tuple[DataFrame, str]:
    """(block, ids, x) of at most BLOCK_ROWS vectors, bucketed by block, and the name of the table."""
    spark = rows.sparkSession
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "id", "x")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                n = part.num_rows
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(1))
                x = pa.ListArray.from_arrays(pa.array([0, n * dimensions], pa.int32()), part.column(2).flatten())
                yield pa.RecordBatch.from_arrays([part.column(0).slice(0, 1), ids, x], names=["block", "ids", "x"])

    packed = rows.mapInArrow(pack, "block long, ids array<long>, x array<long>")
    total = rows.count()
    blocks = -(-total // BLOCK_ROWS)
    buckets = max(1, min(MOST_BUCKETS, max(-(-blocks // BUCKET_BLOCKS), min(blocks, spark.sparkContext.defaultParallelism))))
    name = f"vector_blocks_{uuid.uuid4().hex}"
    dealt = packed.repartition(buckets, "block")
    dealt.write.bucketBy(buckets, "block").option("path", shared_dir(spark, name)).saveAsTable(name)
    return spark.table(name), name


def heap_clusters(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
) -> Clusters:
    """Exact Lloyd rounds over floor(scale * x), then one more assignment.

    Vectors that are null, have another length or hold null or non-finite components take no part. Ids are integers;
    repeated rows and null ids take part as vectors of their own. With fewer than ``k`` vectors there are as many clusters
    as vectors; without any the result is empty. Ties go to the smaller cluster number and empty clusters keep their
    centroid. Squared distances beyond a long are given as the largest long. ``k`` and ``dimensions`` bound what the
    driver holds: sums and counts of every cluster.
    """
    spark = vectors.sparkSession
    rows = written(_quantised(vectors, id_column, vector_column, dimensions, scale).withColumn("id", F.col("id").cast("long")), "vectors")
    centroids = first_centroids(rows, k, seed)
    fields = f"`{id_column}` long, cluster int, distance long"
    if not centroids:
        return Clusters(spark.createDataFrame([], fields), [], [])
    blocks, name = _blocks(rows, dimensions)
    try:
        return _clustered(blocks, centroids, rounds, fields)
    finally:
        spark.sql(f"DROP TABLE `{name}`")


def _clustered(blocks: DataFrame, centroids: list[list[int]], rounds: int, fields: str) -> Clusters:
    """The rounds over the blocks; ``fields`` are those of the assignment, the id first."""
    dimensions = len(centroids[0])
    k, width = len(centroids), dimensions + 1
    state = None
    drift = np.zeros(k)
    sums = [[0] * width for _ in range(k)]
    rescanned = []

    def advance(x: np.ndarray, cluster: np.ndarray, key: np.ndarray, now: np.ndarray, moved: np.ndarray) -> tuple[Heaps, np.ndarray, int]:
        """Heaps after the round, the change of sums and counts, and the number of vectors that were rescanned."""
        heaps = Heaps(cluster, key, len(now))
        places = heaps.expired(moved)
        change = np.zeros((len(now), width), object)
        if len(places):
            own, gap = own_and_gap(x[places], now)
            counted, was = np.concatenate([held(x[places]), np.ones((len(places), 1), np.int64)], axis=1), cluster[places]
            for c in range(len(now)):
                change[c] += counted[own == c].sum(axis=0) - counted[was == c].sum(axis=0)
            heaps.push(places, own, gap + moved[own])
        return heaps, change, len(places)

    def paired(state: DataFrame | None) -> DataFrame:
        """Every block with its heaps; the vectors stay where they are."""
        if state is None:
            return blocks.select("block", "ids", "x", F.lit(None).cast("array<int>").alias("cluster"), F.lit(None).cast("array<double>").alias("key"))
        rows = blocks.join(state.select("block", "cluster", "key").hint("shuffle_hash"), "block")
        return rows.select("block", "ids", "x", "cluster", "key")

    def of_each(batch: pa.RecordBatch) -> Iterator[tuple]:
        """block, ids, x, cluster and key of every row."""
        for block, ids, x, cluster, key in zip(*batch.columns, strict=True):
            x = x.values.to_numpy().reshape(-1, dimensions)
            if not cluster.is_valid:
                yield block.as_py(), ids.values, x, np.full(len(x), -1, np.int64), np.zeros(len(x))
            else:
                yield block.as_py(), ids.values, x, cluster.values.to_numpy().astype(np.int64), key.values.to_numpy()

    for _ in range(rounds):
        now, moved = np.array(centroids, np.int64), drift.copy()

        def one_round(batches: Iterator[pa.RecordBatch], now=now, moved=moved) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, _, x, cluster, key in of_each(batch):
                    heaps, change, n = advance(x, cluster, key, now, moved)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block]), pa.array([heaps.cluster], pa.list_(pa.int32())), pa.array([heaps.key], pa.list_(pa.float64())),
                            pa.array([[str(v) for v in change.ravel()]]), pa.array([n]),
                        ],
                        names=["block", "cluster", "key", "change", "n"],
                    )

        fields_of_state = "block long, cluster array<int>, key array<double>, change array<string>, n long"
        state = written(paired(state).mapInArrow(one_round, fields_of_state), "heaps")
        totals = state.select(F.posexplode("change").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
        for at, v in totals.collect():
            sums[at // width][at % width] += int(v)
        rescanned.append(int(state.agg(F.sum("n")).first()[0]))
        after = [[s // own[-1] for s in own[:-1]] if own[-1] else c for own, c in zip(sums, centroids, strict=True)]
        drift = drift + drifts(np.array(centroids, np.int64), np.array(after, np.int64))
        centroids = after

    last, moved = np.array(centroids, np.int64), drift.copy()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, x, cluster, key in of_each(batch):
                own = advance(x, cluster, key, last, moved)[0].cluster
                distance = np.zeros(len(x), object)
                for c in np.unique(own):
                    distance[own == c] = squared_distances(x[own == c], last[c : c + 1])[:, 0]
                distance = pa.array([min(int(d), LONG) for d in distance])
                yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.int32()), distance], names=["id", "cluster", "distance"])

    assigned = written(paired(state).mapInArrow(assign, fields), "clusters")
    return Clusters(assigned, centroids, rescanned)


def with_inertia(found: Clusters) -> DataFrame:
    """The assignment with the inertia of its cluster and of all, and the SHA-256 of its centroid's components."""
    spark = found.assigned.sparkSession
    each = {r.cluster: int(r.s) for r in found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = min(sum(each.values()), LONG)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    rows = [(c, min(s, LONG), whole, digests[c]) for c, s in sorted(each.items())]
    per_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(per_cluster), "cluster").select(*found.assigned.columns, "cluster_inertia", "inertia", "centroid_sha256")
