"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are cut into partitions of correlated bits. With thresholds t_p of at least -1 that add up to
``radius - partitions + 1``, two fingerprints within the radius differ in at most t_p bits of some partition p; so
probing every partition for values within t_p finds every pair. Dynamic programming picks the thresholds, and the
number of partitions, with the lowest estimated cost from bit statistics of all fingerprints. Found pairs are verified
on all bits inside the join. Equal fingerprints are one node, so copies are never expanded into pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.llm.common import components, set_aside, written
from peoplelake.llm.words import LOWER, joined_words, text_chunks, word_bounds

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
#: Estimated cost of a probe or index row against that of a candidate pair.
ROW_COST = 10.0


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half the hashes."""
    ones = np.zeros(BITS, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low : low + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text: XXH64 of the shingles of its words, A-Z in lower case; without words it is zero."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out
    text, a, z = joined_words(data, starts, ends)
    digest = xxhash.xxh64_intdigest
    for i, (low, high) in enumerate(itertools.pairwise(first.tolist())):
        if high == low:
            continue
        size = min(shingle, high - low)
        spans = zip(a[low : high - size + 1].tolist(), z[low + size - 1 : high].tolist(), strict=True)
        out[i] = majority(np.fromiter((digest(text[x:y], SEED) for x, y in spans), np.uint64, high - low - size + 1))
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *keep: str) -> DataFrame:
    """doc_id (and ``keep``) with the fingerprint as a signed 64-bit integer; the whole text is read, a null is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, n, data, offsets in text_chunks(batch):
                part = batch.slice(row, n)
                found = pa.array(fingerprints_of(data, offsets, shingle).view(np.int64))
                columns = [part.column(c) for c in range(part.num_columns) if part.schema.names[c] != "text"]
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*columns, found], names=[*names, "fp"])

    rows = docs.select("doc_id", *keep, "text")
    fields = [f for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("fp", T.LongType())]))


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, how many have both set; 64 x 64 numbers from every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        cells = np.append(both.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(cells)), "n": cells})

    cells = nodes.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS + 1)
    for cell, n in cells:
        out[cell] = n
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


@dataclass(frozen=True)
class Partition:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))

    def flips(self) -> list[int]:
        """Every way to change at most ``threshold`` of the bits."""
        ways = (c for k in range(self.threshold + 1) for c in itertools.combinations(self.bits, k))
        return [_signed(sum(1 << b for b in c)) for c in ways]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _grouped_bits(correlation: np.ndarray, groups: int) -> list[list[int]]:
    """Groups of equal size: each starts with a free bit and takes the free bits that correlate most with it."""
    free, out = set(range(BITS)), []
    for g in range(groups):
        size = len(free) // (groups - g)
        first = max(free, key=lambda b: (sum(correlation[b, c] for c in free), -b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            best = max(free, key=lambda b: (sum(correlation[b, c] for c in group), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def _within(differ: np.ndarray, most: int) -> np.ndarray:
    """Chance that at most 0, 1, ... of the bits differ, each with its own chance."""
    exact = np.zeros(most + 1)
    exact[0] = 1
    for p in differ:
        exact[1:] = exact[1:] * (1 - p) + exact[:-1] * p
        exact[0] *= 1 - p
    return np.cumsum(exact)


def plan_partitions(n: int, both: np.ndarray, radius: int = RADIUS) -> list[Partition]:
    """Partitions and thresholds with the lowest estimated number of probe rows and candidates."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    correlation = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    best, plan = math.inf, []
    for groups in range(2, radius + 2):
        bits = _grouped_bits(correlation, groups)
        costs = []
        for group in bits:
            near = _within(2 * share[group] * (1 - share[group]), radius)
            ways = np.cumsum([math.comb(len(group), k) for k in range(radius + 1)])
            costs.append([0.0, *[ROW_COST * (ways[t] + (t > 0)) + n * near[t] for t in range(radius + 1)]])
        # least[s]: lowest cost and thresholds of the groups so far whose (threshold + 1) add up to s
        least = {0: (0.0, ())}
        for cost in costs:
            least = {
                s: min((c + cost[t], (*chosen, t - 1)) for before, (c, chosen) in least.items() if 0 <= (t := s - before) < len(cost))
                for s in range(radius + 2)
                if any(0 <= s - before < len(cost) for before in least)
            }
        total, chosen = least[radius + 1]
        if total < best:
            best, plan = total, [Partition(tuple(b), t) for b, t in zip(bits, chosen, strict=True) if t >= 0]
    return plan


def near_pairs(nodes: DataFrame, plan: list[Partition], radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in at most ``radius`` bits; a pair may come twice."""
    keys = F.array(*[F.struct(F.lit(i).alias("p"), F.col("fp").bitwiseAND(F.lit(p.mask)).alias("key")) for i, p in enumerate(plan)])
    index = nodes.select(F.col("fp").alias("b"), F.explode(keys).alias("k")).select("b", "k.p", "k.key")
    flips = F.create_map(*[x for i, p in enumerate(plan) for x in (F.lit(i), F.array(*[F.lit(f) for f in p.flips()]))])
    probe = index.withColumnRenamed("b", "a")
    if any(p.threshold for p in plan):
        probe = probe.withColumn("flip", F.explode(flips[F.col("p")])).select("a", "p", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    pairs = probe.alias("x").join(index.alias("y"), (F.col("x.p") == F.col("y.p")) & (F.col("x.key") == F.col("y.key")) & close)
    return pairs.select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, *keep: str) -> DataFrame:
    """doc_id (and ``keep``), fp, component_id and root of every document.

    component_id is the smallest doc_id reachable over fingerprints that differ in at most ``radius`` bits, the
    document's own included; null only where no document of the component has an id. root is a fingerprint of the
    component, the same for all its documents. Texts without words have fingerprint zero and are linked like any other;
    repeated rows are in one component.
    """
    rows = written(fingerprints(docs, shingle, *keep), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    n, both = bit_statistics(nodes)
    found = components(near_pairs(nodes, plan_partitions(n, both, radius), radius), "a", "b")
    members = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    members = written(members, "members")
    roots = members.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(members.join(roots, "root").select("fp", "component_id", "root"), "fp")


def with_hex(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents of ``docs`` with the smallest id (then text hash) of every component, columns unchanged.

    Documents without an id come last; of equal rows one stays. Columns of any other name may be there.
    """
    aside, back = set_aside(docs, ("doc_id", "text"))
    no, at, th = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.xxhash64("text")
    aside = aside.select("*", no.alias("_no"), at.alias("_id"), th.alias("_th"))
    rows = near_duplicates(aside, shingle, radius, "_no", "_id", "_th")
    kept = rows.groupBy("root").agg(F.min(F.struct("_no", "_id", "_th")).alias("first")).select("first.*")
    key = ["_no", "_id", "_th"]
    return aside.join(kept, key, "left_semi").dropDuplicates(key).select(*back)
