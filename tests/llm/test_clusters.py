"""Centroid clustering against plain Lloyd rounds on Python integers."""

import hashlib
import math

import numpy as np
import pytest

from peoplelake.llm import clusters


def expected(rows, k=8, rounds=10, dimensions=64, scale=1024):
    """(id, cluster, distance) of every kept row and the centroids, by definition."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(x) for _, x in sorted(kept, key=key)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in kept]
        for c in range(len(centroids)):
            members = [x for (_, x), o in zip(kept, own, strict=True) if o == c]
            if members:
                centroids[c] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    return sorted((repr(i), *nearest(x)[::-1]) for i, x in kept), centroids


def check(spark, rows, **options):
    table = spark.createDataFrame([(i, v, -1, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, x string")
    found = clusters.heap_clusters(table, **options)
    want, centroids = expected(rows, **{k: v for k, v in options.items() if k != "seed"})
    got = found.assigned.collect()
    assert sorted((repr(r.vec_id), r.cluster, r.distance) for r in got) == want
    assert found.centroids == centroids
    full = clusters.with_inertia(found).collect()
    each = {c: sum(d for _, o, d in want if o == c) for _, c, _ in want}
    for r in full:
        assert r.cluster_inertia == each[r.cluster] and r.inertia == sum(each.values())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
    return found


def groups(n, dimensions, seed=1, spread=0.05):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (10, dimensions))
    return [(i, [float(x) for x in middles[i % 10] + rng.normal(0, spread, dimensions)]) for i in range(n)]


def test_edge_vectors(spark, monkeypatch):
    monkeypatch.setattr(clusters, "BLOCK_ROWS", 32)
    rows = groups(300, 64)
    rows += [(500, None), (501, [0.5] * 63), (502, [None] + [0.1] * 63), (503, [math.nan] * 64), (504, [math.inf] + [0.0] * 63), (505, [])]
    rows += [(None, rows[3][1]), (None, rows[4][1]), *rows[:40], *[(7, rows[8][1])] * 30, (9_007_199_254_740_993, rows[5][1]), (-3, [0.0] * 64)]
    found = check(spark, rows)
    assert sum(found.rescanned) < 10 * found.rescanned[0]


def test_few_vectors_and_none(spark):
    rows = groups(5, 64)
    check(spark, rows)
    check(spark, rows[:1])
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    found = clusters.heap_clusters(none)
    assert found.centroids == [] and clusters.with_inertia(found).collect() == []
    assert found.assigned.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint")]


def test_equal_vectors_share_the_first_cluster_and_empty_ones_stay(spark):
    rows = [(i, [0.25] * 4) for i in range(50)] + [(100 + i, [1.0 * i, 0.0, 0.0, 0.0]) for i in range(3)]
    check(spark, rows, k=6, rounds=4, dimensions=4)


@pytest.mark.parametrize("size", [1e3, 3e5])
def test_huge_components_are_exact(spark, size):
    rng = np.random.default_rng(3)
    check(spark, [(i, [float(x) for x in rng.normal(0, size, 3)]) for i in range(60)], k=4, rounds=5, dimensions=3)


def test_bounds_spare_vectors(spark):
    found = check(spark, groups(600, 16, spread=0.01), k=10, rounds=6, dimensions=16)
    assert found.rescanned[0] == 600 and sum(found.rescanned[1:]) < 5 * 600 // 2


def test_gaps_stay_valid_while_centroids_move():
    rng = np.random.default_rng(5)
    x, now = rng.integers(-900, 900, (400, 8)), rng.integers(-900, 900, (6, 8))
    own, gap = clusters.own_and_gap(x, now)
    moved = np.zeros(6)
    heaps = clusters.Heaps(own, gap + moved[own], 6)
    for _ in range(12):
        after = now + rng.integers(-40, 40, now.shape)
        moved, now = moved + clusters.drifts(now, after), after
        places = heaps.expired(moved)
        fresh, gap = clusters.own_and_gap(x[places], now)
        heaps.push(places, fresh, gap + moved[fresh])
        assert (heaps.cluster == clusters.own_and_gap(x, now)[0]).all()


def test_vectors_stay_in_their_buckets(spark):
    """A round exchanges the heaps only: the bucketed blocks are read where they lie."""
    table = spark.createDataFrame(groups(40, 64), "vec_id long, embedding array<float>")
    rows = clusters._quantised(table, "vec_id", "embedding", 64, 1024)
    blocks, name = clusters._blocks(rows, 64)
    state = spark.createDataFrame([(0, [0], [0.5])], "block long, cluster array<int>, key array<double>")
    plan = blocks.join(state.hint("shuffle_hash"), "block")._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE `{name}`")
    assert "ShuffledHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
