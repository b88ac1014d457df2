import itertools
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from peoplelake.llm import mixing
from tests.llm.fixtures import edge_documents, edge_rows, no_documents, words


def expected_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        rest = share * sum(sizes.values()) - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in open_)
        target = {s: rest * weight[s] / total for s in open_} if open_ else {}
        above = [s for s in open_ if target[s] > most * sizes[s]]
        if not above:
            return fixed | target
        fixed |= {s: most * sizes[s] for s in above}


def check(rows, docs):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(words(text))
    target = expected_targets(sizes)
    taken = Counter()
    want = Counter((d, len(words(t)), sizes[s]) for d, t, s in docs)
    assert Counter((r.doc_id, r.size, r.source_size) for r in rows) == want
    by_size = {}
    for s in sizes:
        by_size.setdefault((sizes[s], round(target[s], 6)), 0)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        assert (r.source_size, round(r.target, 6)) in by_size
        taken[r.source_size, round(r.target, 6)] += r.taken
    for s in sizes:
        group = [x for x in sizes if sizes[x] == sizes[s]]
        assert abs(taken[sizes[s], round(target[s], 6)] - sum(target[g] for g in group if round(target[g], 6) == round(target[s], 6))) <= len(group)


def test_edge_documents(spark):
    docs = edge_documents(spark)
    rows = mixing.mixed_amounts(mixing.mix_sources(docs)).collect()
    check(rows, [(r[0], r[1], r[3]) for r in edge_rows()])
    again = mixing.mixed_amounts(mixing.mix_sources(docs.repartition(5))).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mixed_amounts(mixing.mix_sources(docs)).collect()
    check(rows, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])


def test_no_documents(spark):
    assert mixing.mixed_amounts(mixing.mix_sources(no_documents(spark))).collect() == []
    assert mixing.mixed_documents(no_documents(spark)).collect() == []


def test_shards_meet_quotas_and_tickets_are_disjoint(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mix = mixing.mix_sources(docs, mixing.MixSettings(block_words=100, shards=6))
    draws = mix.draws.collect()
    assert len({(d.source_name, d.no_source, d.block, d["pass"]) for d in draws}) == len(draws)
    sizes = Counter(d.shard for d in draws)
    assert set(sizes) == set(range(6)) and max(sizes.values()) - min(sizes.values()) <= 6


def test_mixed_documents_hold_what_was_taken(spark):
    docs = edge_documents(spark)
    taken = sum(r.taken for r in mixing.mixed_amounts(mixing.mix_sources(docs)).collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sum(len(words(r.text)) for r in rows) == taken
    whole = {}
    for r in edge_rows():
        whole.setdefault(r[0], []).append(" ".join(words(r[1])))
    for r in rows:
        assert r.n_chars == len(r.text)
        assert len(words(r.text)) and any(all(w in t.split(" ") for w in words(r.text)) for t in whole[r.doc_id])


@pytest.mark.parametrize("total,good,drawn", [(10, 4, 5), (9, 9, 3), (30, 1, 29), (50, 25, 25), (7, 0, 3), (40, 3, 10)])
def test_hypergeometric_inversion(spark, total, good, drawn):
    sql = mixing._hypergeometric(str(total), str(good), str(drawn), "u")
    n = 400
    got = [r[0] for r in spark.range(n).select(((F.col("id") + 0.5) / n).alias("u")).select(F.expr(sql)).collect()]
    mass = [math.comb(good, x) * math.comb(total - good, drawn - x) / math.comb(total, drawn) if 0 <= drawn - x <= total - good else 0 for x in range(good + 1)]
    upto = list(itertools.accumulate(mass))
    assert got == [next((x for x, c in enumerate(upto) if (i + 0.5) / n < c - 1e-12), good) for i in range(n)]
