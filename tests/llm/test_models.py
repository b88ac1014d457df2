import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from peoplelake.llm import quality, toxicity
from tests.llm.fixtures import edge_documents, edge_rows, labels_of, no_documents, sentence

ROWS = "doc_id long, text string, source string, lang string"


def test_toxic_documents_that_were_held_out_are_found(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        text = sentence(rng.randint(3, 120), i).split(" ")
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(1, len(text) // 15)):
                text[rng.randrange(len(text))] = rng.choice(["Zark,", "vlopp", "GRENZ!"])
        rows.append((i, " ".join(text), "s", "en"))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, ROWS), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored_documents(docs, marks).collect()}
    assert set(got) == set(range(900))
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [i for i in got if got[i].held_out]
    right = sum(got[i].predicted == int(i % 5 == 0) for i in held)
    assert right / len(held) > 0.97
    # labels of held-out rows change nothing
    other = spark.createDataFrame([(i, 1 - t if got[i].held_out else t) for i, t in labels], "doc_id long, toxic int")
    assert {r.doc_id: r.score for r in toxicity.scored_documents(docs, other).collect()} == {i: r.score for i, r in got.items()}


def test_toxicity_of_edge_documents(spark):
    docs = edge_documents(spark)
    assert toxicity.scored_documents(no_documents(spark), labels_of(spark, docs)).collect() == []
    for labels in (labels_of(spark, docs), labels_of(spark, docs).limit(0)):
        rows = toxicity.scored_documents(docs, labels).collect()
        assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0.5 and not r.held_out for r in rows if r.doc_id is None)


def test_sparse_rows_do_not_depend_on_chunks():
    texts = [r[1].encode() if r[1] else b"" for r in edge_rows()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    rows, at, x = toxicity.sparse_rows(data, offsets)
    for i, t in enumerate(texts):
        _, one, y = toxicity.sparse_rows(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert np.array_equal(at[rows == i], one) and np.allclose(x[rows == i], y)


def test_ftrl_keeps_few_weights():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(2000, 30, replace=False)), np.ones(30)) for _ in range(600)]
    labels = np.array([float(7 in a) for a, _ in rows])
    for i in range(0, 600, 4):
        rows[i] = (np.unique(np.append(rows[i][0], 7)), np.ones(len(np.unique(np.append(rows[i][0], 7)))))
        labels[i] = 1.0
    at, weights, bias = toxicity.learnt(rows, labels)
    assert at[np.argmax(weights)] == 7 and len(at) < 400


def test_quality_on_held_out_labels(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.document_quality(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r.keep == (r.quality == 1) for r in rows) / len(rows) > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns


def test_quality_of_edge_documents(spark):
    docs = edge_documents(spark)
    labels = labels_of(spark, docs)
    rows = quality.document_quality(docs, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.quality_score <= 1 and r.keep is not None for r in rows)
    assert quality.document_quality(no_documents(spark), labels).collect() == []
    kept = quality.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, docs.collect()))


def test_sparse_sites_are_drawn_to_their_host(spark):
    rows = [("good", "a", 0.95)] * 400 + [("good", "b", 0.05)] * 2 + [("bad", "a", 0.1)] * 300 + [("bad", "b", 0.9)] * 1 + [(None, "a", 0.5)] * 30
    scored = spark.createDataFrame(rows, "source string, lang string, probability double")
    sites = quality.site_posteriors(scored, "source", "lang")
    w, v = sites.path_weight, sites.host_weight
    prior = {(r.source, r.lang): (r.s + w * (r.hs + v * sites.mean) / (r.hn + v)) / (r.n + w) for r in sites.counts.collect()}
    assert abs(sites.mean - sum(r[2] for r in rows) / len(rows)) < 1e-9
    assert 0.05 < prior["good", "b"] < prior["good", "a"] and prior["bad", "a"] < prior["bad", "b"] < 0.9
    assert (None, "a") in prior


def test_a_document_is_not_part_of_its_own_prior(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["x", "x", "y", "z", None]), rng.choice(["a", "b", None]), rng.gauss(0, 3)) for i in range(300)] + [(900, "alone", "a", 2.5)]
    width = len(quality.FEATURES)
    featured = spark.createDataFrame([(i, h, p, [f] + [0.0] * (width - 1), f"n{i}") for i, h, p, f in rows], "doc_id long, source string, lang string, quality_features array<double>, _host string")
    featured = featured.drop("_host")
    evidence = quality.Evidence((1.0,) + (0.0,) * (width - 1), 0.0, 0.4)
    sites = quality.site_posteriors(featured.withColumn("probability", evidence.probability(F.col("quality_features"))), "source", "lang")
    p = {i: 1 / (1 + math.exp(-f)) for i, _, _, f in rows}
    mean = sum(p.values()) / len(p)
    for fitted in (True, False):
        got = {r.doc_id: r for r in quality.QualityModel(evidence, sites, "source", "lang").score(featured, fitted).collect()}
        assert len(got) == len(rows)
        for i, host, path, _ in rows:
            others = [j for j, *_ in rows if j != i or not fitted]
            by = {j: (h, q) for j, h, q, _ in rows}
            on_host = [p[j] for j in others if by[j][0] == host]
            on_path = [p[j] for j in others if by[j] == (host, path)]
            above = (sum(on_host) + sites.host_weight * mean) / (len(on_host) + sites.host_weight)
            prior = (sum(on_path) + sites.path_weight * above) / (len(on_path) + sites.path_weight)
            logit = math.log(p[i] / (1 - p[i])) - math.log(0.4 / 0.6) + math.log(prior / (1 - prior))
            assert abs(got[i].prior - prior) < 1e-9 and abs(got[i].quality_score - 1 / (1 + math.exp(-logit))) < 1e-9
            assert got[i].keep == (got[i].quality_score >= quality.KEEP_FROM)


def test_text_features():
    texts = ["", "One two  two", "A|B | c!", "é é\n1"]
    raw = [t.encode() for t in texts]
    got = quality.text_features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    named = [dict(zip(quality.FEATURES, r, strict=True)) for r in got]
    assert not any(named[0].values())
    assert named[1]["words"] == np.log1p(3) and named[1]["word_length"] == 3 and named[1]["distinct"] == 2 / 3
    assert named[2]["pipes"] == 2 / 8 and named[2]["marks"] == 1 / 8 and named[2]["upper"] == 2 / 8
    assert named[3]["digits"] == 1 / 7 and named[3]["lines"] == 1 / 7


def plain_ftrl(examples, epochs, seed):
    """FTRL-proximal by its definition, coordinate by coordinate."""
    z, n, bias, bias_n = {}, {}, 0.0, 0.0
    alpha, beta, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2

    def weight(c):
        if abs(z.get(c, 0.0)) <= l1:
            return 0.0
        sign = 1.0 if z[c] > 0 else -1.0
        return -(z[c] - sign * l1) / ((beta + math.sqrt(n[c])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            at, x, y = examples[i]
            w = {c: weight(c) for c in at.tolist()}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[c] * v for c, v in zip(at.tolist(), x.tolist(), strict=True)) + bias))))
            for c, v in zip(at.tolist(), x.tolist(), strict=True):
                g = (p - y) * v
                sigma = (math.sqrt(n.get(c, 0.0) + g * g) - math.sqrt(n.get(c, 0.0))) / alpha
                z[c] = z.get(c, 0.0) + g - sigma * w[c]
                n[c] = n.get(c, 0.0) + g * g
            bias_n += (p - y) ** 2
            bias -= alpha * (p - y) / (beta + math.sqrt(bias_n))
    return {c: weight(c) for c in z}, bias


def test_ftrl_against_its_definition():
    rng = np.random.default_rng(9)
    examples = []
    for i in range(200):
        at = np.sort(rng.choice(60, rng.integers(0, 12), replace=False))
        examples.append((at, rng.random(len(at)) + 0.2, float(3 in at or rng.random() < 0.1)))
    weights, bias = toxicity.ftrl(examples, 60, epochs=4, seed=3)
    want, want_bias = plain_ftrl(examples, 4, 3)
    assert abs(bias - want_bias) < 1e-9 and all(abs(weights[c] - want.get(c, 0.0)) < 1e-9 for c in range(60))
    assert weights[3] > 0 and (weights == 0).sum() > 20
