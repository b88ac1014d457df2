"""Class-based scores against counts and probabilities taken with plain loops."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from peoplelake.llm import language
from tests.llm.fixtures import edge_documents, edge_rows, no_documents, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
END = None


def tokens(text):
    return [*words((text or "").translate(LOWER)), END]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def base(rows):
    """(held_out, n_tokens, n_known, train_tokens, base_score) of every row."""
    train = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(train.values()), len(train)
    out = []
    for i, text in rows:
        w = tokens(text)
        score = sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w)
        out.append((held(i), len(w), sum(train[t] > 0 for t in w), n, score))
    return out, train


def keyed(rows):
    return sorted(rows, key=repr)


def check_base(spark, table, rows, **options):
    got = language.scored_documents(table, **options)
    assert got.dtypes[:7] == [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")]
    got = got.collect()
    want, _ = base(rows)
    assert keyed((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0) for r in got) == keyed((i, *w[:-1], round(w[-1], 6) + 0.0) for (i, _), w in zip(rows, want, strict=True))
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    return {r.doc_id: r for r in got}


@pytest.mark.parametrize("hot", [1 << 20, 40, 0])
def test_edge_documents(spark, hot):
    check_base(spark, edge_documents(spark), [(r[0], r[1]) for r in edge_rows()], hot=hot)


def test_no_documents_and_none_to_learn_from(spark):
    assert language.scored_documents(no_documents(spark)).collect() == []
    ids = [i for i in range(100) if held(i)]
    table = spark.createDataFrame([(i, "some words" if i % 2 else None) for i in ids], "doc_id long, text string")
    for r in language.scored_documents(table).collect():
        assert (r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 0, 0, 0.0, 0.0)


def corpus(n=150, seed=3):
    """Two kinds of words that take turns, each of many words, and words that occur once."""
    rng = random.Random(seed)
    kinds = [[f"{k}{i}" for i in range(60)] for k in "ab"]
    rows = []
    for i in range(n):
        text = [rng.choice(kinds[t % 2][: rng.choice([8, 60])]) for t in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            text.insert(rng.randint(0, len(text)), f"once{rng.randint(0, 400)} odd{rng.randint(0, 30)}")
        rows.append((i, " ".join(text).capitalize()))
    return rows


def class_of_words(spark, table, vocabulary, **options):
    """The class of every training word, by the operator's own steps."""
    docs = table.select("doc_id", language.is_held_out(table.doc_id).alias("held_out"), "text")
    found = language.frequent_words(language.word_counts(docs), docs.filter("NOT held_out").count(), options["hot"])
    texts = language.encoded(docs, found)
    model, pairs, seen = language.learnt_classes(texts, found, options["k"], options["exchanged"], options["sweeps"])
    assert all(b >= a for a, b in zip(seen[:-2], seen[1:-1], strict=False))
    other = language.other_words(texts, found, model, pairs)
    model = language.with_other_words(found, model, other)
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(vocabulary)]})
    hashes = next(language._words(batch))[2].tolist()
    by = {h: int(c) for h, c in zip(found.hashes.tolist(), model.class_of, strict=False)}
    by |= {r.h: r["class"] for r in other.filter("NOT has_code").collect()}
    return {w: by[h] for w, h in zip(vocabulary, hashes, strict=True)}


def plain_scores(rows, classes, k):
    """Scores by definition from the classes."""
    end, unseen = k, k + 1
    _, train = base(rows)
    class_of = lambda t: end if t is END else classes[t] if train[t] else unseen
    pairs, size, total = Counter(), Counter(), sum(train.values())
    for i, text in rows:
        w = [END, *tokens(text)]
        for a, b in zip(w, w[1:], strict=False):
            if not held(i):
                pairs[class_of(a), class_of(b)] += 1
                size[class_of(b)] += 1
                if b is not END and train[b] == 1:
                    pairs[class_of(a), unseen] += 1
                if a is not END and train[a] == 1:
                    pairs[unseen, class_of(b)] += 1
    once = sum(1 for t, n in train.items() if n == 1 and t is not END)
    every = [*range(k), end]

    def chance(a, b):
        sums = sum(pairs[a, c] for c in every)
        seen_once = pairs[a, unseen] if a != unseen else 0
        new = (seen_once + language.PRIOR * (once + 0.5) / (total + 1)) / (sums + language.PRIOR)
        if b == unseen:
            return new
        return (1 - new) * (pairs[a, b] + language.PRIOR * size[b] / total) / (sums + language.PRIOR)

    out = {}
    for i, text in rows:
        w = [END, *tokens(text)]
        out[i] = sum(math.log10(chance(class_of(a), class_of(b)) * (train[b] / size[class_of(b)] if train[b] else 1)) for a, b in zip(w, w[1:], strict=False))
    # what may follow adds up to one
    for a in [*every, unseen]:
        assert abs(sum(chance(a, class_of(t)) * n / size[class_of(t)] for t, n in train.items()) + chance(a, unseen) - 1) < 1e-9
    return out


@pytest.mark.parametrize("hot", [1 << 20, 64])
def test_scores_against_plain_loops(spark, hot):
    rows = corpus()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    options = {"k": 6, "exchanged": 30, "sweeps": 2, "hot": hot}
    got = check_base(spark, table, rows, **options)
    _, train = base(rows)
    classes = class_of_words(spark, table, [t for t in train if t is not END], **options)
    want = plain_scores(rows, classes, 6)
    assert all(abs(got[i].score - want[i]) < 1e-6 * max(1, abs(want[i])) for i in want)


def test_codes_do_not_change_the_scores(spark):
    """Words beyond the broadcast meet their classes in shuffles, with the same result."""
    table = spark.createDataFrame(corpus(), "doc_id long, text string")
    scores = [{r.doc_id: round(r.score, 6) for r in language.scored_documents(table, k=6, exchanged=30, sweeps=2, hot=hot).collect()} for hot in (1 << 20, 64)]
    assert scores[0] == scores[1]


def test_classes_help_on_held_out_texts(spark):
    rows = corpus(400)
    got = [r for r in language.scored_documents(spark.createDataFrame(rows, "doc_id long, text string"), k=6, exchanged=120, sweeps=3).collect() if r.held_out]
    assert len(got) > 20 and sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)
    a = class_of_words(spark, spark.createDataFrame(rows, "doc_id long, text string"), [f"{k}{i}" for k in "ab" for i in range(60)], k=6, exchanged=120, sweeps=3, hot=1 << 20)
    pure = sum(max(n) for n in (Counter(k[0] for k, c in a.items() if c == x).values() for x in set(a.values())))
    assert pure / len(a) > 0.9


def test_gains_are_differences_of_the_likelihood():
    rng = np.random.default_rng(2)
    k, w = 4, 7
    pairs = rng.integers(20, 60, (w, w)).astype(float)
    before, behind, itself = rng.integers(0, 9, w).astype(float), rng.integers(0, 9, w).astype(float), 3.0
    behind[0] += before.sum() - behind.sum() if before.sum() > behind.sum() else 0
    before[0] += behind.sum() - before.sum() if behind.sum() > before.sum() else 0
    gain, likelihoods = language.gains(pairs, before, behind, itself, k), []
    for c in range(k):
        after = pairs.copy()
        language._moved(after, c, before, behind, itself, 1)
        likelihoods.append(language.likelihood(after))
    assert np.allclose(gain - gain[0], np.array(likelihoods) - likelihoods[0])
