import hashlib
import random
import re

import xxhash

from peoplelake.llm import decontaminate, mixing, simhash, substrings
from peoplelake.llm.common import components
from tests.llm.fixtures import edge_documents, edge_rows, no_documents, sentence, words


def expected_kept(rows, window=20):
    """Brute force over all windows in the order of doc_id; rows are (doc_id, text)."""
    first, out = {}, {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s : s + window]), (d, s))
    for d, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] != (d, s):
                gone[s : s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_repeats_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = expected_kept([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.without_repeats(docs).collect()} == want


def test_repeats_of_edge_documents(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    want = expected_kept([(r[0], r[1]) for r in {r[0]: r for r in rows}.values()])
    got = substrings.without_repeats(edge_documents(spark), texts=True).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256
    assert substrings.without_repeats(no_documents(spark)).collect() == []


def test_windows_inside_one_text(spark):
    line = sentence(20, 1)
    docs = spark.createDataFrame([(1, f"{line}\n{line}\n{line}"), (2, " ".join(["a"] * 45)), (3, sentence(19, 2) + " " + sentence(19, 2))], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in substrings.without_repeats(docs).collect()}
    want = expected_kept([tuple(r) for r in docs.collect()])
    assert got == {d: v[1:] for d, v in want.items()}


def expected_lengths(rows, window=20):
    """(n_words, windows, occurrences) by counting all windows of every document."""
    out, length = [], window
    documents = {(repr(d) if d is not None else f"text {t}", t) for d, t in rows}
    while True:
        seen = {}
        for _, text in documents:
            w = words(text)
            for s in range(len(w) - length + 1):
                key = tuple(w[s : s + length])
                seen[key] = seen.get(key, 0) + 1
        several = [n for n in seen.values() if n > 1]
        if not several:
            return out
        out.append((length, len(several), sum(several)))
        length *= 2


def test_repeated_lengths(spark):
    line, long = sentence(23, 1), sentence(100, 2)
    texts = [
        f"{sentence(30, 3)} {line} {sentence(30, 4)}", f"{line} {sentence(9, 5)} {line} {line}", long, f"{sentence(12, 6)} {long[40:]}", sentence(50, 7), sentence(50, 7),
        sentence(50, 7), sentence(19, 8), sentence(19, 8), None, "", " ".join(["a"] * 90), f"{sentence(30, 3)} {sentence(45, 9)}",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, texts[4]), (None, line), (None, line), (77, long)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, h string")
    got = sorted(tuple(r) for r in substrings.repeated_lengths(docs).collect())
    assert got == expected_lengths(rows) and [r[0] for r in got] == [20, 40, 80]
    assert substrings.repeated_lengths(no_documents(spark)).collect() == []


def test_repeated_lengths_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in substrings.repeated_lengths(table).collect()) == expected_lengths(rows)


def expected_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_components(rows):
    fps = [expected_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((d, f"{fps[i]:016x}", min(ids) if ids else None))
    return out


def test_fingerprints_and_components(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    near = sentence(300, 5).split(" ")
    more = [(5000 + i, " ".join([*near[:i], "x", *near[i + 1 :]])) for i in range(12)]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()] + more + [(r[0], r[1]) for r in edge_rows()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in simhash.with_hex(simhash.near_duplicates(table)).collect()]
    assert sorted(got, key=repr) == sorted(expected_components(rows), key=repr)
    assert simhash.near_duplicates(no_documents(spark)).collect() == []


def test_every_plan_finds_every_pair(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    values = {int(b) for b in base}
    for b in base:
        for _ in range(6):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            values.add(int(b) ^ simhash._signed(sum(1 << int(f) for f in flips)))
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    mask = (1 << 64) - 1
    want = {(a, b) for a in values for b in values if a < b and ((a ^ b) & mask).bit_count() <= 4}
    flat = np.full((64, 64), 0.25) + np.eye(64) * 0.25
    for n in (1e3, 1e7, 1e10):
        plan = simhash.plan_partitions(int(n), flat * n)
        assert sum(p.threshold + 1 for p in plan) == 5 and sorted(b for p in plan for b in p.bits) == list(range(64))
        assert {tuple(r) for r in simhash.near_pairs(nodes, plan).collect()} == want


def test_one_of_each(spark):
    kept = simhash.one_of_each(edge_documents(spark))
    assert kept.columns == edge_documents(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and ids.count(107) == 1 and 108 not in ids
    first = {}
    for (d, text), (_, _, component) in zip([(r[0], r[1]) for r in edge_rows()], expected_components([(r[0], r[1]) for r in edge_rows()]), strict=True):
        first.setdefault(component, set()).add(d)
    assert sorted(ids, key=repr) == sorted(first, key=repr)
    assert simhash.one_of_each(no_documents(spark)).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 200), (200, 300), (7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 200, 300: 200}


CLASHING = "doc_id long, text string, source string, lang string, n_chars long, h string, _id string, _NO int, _th string, _nth string, _copy string, root string, fp string, component_id string, th string, size string, _H string"


def clashing(spark):
    """Documents with columns named like those of the stages, each with a value of its own."""
    rows = [(d, text, "ab"[d % 2], "en", len(text), *[f"{c}{d}" if c != "_NO" else d for c in ("h", "_id", "_NO", "_th", "_nth", "_copy", "root", "fp", "component_id", "th", "size", "_H")])
            for d, text in [(1, sentence(300, 1)), (2, sentence(300, 1)), (3, sentence(60, 3)), (4, sentence(2000, 4)), (5, "")]]
    return spark.createDataFrame(rows, CLASHING)


def test_stages_keep_the_values_of_clashing_columns(spark):
    docs = clashing(spark)
    items = spark.createDataFrame([(1, sentence(60, 3))], "item_id long, text string")
    whole = {r.doc_id: tuple(r) for r in docs.collect()}
    kept = {r.doc_id: tuple(r) for r in simhash.one_of_each(docs).collect()}
    assert kept == {d: whole[d] for d in (1, 3, 4, 5)}
    kept = {r.doc_id: tuple(r) for r in decontaminate.without_benchmark(docs, items).collect()}
    assert kept == {d: whole[d] for d in (1, 2, 4, 5)}
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns and mix.dtypes == docs.dtypes
    rows = mix.collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4}
    for r in rows:
        assert tuple(r)[2:4] == whole[r.doc_id][2:4] and tuple(r)[5:] == whole[r.doc_id][5:]
        assert r.n_chars == len(r.text) and r.text in whole[r.doc_id][1]
