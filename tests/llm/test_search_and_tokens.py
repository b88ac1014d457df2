import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from peoplelake.llm import decontaminate, tokens, topk
from tests.llm.fixtures import edge_documents, edge_rows, no_documents, sentence

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_token_files_round_trip(spark, tmp_path):
    docs = edge_documents(spark)
    manifest = tokens.write_tokens(docs, BPE, f"file://{tmp_path}/set")
    got = sorted(tokens.read_tokens(manifest).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert len(got) == len(edge_rows()) and ids == sorted(ids, key=lambda i: (i is not None, i))
    plain = Tokenizer.from_file(BPE)
    want = sorted((repr(r[0]), zlib.crc32(np.array([*plain.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for r in edge_rows())
    assert sorted((repr(r.doc_id), r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    kept = []
    for row in manifest.orderBy("part").collect():
        part, offsets, keys, missing = tokens.read_part(row["data"], row["index"])
        assert isinstance(part, np.memmap) and part.dtype == np.dtype("<u2") and offsets.dtype == np.dtype("<i8")
        assert offsets[0] == row.base and offsets[-1] - offsets[0] == len(part) and len(keys) == len(missing) == row.n_docs
        kept += part.tolist()
    assert len(kept) == at


def test_no_token_files(spark, tmp_path):
    assert tokens.read_tokens(tokens.write_tokens(no_documents(spark), BPE, f"file://{tmp_path}/none")).collect() == []


def test_pieces_have_the_ids_of_the_whole_text():
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "é", "ñ", "Ж", "1", "٣", "'s", "'", "'ll", "!", "—", "́", "日", "_", " ", " ", "x", "the", "\r\n", "<|endoftext|>", "%", "ß", "×", "²"]
    e = tokens.Encoder(BPE)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    assert e.encode(texts) == e.ids(texts)


def expected_top(vectors, k=5):
    good = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = set()
    for q, x in good.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good.items() if i != q and len(x) == len(y))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def test_other_space_is_found_in_every_text():
    for i in range(0x3100):
        for text in (chr(i), f"a {chr(i)}b", f"\u4e2d{chr(i)}"):
            assert tokens._has_other_space(text) == bool(tokens.OTHER_SPACE.search(text))


def test_new_words_are_encoded_together():
    class Counting:
        def __init__(self, inner):
            self.inner, self.texts = inner, 0

        def encode_batch_fast(self, texts, **settings):
            self.texts += len(texts)
            return self.inner.encode_batch_fast(texts, **settings)

    rng, e = random.Random(5), tokens.Encoder(BPE)
    whole, e.tokenizer = e.tokenizer, Counting(e.tokenizer)
    alphabet = "abcxyz019.,'-<|>\u00e9\u00df\u4e2d\U0001f600\u0301"
    words = ["".join(rng.choices(alphabet, k=rng.randint(1, 9))) for _ in range(3000)]
    texts = ["".join(rng.choice((" ", "  ", "\n", " \t")) + w for w in words[i : i + 100]) + rng.choice(("", " ", "\n ")) for i in range(0, 3000, 100)]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, dtype=e.kind).tobytes() for t in texts]
    assert e.encode(texts) == want and e.tokenizer.texts < 1000


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 24)]) for i in range(420)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2050, [1.0, None] * 12), (2100, [math.nan] * 24), (2150, [math.inf] + [0.0] * 23), (None, rows[0][1]), (2200, [0.5, 0.5]), (2201, [0.25, -1.0]), (2250, [])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = topk.top_k(table, "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in got.collect()} == expected_top(rows)
    assert topk.top_k(table.limit(0), "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect() == []


def test_blocks_do_not_change_the_result(spark, sf_dir, monkeypatch):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = {tuple(r) for r in topk.top_k(table, "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect()}
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "SEED_ROWS", 3)
    assert {tuple(r) for r in topk.top_k(table, "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect()} == whole


@pytest.mark.parametrize("parts", topk.LEVELS)
def test_segment_bounds_hold(parts):
    rng = np.random.default_rng(parts)
    q, x = rng.normal(size=(20, 37)), rng.normal(size=(50, 37))
    assert (topk.segment_statistics(q, parts) @ topk.segment_statistics(x, parts).T >= q @ x.T - 1e-9).all()


ITEMS = "item_id long, text string, key string, n int"


def windows_above(text, item, least=0.8):
    """Brute force: does any item-sized window reach the similarity?"""
    a, b = text.lower().split(), item.lower().split()
    size = min(5, len(b))
    grams = lambda w: [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
    want = grams(b)
    for s in range(max(1, len(a) - len(b) + 1)):
        have = grams(a[s : s + len(b)])
        both = sum(min(have.count(g), want.count(g)) for g in set(want))
        if both / max(1, len(have) + len(want) - both) >= least:
            return True
    return False


def test_leaks_against_brute_force(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng.randint(12, 60), 900 + i), "x", 1) for i in range(25)] + [(90, "three short words", "x", 1), (91, None, "x", 1), (92, " ", "x", 1), (0, sentence(12, 5), "x", 1)]
    docs = []
    for i in range(120):
        text = sentence(rng.randint(1, 200), 100 + i).split(" ")
        item = items[i % 25][1].split(" ")
        if i % 3 == 0:
            for _ in range(i % 4):
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() for w in item] if i % 2 else item
        docs.append((i, "\n ".join(text), "k"))
    docs += [(500, items[3][1], "k"), (501, "say three short words now", "k"), (502, "three short", "k"), (None, items[4][1], "k"), (None, None, "k"), (503, "", "k"), (500, items[3][1], "k")]
    table = spark.createDataFrame(docs, "doc_id long, text string, key string")
    found = decontaminate.contaminated(table, spark.createDataFrame(items, ITEMS))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    want = {(d, i) for d, t, _ in docs for i, x, *_ in items if (x or "").split() and (t or "").split() and windows_above(t, x)}
    assert got == want and len(want) > 10
    kept = decontaminate.without_benchmark(table, spark.createDataFrame(items, ITEMS))
    assert kept.columns == table.columns
    bad = {d for d, _ in want}
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(d) for d, t, _ in docs if d not in bad or (d is None and t is None))


def test_edited_leaks_of_items_that_share_text(spark):
    whole, half = sentence(50, 1), sentence(25, 2)
    items = [(i, whole, "x", 1) for i in range(10)] + [(20 + i, f"{half} {sentence(25, 30 + i)}", "x", 1) for i in range(8)]
    edits = [(100 * j + n, x[1].split(" "), at) for j, x in enumerate(items[9:]) for n, at in enumerate((10, 40, 0))]
    docs = [(d, " ".join([*sentence(30, d).split(" "), *w[:at], "changed", *w[at + 1 :], *sentence(30, d + 1).split(" ")])) for d, w, at in edits]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    want = {(d, i) for d, t in docs for i, x, *_ in items if windows_above(t, x)}
    assert len(want) == 30 + 24 and {(r.doc_id, r.item_id) for r in found.collect()} >= want


def test_no_leaks_in_empty_tables(spark):
    items = spark.createDataFrame([(1, sentence(20, 1), "", 0)], ITEMS)
    docs = spark.createDataFrame([(1, sentence(20, 1))], "doc_id long, text string")
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []
    assert decontaminate.contaminated(docs, items.limit(0)).collect() == []
    assert decontaminate.without_benchmark(edge_documents(spark), items.limit(0)).count() == len(edge_rows())


def test_multi_index_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 63), 1 << 63, 12, dtype=np.int64, endpoint=False)
    near = [(f"w{i}{j}", int(b ^ np.int64(np.bitwise_xor.reduce([np.int64(1) << np.int64(f) for f in rng.choice(63, j, replace=False)] or [np.int64(0)])))) for i, b in enumerate(base) for j in range(0, 30, 2)]
    items = spark.createDataFrame([(f"i{i}", int(b)) for i, b in enumerate(base)], "key string, fp long")
    got = {(r.item, r.window) for r in decontaminate.hamming_pairs(items, spark.createDataFrame(near, "key string, fp long")).collect()}
    mask = (1 << 64) - 1
    assert got == {(f"i{i}", w) for i, b in enumerate(base) for w, v in near if ((int(b) ^ v) & mask).bit_count() <= decontaminate.RADIUS}
