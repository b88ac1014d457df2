"""Registered queries over whole tables, the pipeline, and the repository without the subpackage."""


import shutil
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
import public_tokenizers
from __spark_entry__ import oracle_sql, queries
from tokenizers import Tokenizer

import corpus_pipeline
from peoplelake.llm.queries import ORACLE, QUERIES
from tests.llm.fixtures import edge_documents, edge_rows, no_documents, words
from tests.llm.test_dedup import expected_fingerprint
from verification.compare import connect, difference

COLUMNS = {
    1: "doc_id long size long source_size long target double taken long", 2: "doc_id long n_words long n_removed long kept_sha256 string",
    3: "page_id long url string text string n_chars long", 4: "doc_id long start long n_tokens long ids_crc32 long",
    6: "query_id long rank int vec_id long score long", 7: "doc_id long held_out boolean score double predicted int",
    8: "doc_id long fingerprint string component_id long",
    11: "vec_id long cluster int distance long cluster_inertia long inertia long centroid_sha256 string",
    12: "conv_id long gaps long blank long duplicate long truncated long illegal long cost long audit string repaired_sha256 string",
    13: "doc_id long held_out boolean n_tokens long n_known long train_tokens long base_score double score double",
}
TYPES = {"long": "bigint"}


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    number = int(name[2:].split("_")[0])
    if number in COLUMNS:
        parts = COLUMNS[number].split()
        want = [(c, TYPES.get(t, t)) for c, t in zip(parts[::2], parts[1::2], strict=True)]
        assert df.dtypes[: len(want)] == want
    rows = df.collect()
    assert rows
    if name in ORACLE:
        cur = connect(sf_dir).execute(ORACLE[name])
        order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
        got = (sorted(df.columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr))
        names = [d[0] for d in cur.description]
        order = sorted(range(len(names)), key=lambda i: names[i])
        assert difference(got, (sorted(names), sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr))) is None


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], sf_dir))
        if len(kept) < 6:
            assert kept[-1].columns == docs.columns, name
            kept[-1] = spark.createDataFrame(kept[-1].collect(), docs.schema)
    rows = [k.collect() for k in kept]
    right = [labels[r.doc_id] == int(r.doc_id in {k.doc_id for k in rows[1]}) for r in rows[0] if r.doc_id in labels]
    assert sum(right) / len(right) > 0.9
    prints = [expected_fingerprint(r.text) for r in rows[2]]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    assert {r.doc_id for r in rows[2] if not any(t in r.text for t in items)} >= {r.doc_id for r in rows[3]}
    sizes, taken = {}, {}
    for r in rows[3]:
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    for r in rows[4]:
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= len(sizes)
    plain, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for r in rows[4]:
        ids = [*plain.encode(r.text, add_special_tokens=False).ids, 0]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(want) == sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows[5])


@pytest.mark.parametrize("make", [edge_documents, no_documents])
def test_stages_on_edge_documents(spark, sf_dir, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() <= 3 * len(edge_rows()) and (docs.count() or not out.count())


def test_the_rest_works_without_the_subpackage(tmp_path):
    root = Path(__file__).parents[2]
    for part in ("peoplelake", "verification"):
        shutil.copytree(root / part, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not any(n.startswith('op') for n in q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}).returncode == 0
