"""A training corpus from ``documents``: quality, near-duplicates, benchmark passages, mixing, token files.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; what it returns is written as Parquet
and read again. Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peoplelake.llm import decontaminate, mixing, quality, simhash, tokens
from peoplelake.llm.common import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate group."""
    return simhash.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts and pieces of texts in the amounts of the mix, shard by shard."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every text in the token files."""
    import public_tokenizers

    return tokens.read_tokens(tokens.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_per_group),
    ("benchmark decontamination", no_benchmark),
    ("mixing to target weights", mixed),
    ("token files", token_files),
]

#: A logistic fit, component labels and tokenizer ids have no form in SQL; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
