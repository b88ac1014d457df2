"""One registered query per operator, over whole tables and with production parameters."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.llm import clusters, conversations, decontaminate, language, mixing, oracle_sql, pages, privacy, quality, simhash, substrings, tokens, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_amounts(mixing.mix_sources(table(spark, sf_dir, "documents")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(table(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.read_tokens(tokens.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_hex(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op9_document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a key of the run's own, unless the session sets one that later runs shall agree with
    key = spark.conf.get("spark.surrogates.key", None)
    return privacy.with_surrogates(table(spark, sf_dir, "documents"), key.encode() if key else secrets.token_bytes(32))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.with_inertia(clusters.heap_clusters(table(spark, sf_dir, "embeddings")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repaired = conversations.repaired(conversations.damaged(rows), rows.select("conv_id").distinct())
    return repaired.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.scored_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_main_text": op3_main_text,
    "op4_token_files": op4_token_files,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_toxicity": op7_toxicity,
    "op8_simhash_components": op8_simhash_components,
    "op9_document_quality": op9_document_quality,
    "op10_surrogates": op10_surrogates,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_language_model": op13_language_model,
}
ORACLE: dict[str, str] = {
    "op6_exact_top_k": oracle_sql.TOP_K,
    "op11_centroid_clusters": oracle_sql.CLUSTER,
    "op12_conversation_repair": oracle_sql.CONVERSATIONS,
}
