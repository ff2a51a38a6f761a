"""The registered queries and the SQL that gives their rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from squadlake.llm import (
    centroids,
    chat,
    decontamination,
    fill_in_middle,
    leaks,
    packing,
    quality,
    search,
    sharding,
    simhash,
    suffixes,
    token_files,
    toxicity,
)
from squadlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(table(spark, sf_dir, "conversations"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op9_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_inner_products(table(spark, sf_dir, "embeddings"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontamination_digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.secrets_digest(table(spark, sf_dir, "documents"))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle_digest(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_digest(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op3_chat_formatting,
        op8_sharding,
        op9_top_k_search,
        op10_decontamination,
        op6_secret_scans,
        op1_simhash_near_dedup,
        op7_packing,
        op5_quality_classifier,
        op4_toxicity,
        op2_suffix_array_dedup,
        op11_fill_in_middle,
        op12_token_files,
        op13_centroid_clustering,
    )
}

SQL: dict[str, str] = {
    "op3_chat_formatting": chat.CHAT_SQL,
    "op6_secret_scans": leaks.SECRETS_SQL,
    "op9_top_k_search": search.SEARCH_SQL,
    "op10_decontamination": decontamination.DECONTAMINATION_SQL,
    "op11_fill_in_middle": fill_in_middle.FILL_IN_MIDDLE_SQL,
    "op13_centroid_clustering": centroids.CENTROIDS_SQL,
}
