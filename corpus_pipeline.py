"""A training corpus from raw documents: five operators, each stage written before the next reads it."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from squadlake.llm import decontamination, leaks, packing, quality, simhash
from squadlake.llm.common import table
from squadlake.session import shared_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the language model rejects go; see ``quality.judge`` for nulls and empty texts."""
    return quality.trusted_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays; see ``simhash.one_of_each`` for which."""
    return simhash.one_of_each(docs, simhash.SHINGLE, simhash.DISTANCE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go; see ``decontamination.mark_contaminated``."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, secrets in their texts are replaced; see ``leaks.without_secrets``."""
    return leaks.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token windows, with their ids; see ``packing.pack_documents``."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: A language model, components of a graph and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what lies between them is written to the shared folder."""
    folder = f"{shared_folder(spark)}/corpus-{uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
