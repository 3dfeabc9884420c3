"""Five filtering and encoding stages over ``documents``, each stored before the next one reads it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from notepairs.llm import exact, mixing, quality, similar
from notepairs.llm.queries import bpe_digests
from notepairs.session import shared_folder


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first quality rules keep."""
    return quality.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the longest, then the smallest id."""
    return exact.drop_exact(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by similar five-word shingles (Jaccard 0.8 or more): the smallest id."""
    return similar.drop_similar(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix, each as often as the mix takes it."""
    return mixing.mix(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document of the mix."""
    return bpe_digests(docs)


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", unlike_documents),
    ("mixing", mixed_documents),
    ("byte_bpe", encoded_documents),
]

#: Fingerprints and token ids cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every stage but the last is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        schema = kept.schema
        kept.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(schema).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
