"""A training-corpus pipeline over `documents`: five stages, each written and read again by the next.

Rejected documents go, one document of each near-duplicate group stays, documents that hold
benchmark passages go, sources are mixed to their weights (a document taken twice is there
twice), and the mix is dealt to shards.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from queixa.llm.decontaminate import remove_leaks
from queixa.llm.minhash import one_of_each
from queixa.llm.mixture import mix
from queixa.llm.quality import keep_good
from queixa.llm.shards import shard_rows
from queixa.session import shared_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, shingle=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_rows(docs, shards=16).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixture", mixed),
    ("shards", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what lies between them is kept in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


# Classifier weights, min-max signatures and the label propagation are not SQL.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
