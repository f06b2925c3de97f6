"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next stage's documents.  All but the last return
the columns of ``documents``.  Row cases (nulls, empty texts, repeated rows)
are those of the operators.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.context import ensure_checkpoint_dir
from quayside.llm import exact_dedup, line_quality, mixing, packing, simhash

#: encoding and packing are beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.clean(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
