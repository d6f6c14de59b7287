"""The document pipeline: each stage applies one operator to all documents
that its predecessor kept; results are written as Parquet and read again.

Stages take (spark, docs, sf_dir).  All but the last return the columns of
documents; the last returns ids and pieces.  The toxicity stage learns from
the labelled documents that reach it.  The mix repeats a row as often as the
mix takes it, at most twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewatch.llm import minhash_dedup, mixing, quality_rules, sentencepiece_sa, toxicity
from tablewatch.session import scratch_path


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.filter_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_sa.encode_documents(docs)


STAGES = [
    ("quality rules", keep_good_quality),
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Tokeniser metrics, classifier scores and signatures are not expressible in
# SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.split()[0]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
