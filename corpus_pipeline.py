"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept (mixing can give a row several times); ``run`` writes every stage's rows to the shared folder and
reads them for the next. All stages but the last return the columns of
``documents``; the last returns a row for each document (or copy) in the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoledger.llm import decontaminate, mixing, quality, simhash, token_output
from chronoledger.llm.common import documents, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail are removed from the texts, and documents that are rejected go."""
    return quality.clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by their calibrated weights; one of a weight above 1 is repeated."""
    return mixing.repeated(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are written as token files; a row for each, read back from them."""
    return token_output.digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_to_weights", mixing_to_weights),
    ("token_files", token_files),
]

#: SimHash, BM25 retrieval and tokenization have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
