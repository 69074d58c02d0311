"""Registered queries of the training-data operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoledger.llm import chat_format, decontaminate, license_scan, mixing, pii, quality, secret_scan, simhash, spelling, suffix_dedup, token_count, token_output, whitening
from chronoledger.llm.common import documents


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir)).drop("cleaned")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(documents(spark, sf_dir))
    return found.withColumn("n_detections", F.size("detections").cast("bigint")).drop("detections")


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.digests(documents(spark, sf_dir))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sampled(documents(spark, sf_dir))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digests(chat_format.windows(chat_format.conversations(spark, sf_dir)))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(documents(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_token_output": op2_token_output,
    "op3_decontaminate": op3_decontaminate,
    "op4_simhash": op4_simhash,
    "op5_secret_scan": op5_secret_scan,
    "op6_mixing": op6_mixing,
    "op7_chat_format": op7_chat_format,
    "op8_token_count": op8_token_count,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling": op11_spelling,
    "op12_pii": op12_pii,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": license_scan.ORACLE_SQL,
    "op5_secret_scan": secret_scan.ORACLE_SQL,
    "op6_mixing": mixing.ORACLE_SQL,
    "op7_chat_format": chat_format.ORACLE_SQL,
    "op10_quality_rules": quality.ORACLE_SQL,
    "op12_pii": pii.ORACLE_SQL,
}
