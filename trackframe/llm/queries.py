"""The queries opN_<name> and, where SQL can express them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, fingerprints, lang_id, line_dedup, lm_score, mixing, near_dedup, packing, sharding, toxicity
from .common import id_remainder, read_documents


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).withColumn("held_out", id_remainder(F.col("doc_id"), 4) == 2)
    model = lang_id.fit(docs.where(~F.col("held_out")))
    return lang_id.identify(docs, model, keep=("doc_id", "held_out"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read_documents(spark, sf_dir))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).withColumn("held_out", id_remainder(F.col("doc_id"), 5) == 1)
    model = lm_score.fit(docs.where(~F.col("held_out")))
    return lm_score.lm_score(docs, model, keep=("doc_id", "held_out"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_documents(spark, sf_dir), shards=40)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).withColumn("held_out", id_remainder(F.col("doc_id"), 4) == 2)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(id_remainder(F.col("doc_id"), 4) != 2)
    return toxicity.toxicity(docs, toxicity.fit(docs, labels), keep=("doc_id", "held_out"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(read_documents(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(read_documents(spark, sf_dir), k=3, num=85, den=100)


def queries() -> dict:
    return {
        "op1_language_id": op1_language_id,
        "op2_line_dedup": op2_line_dedup,
        "op3_lm_score": op3_lm_score,
        "op4_mixing": op4_mixing,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_sharding": op6_sharding,
        "op7_packing": op7_packing,
        "op8_toxicity": op8_toxicity,
        "op9_fingerprints": op9_fingerprints,
        "op10_near_dedup": op10_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": line_dedup.ORACLE_SQL,
        "op4_mixing": mixing.ORACLE_SQL,
        "op5_exact_dedup": exact_dedup.ORACLE_SQL,
        "op10_near_dedup": near_dedup.ORACLE_SQL,
    }
