"""The registered training-data queries: each operator on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.llm import (
    decontam, line_dedup, mixing, passages, quality, ranked_search, sanitise, secret_scan, sharding,
    simhash, spelling, token_shards, toxicity)
from stockpulse.llm.common import Stage, checkpointed, documents


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.quality_report(docs, quality.train(docs, documents(spark, sf_dir, "labels")))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.encode("base_spans", "UTF-8"), 256).alias("base_sha256"), "spans")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shards to the shared folder and reads the digests from them."""
    with Stage(spark) as stage:
        return checkpointed(token_shards.shard_report(documents(spark, sf_dir), stage))


def op7_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shards to the shared folder and reads the digest from them."""
    with Stage(spark) as stage:
        shuffled = sharding.shuffle_into_shards(documents(spark, sf_dir))
        sharding.write_shards(shuffled, stage.path("shards"))
        written = spark.read.schema(shuffled.schema).parquet(stage.path("shards"))
        return checkpointed(sharding.shard_digest(written))


def op8_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.toxicity_report(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per occurrence of a benchmark item in a document."""
    return decontam.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op11_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.scan_disclosures(documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.encode("base_spans", "UTF-8"), 256).alias("base_sha256"), "spans")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_mix_sources, op3_quality_crf, op4_secret_scan, op5_line_dedup,
        op6_token_shards, op7_shuffle_shards, op8_fuzzy_passages, op9_toxicity, op10_decontaminate,
        op11_pii_disclosure, op12_ranked_search, op13_spelling_variants)
}
