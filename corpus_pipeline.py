"""Corpus pipeline: documents through five training-data operators.

Each stage takes (spark, docs, sf_dir), calls one operator on all rows that the
stage before it kept, and returns a DataFrame; all but the last return the
columns of ``docs``.  ``run`` writes every stage's rows to the session's shared
folder and reads them back for the next, so a lost executor never reaches further
back than one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockpulse.llm import decontam, mixing, quality, simhash, token_shards
from stockpulse.llm.common import Stage, checkpointed, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line CRF reject go."""
    return quality.quality_filter(docs, quality.train(docs, documents(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return simhash.one_row_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go."""
    return decontam.drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes as often as the mix takes it."""
    return mixing.mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token shards; per sequence its slot, place, documents and checksum."""
    with Stage(spark) as stage:
        return checkpointed(token_shards.shard_report(docs, stage))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_output", token_output),
]

#: The trained quality model, the edit matching and the token shards cannot be
#: expressed in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    with Stage(spark) as stage:
        for name, function in STAGES[:-1]:
            docs = stage.table(function(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)
