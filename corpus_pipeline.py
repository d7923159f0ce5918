"""Corpus pipeline over ``documents``: five stages, each on all that the one before kept.

quality rules (rejected documents go), near duplicates (one of each class stays), benchmark
passages (affected documents go), secrets (reported spans are masked in the text), and the
mix of sources to their target weights.  ``run`` writes each stage's result as a table in
the shared folder that the cluster names and rereads it as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentiscope.llm import decontaminate, mixing, near_duplicates, quality, secrets
from sentiscope.llm.common import materialise, scan


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, scan(spark, sf_dir, "benchmark", "item_id", "text"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words in the mix; those that it leaves out go."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secret_masking", secret_masking), ("source_mix", source_mix)]

# SQL cannot express the near-duplicate stage; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
