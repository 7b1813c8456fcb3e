"""From raw documents to a mixed corpus in shards: stages that each read what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerlens.llm import decontaminate, language, mixing, near_dedup, shard
from offerlens.llm.queries import SHARDS, TARGETS, domains
from offerlens.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or with a doubtful language go."""
    return language.accepted(docs, language.fit(language.learnable(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their domains ask: most once, some twice, some not at all."""
    return mixing.mixed(docs, domains(spark.read.parquet(f"{sf_dir}/labels.parquet")), TARGETS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in random order, with shard and slot."""
    return shard.shards_of(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("target_mix", target_mix),
    ("sharding", sharding),
]

# Learned models and a random order have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
