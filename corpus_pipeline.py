"""From documents to training shards: quality rules, one of near copies, decontamination, mixing, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postweave.llm import decontaminate, jaccard, mixing, quality, tokens
from postweave.llm.common import new_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the calibrated rules keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: four fifths of the five-word shingles in common."""
    return jaccard.keep_one(docs, n=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not make up to a twentieth or more."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights of their sources, a row per epoch."""
    return mixing.mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids in training order; a row per document tells where its ids stand."""
    return tokens.materialise(docs, new_folder(spark, "training"))[0]


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("source mixing", source_mix),
    ("token-ID output", token_shards),
]

# Learned cutoffs, random order and tokenisation are beyond SQL; tests/llm compares small tables with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is a table in the shared folder, so that a lost executor costs no more."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
