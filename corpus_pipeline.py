"""The corpus pipeline: quality rules, quality classifier, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; ``run`` writes each stage's result as Parquet into the shared checkpoint
folder and reads it again as the next one's documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from storepulse.llm import crf_quality, packing, quality_rules, simhash_dedup
from storepulse.llm.frames import ship
from storepulse.llm.queries import BPE, LEAST_QUALITY, quality_model, table
from storepulse.session import ensure_checkpoint_dir


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    ship(spark)
    return quality_rules.keep(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model finds good.

    It learns from the labelled rows of ``documents``: what the rules left has hardly a bad one to learn from.
    """
    model = quality_model(table(spark, sf_dir, "documents"), spark, sf_dir)
    return crf_quality.keep(docs, model, LEAST_QUALITY)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return simhash_dedup.keep(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into training sequences."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path(BPE))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: Expectation-maximisation, training and components can't be written in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
