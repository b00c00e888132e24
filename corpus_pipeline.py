"""A training corpus in five stages, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortix.llm import decontamination, near_dup, packing, quality, toxicity
from cohortix.llm.common import cut, shared_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good, learned from the labelled ones."""
    return quality.keep_quality(docs, quality.train_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic, learned from the labelled ones."""
    return toxicity.drop_toxic(docs, toxicity.train_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    where = shared_dir(spark)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), where)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Classifiers, chosen paths and branch and bound are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
