"""The corpus pipeline: documents in, a weighted mix of clean training text out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cleargrist.llm import decontamination, mixing, near_dedup, quality_rules
from cleargrist.llm.line_dedup import LineIndex
from cleargrist.llm.queries import benchmark, labels
from cleargrist.llm.tables import documents, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    trees = quality_rules.fit(docs, labels(spark, sf_dir))
    return quality_rules.rate_documents(docs, trees, keep_columns=True)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them hold."""
    return LineIndex.build(docs, min_docs=10).clean(docs, keep_columns=True)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, a similarity of 0.8 or more."""
    return near_dedup.keep_one(docs, size=5, threshold=80)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; gone are those that hold little else."""
    return decontamination.remove_matches(docs, benchmark(spark, sf_dir), max_coverage=0.5)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per drawn piece of a document, with its shard and its place there."""
    return mixing.write_order(docs, mixing.mix(docs, weights=(1, 2, 3), most=3))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", copies),
    ("decontamination", leaks),
    ("mixing", mixture),
]

#: The stages learn from labels and search approximately: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each reads what the one before has written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
