"""The corpus pipeline: each stage works on all documents its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import jaccard_join, packing, quality_classifier, quality_rules, span_dedup
from barlake.llm.common import stored, table


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (5): documents they reject go."""
    return quality_rules.filter_documents(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (7): documents it rejects go.

    It learns from the labelled documents of the whole table, as few bad ones get here.
    """
    model = quality_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.filter_documents(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (8): one document of each group stays."""
    return jaccard_join.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def span_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup (6): fine units of repeated spans go, but for the first place of each."""
    return span_dedup.dedup_documents(docs, fine=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (3): the pieces of all documents left."""
    return packing.pack_digest(docs)


#: Near copies share four fifths of their 5-word shingles; op8's own contract (4 words, 0.85) binds its query only.
NEAR_WORDS, NEAR_PERCENT = 5, 80

STAGES = [("quality rules", rules_stage), ("quality classifier", classifier_stage), ("n-gram Jaccard join", near_duplicate_stage),
          ("substring dedup", span_stage), ("packing", packing_stage)]

#: A learned classifier decides a stage, which SQL can't express; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
