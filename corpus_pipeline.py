"""From raw documents to a weighted training mixture: each stage applies one text operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkelt.llm import decontam, lines, mixing, quality, simhash
from sparkelt.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; every document stays."""
    return lines.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked by two or fewer differing bits stays."""
    return simhash.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get the rate at which to draw them; those of rate zero go."""
    return mixing.mixture(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_to_targets", mix_to_targets),
]

#: Near-duplicate groups, template trees and fitted rates are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
