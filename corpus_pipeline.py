"""The corpus pipeline: rules, line dedup, near-duplicates, benchmark, mix.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before it kept and returns
the columns of documents; the last adds ``mix_rate``, the times to draw each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import bagminhash, decontaminate, line_dedup, mixing, quality_rules
from tallyframe.llm.rows import stored, table


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.apply(docs)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.apply(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.apply(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.apply(docs, table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality_rules", keep_by_rules),
    ("line_dedup", drop_common_lines),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mix_to_targets),
]

#: Classifier and projected gradient are not SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
