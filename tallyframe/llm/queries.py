"""One query per corpus operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm import bagminhash, ball_tree, chat, compact_windows, decontaminate, line_dedup, lookup_kmeans, mixing, pairwise_rank, quality_rules, suffix, suffix_tree_lm, toxicity
from tallyframe.llm.rows import held_out, sha256_hex, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored(quality_rules.measured(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), F.expr("* except (row)")), "measured")
    return m.withColumn("posterior", quality_rules.posterior(quality_rules.learn(m))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", sha256_hex("kept").alias("kept_sha256"))


ORACLES["op2_line_dedup"] = line_dedup.ORACLE


@query
def op5_pairwise_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pairwise_rank.learn(docs, table(spark, sf_dir, "labels"))
    return pairwise_rank.scored(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= pairwise_rank.CUT).cast("int").alias("predicted"))


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("did", "doc_id").drop("thash")


@query
def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(table(spark, sf_dir, "documents"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("thash")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.linked(table(spark, sf_dir, "conversations"))


ORACLES["op3_chat"] = chat.ORACLE


@query
def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.passages(table(spark, sf_dir, "documents"))


@query
def op12_lookup_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_kmeans.clustered(table(spark, sf_dir, "embeddings"))


ORACLES["op12_lookup_kmeans"] = lookup_kmeans.ORACLE


@query
def op13_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_ball_tree"] = ball_tree.ORACLE


@query
def op11_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.scored(table(spark, sf_dir, "documents"))
