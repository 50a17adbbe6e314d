"""Materialisation, snapshots, raw landing and run manifests (K4-K7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.session import work_path


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a model in full and return the stored relation."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = df.hint("rebalance", *partition_by).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path) if not partition_by else df.sparkSession.read.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result that several branches read to the shared folder.

    Spark only shares a common subplan when every branch needs the same columns and
    filters; a written table is computed once in any case and survives lost executors.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def snapshot_id(kind, run) -> Column:
    """Identity of a snapshot: ``kind|run``."""
    return F.concat_ws("|", kind, run)


def append_snapshots(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Snapshots never change: only identities not seen before are added."""
    return existing.unionByName(new.join(existing.select(key).distinct(), key, "left_anti"))


def land(df: DataFrame, path: str, parts: list[str]) -> None:
    """Append rows below ``part=value`` folders; large folders get several files."""
    df.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def run_manifest(pages: DataFrame, keys: list[str], records: Column, failed: Column, page_cap: int) -> DataFrame:
    """Pages, records and errors per unit, and why it ended; a full cap hints at truncation."""
    return pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pages"), F.sum(records).alias("records"), F.count_if(failed).alias("errors"),
    ).withColumn("termination", F.when(F.col("errors") > 0, "error").when(F.col("pages") >= page_cap, "page_cap").otherwise("exhausted"))
