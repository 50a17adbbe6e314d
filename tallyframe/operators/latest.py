"""Keep-latest, top-k and preference ranking per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k_by(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key.

    The rank filter is planned as a group limit before the shuffle, so a hot key sends
    at most ``k`` rows per task.
    """
    r = rank or "_rank"
    out = df.withColumn(r, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(r) <= k)
    return out if rank else out.drop(r)


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return top_k_by(df, keys, order, 1)


def latest_flag(df: DataFrame, keys: list[str], order: list[str], flag: str = "is_latest") -> DataFrame:
    """Mark the greatest row per key by ``order`` (which must be unique within a key).

    A map-side combined maximum joined back, instead of a window holding a whole key.
    """
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    joined = df.join(best, keys, "left")
    return joined.withColumn(flag, F.struct(*order) == F.col("_best")).drop("_best")


def attach_group(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Group aggregates next to every row (aggregate window without a full-partition buffer)."""
    return df.join(df.groupBy(*keys).agg(*aggs), keys, "left")
