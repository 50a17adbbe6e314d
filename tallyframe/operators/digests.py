"""Comparing two large key sets by digests of buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BUCKETS = 65_536


def bucketed(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``_hash`` of the columns and the ``_bucket`` it falls into."""
    return df.withColumn("_hash", F.xxhash64(*columns)).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))


def digests(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket: how many rows, and two sums of their hashes that do not depend on their order.

    Summed before the shuffle, so a task sends at most one row per bucket. May be kept with a table
    and added to, as counts and sums of disjoint row sets add up.
    """
    h = bucketed(df.select(*columns), columns, buckets)
    return h.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_hash").alias("folded"), F.sum(F.col("_hash").cast("decimal(38,0)")).alias("total"))


def differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """``_bucket`` of the digests that are not equal: at most as many rows as there are buckets."""
    a, b = (d.select("_bucket", F.struct("n", "folded", "total").alias(name)) for d, name in ((ours, "_a"), (theirs, "_b")))
    return a.join(b, "_bucket", "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("_bucket")


def missing_keys(table: DataFrame, other: DataFrame, keys: list[str], buckets: int = BUCKETS, known: DataFrame | None = None) -> DataFrame:
    """Rows of ``table`` whose keys ``other`` does not have.

    Only rows of differing buckets are compared one by one. ``known`` may give the digests of the table if these
    are kept. Keys of ``table`` must be unique, those of ``other`` are made so; NULL key parts match NULL.
    """
    theirs = other.select(*keys).distinct()
    odd = F.broadcast(differing(digests(table, keys, buckets) if known is None else known, digests(theirs, keys, buckets)))
    ours = bucketed(table, keys, buckets).join(odd, "_bucket", "left_semi").drop("_hash", "_bucket")
    rest = bucketed(theirs, keys, buckets).join(odd, "_bucket", "left_semi").select(*[F.col(k).alias(f"_o_{k}") for k in keys])
    same = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"_o_{k}"))
        same = term if same is None else same & term
    return ours.join(rest, same, "left_anti")
