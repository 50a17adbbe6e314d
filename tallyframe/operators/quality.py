"""Assertions, gap classification and reconciliations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def non_null(df: DataFrame, columns: list[str], relation: str) -> DataFrame:
    """Rows with a NULL per checked column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("subject"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.lit(relation).alias("relation"), F.lit("non_null").alias("assertion"), F.explode(pairs).alias("p")).select(
        "relation", "assertion", "p.*")


def unique_key(df: DataFrame, keys: list[str], relation: str) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(relation).alias("relation"), F.lit("unique_key").alias("assertion"), F.lit(",".join(keys)).alias("subject"), "failures")


def key_constraints(df: DataFrame, keys: list[str], relation: str) -> DataFrame:
    """Non-NULL and uniqueness of a key from one grouping."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    nulls = [F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("n"))), F.lit(0)).alias(k) for k in keys]
    counts = g.agg(*nulls, F.count_if(F.col("n") > 1).alias("_dup"))
    pairs = F.array(
        *[F.struct(F.lit("non_null").alias("assertion"), F.lit(k).alias("subject"), F.col(k).alias("failures")) for k in keys],
        F.struct(F.lit("unique_key").alias("assertion"), F.lit(",".join(keys)).alias("subject"), F.col("_dup").alias("failures")))
    return counts.select(F.lit(relation).alias("relation"), F.explode(pairs).alias("p")).select("relation", "p.*")


def tie_out(lines: DataFrame, headers: DataFrame, keys: list[str], line_amount: str, header_amount: str,
            absolute: str = "0.02", relative: str = "0.001") -> DataFrame:
    """Headers whose lines do not add up to the header amount within the tolerance."""
    sums = lines.groupBy(*keys).agg(F.sum(line_amount).alias("line_total"))
    diff = F.col("line_total") - F.col(header_amount)
    band = F.lit(absolute).cast("decimal(6,2)") + F.lit(relative).cast("decimal(6,3)") * F.abs(F.col(header_amount))
    return sums.join(headers, keys).filter(F.abs(diff) > band).select(
        *keys, F.col("line_total").cast("double").alias("line_total"),
        F.col(header_amount).cast("double").alias("header_total"), diff.cast("double").alias("diff"))


def unbalanced(postings: DataFrame, journal: list[str], amount: str, tolerance: str = "0.02") -> DataFrame:
    """Journals whose postings do not cancel out."""
    return postings.groupBy(*journal).agg(F.sum(amount).alias("balance")).filter(
        F.abs("balance") > F.lit(tolerance).cast("decimal(6,2)"))


def fails_above(violations: DataFrame, threshold: int, out: str) -> DataFrame:
    """One row with the violation count when it exceeds the threshold, else none."""
    return violations.agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > threshold)


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], left_amount: str, right_amount: str) -> DataFrame:
    """Full outer comparison of two pre-aggregated sides; a missing side counts as zero."""
    zero = F.lit(0).cast("decimal(18,2)")
    j = left.join(right, keys, "full_outer")
    return j.withColumn("diff", F.round(F.coalesce(right_amount, zero) - F.coalesce(left_amount, zero), 2))


def classify(rules: list[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds."""
    out = None
    for cond, label in rules:
        out = (F.when if out is None else out.when)(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
