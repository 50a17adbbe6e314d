"""Validity windows, interval merging and range ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def windows_from_dates(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Close each window the day before the next start; the last one stays open.

    Expects one row per key and start day, which bounds a key to one row per calendar day.
    """
    w = Window.partitionBy(*keys).orderBy(start)
    return df.withColumn(end, F.date_sub(F.lead(start).over(w), 1))


def previous_max_end(df: DataFrame, keys: list[str], start: str, end: str, out: str = "prev_max_end") -> DataFrame:
    """Greatest end of all earlier intervals of the key, after folding equal starts.

    Folding to one row per start day happens map-side; what reaches the window is at
    most one row per calendar day and key, whatever the number of source rows.
    """
    days = df.groupBy(*keys, start).agg(F.max(end).alias(end), F.count(F.lit(1)).alias("interval_count"))
    w = Window.partitionBy(*keys).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    return days.withColumn(out, F.max(end).over(w))


def island_ids(df: DataFrame, keys: list[str], start: str, end: str, gap_days: int = 1,
               out: str = "island_id") -> DataFrame:
    """Number the islands of overlapping or near-adjacent intervals per key."""
    d = previous_max_end(df, keys, start, end)
    is_break = F.col("prev_max_end").isNull() | (F.col(start) > F.date_add("prev_max_end", gap_days))
    w = Window.partitionBy(*keys).orderBy(start).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return d.withColumn(out, F.sum(F.when(is_break, 1).otherwise(0)).over(w))


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str, gap_days: int = 1) -> DataFrame:
    """Disjoint intervals per key; gaps up to ``gap_days`` are closed."""
    return (
        island_ids(df, keys, start, end, gap_days)
        .groupBy(*keys, "island_id")
        .agg(F.min(start).alias(start), F.max(end).alias(end),
             F.sum("interval_count").alias("interval_count"))
    )


def breakpoint_ranges(df: DataFrame, keys: list[str], start: str, end: str, cap) -> DataFrame:
    """Turn a breakpoint list into closed integer ranges, the last one ending at ``cap``."""
    w = Window.partitionBy(*keys).orderBy(start)
    return df.withColumn(end, F.coalesce(F.lead(start).over(w) - 1, cap))
