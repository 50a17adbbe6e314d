"""As-of lookups and fill-forward over day-grained series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def fill_forward(marked: DataFrame, keys: list[str], day: str, values: list[str]) -> DataFrame:
    """Last non-NULL ``values`` on or before each day, per key (rows: one per key and day)."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    held = F.when(F.col(values[0]).isNotNull(), F.struct(F.col(day).alias("_d"), *values))
    return (
        marked.withColumn("_h", F.last(held, ignorenulls=True).over(w))
        .drop(*values)
        .select("*", F.col("_h._d").alias("held_since"), *[F.col(f"_h.{v}").alias(v) for v in values])
        .drop("_h")
    )


def asof_join(facts: DataFrame, series: DataFrame, keys: list[str], fact_day: str, series_day: str,
              values: list[str]) -> DataFrame:
    """Latest ``values`` on or before ``fact_day``; ``series`` has one row per key and day.

    Only the distinct (key, day) pairs of the facts enter the ordered window, next to the
    series itself: at most two rows per key and calendar day. The result goes back to the
    facts by equi-join.
    """
    need = facts.select(*keys, F.col(fact_day).alias("_day")).distinct()
    have = series.select(*keys, F.col(series_day).alias("_day"), *values)
    marked = need.join(have, [*keys, "_day"], "full_outer")
    resolved = fill_forward(marked, keys, "_day", values)
    resolved = resolved.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_day"), "held_since", *values)
    on = F.col(fact_day) == F.col("_day")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    return facts.join(resolved, on, "left").drop("_day", *[f"_k_{k}" for k in keys])


def date_spine(bounds: DataFrame, lo: str, hi: str, out: str = "calendar_date") -> DataFrame:
    """One row per day between the bounds of a single-row relation."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias(out))
