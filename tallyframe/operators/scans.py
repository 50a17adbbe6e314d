"""Running values over keys of any size: ordered scans in two passes.

A window function holds a whole key in one task. Here the distinct (key, order) positions are dealt
into contiguous ranges, a hot key over many of them; each range is scanned by itself, and what a
range must add from the earlier ranges of its key comes from a table of range totals. Only keys that
reach over a range's end need one: with ranges in order these are fewer than there are ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.sinks.tables import stored

#: How a value of earlier ranges and one of this range make one.
_JOIN = {
    "sum": lambda before, own: F.when(before.isNull(), own).when(own.isNull(), before).otherwise(before + own),
    "max": lambda before, own: F.greatest(before, own),
    "min": lambda before, own: F.least(before, own),
    "last": lambda before, own: F.coalesce(own, before),
}


def _over(kind: str, column: Column, window) -> Column:
    value = F.last(column, ignorenulls=True) if kind == "last" else getattr(F, kind)(column)
    return value.over(window)


def running(positions: DataFrame, keys: list[str], order: str, values: dict[str, tuple[str, str]], before: bool = False,
            ranges: int | None = None) -> DataFrame:
    """Add running values to ``positions``, which has one row per key and ``order``.

    ``values`` maps new columns to (sum, max, min or last, column); nulls are passed over. The frame ends with
    the row itself, or before it with ``before``. NULL key parts make a key like any other.
    """
    spark = positions.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = positions.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys], F.col(order).asc_nulls_first())
    # written, as the bounds of the ranges come from samples and must not change between the passes
    dealt = stored(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("_range", *keys).orderBy(F.col(order).asc_nulls_first())
    frame = own.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    local = dealt.withColumns({out: _over(kind, F.col(c), frame) for out, (kind, c) in values.items()})

    totals = {f"_t_{out}": (F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))) if kind == "last" else getattr(F, kind)(c)).alias(f"_t_{out}")
              for out, (kind, c) in values.items()}
    total = dealt.groupBy("_range", *keys).agg(*totals.values())
    # the keys at the ends of a range: at most two per range can go on in another one
    ends = dealt.groupBy("_range").agg(F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi"))
    split = ends.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("k")).groupBy("k").count().filter("count > 1")
    split = split.select(*[F.col(f"k.{k}").alias(f"_s_{k}") for k in keys])
    same = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        same = term if same is None else same & term
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = total.join(F.broadcast(split), same, "left_semi")  # fewer rows than ranges
    carry = carry.select(F.col("_range").alias("_c_range"), *[F.col(k).alias(f"_c_{k}") for k in keys],
                         *[_over(kind, F.col(f"_t_{out}"), earlier).alias(f"_c_{out}") for out, (kind, _) in values.items()])
    on = F.col("_range") == F.col("_c_range")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    joined = local.join(F.broadcast(carry), on, "left")  # at most two rows per range
    added = {out: _JOIN[kind](F.col(f"_c_{out}"), F.col(out)) for out, (kind, _) in values.items()}
    return joined.withColumns(added).select(*positions.columns, *values)


def running_sum(df: DataFrame, keys: list[str], order: str, value: str, out: str, **options) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys ORDER BY order)`` with its default frame: rows of equal order share a value."""
    at = df.groupBy(*keys, order).agg(F.sum(value).alias("_value"))
    done = running(at, keys, order, {out: ("sum", "_value")}, **options)
    done = done.select(*[F.col(c).alias(f"_r_{c}") for c in [*keys, order]], out)
    on = None
    for c in [*keys, order]:
        term = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        on = term if on is None else on & term
    return df.join(done, on).drop(*[f"_r_{c}" for c in [*keys, order]])


def merge_moments(df: DataFrame, keys: list[str], start: str, end: str, **options) -> DataFrame:
    """Disjoint intervals per key for bounds of any grain, as timestamps; touching intervals are one.

    ``merge_intervals`` of days folds equal days first, which bounds a key by the calendar; with moments
    nothing bounds it, so both scans go over ranges.
    """
    at = df.groupBy(*keys, start).agg(F.max(end).alias(end), F.count(F.lit(1)).alias("interval_count"))
    reach = running(at, keys, start, {"_reach": ("max", end)}, before=True, **options)
    breaks = reach.withColumn("_break", F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0)).drop("_reach")
    islands = running(breaks, keys, start, {"_island": ("sum", "_break")}, **options)
    return islands.groupBy(*keys, "_island").agg(
        F.min(start).alias(start), F.max(end).alias(end), F.sum("interval_count").alias("interval_count")).drop("_island")


def predecessor_lookup(facts: DataFrame, bands: DataFrame, bucket: str, value: str, band_bucket: str, low: str, high: str,
                       how: str = "left", **options) -> DataFrame:
    """Attach the band of the row's bucket whose closed range holds ``value``; bands of a bucket must not overlap.

    The band is the last one that starts at or below the value. Distinct values and band starts are scanned
    together, so the work grows with rows plus bands, however many bands a bucket has.
    """
    take = F.struct(*bands.columns)
    starts = bands.filter(F.col(band_bucket).isNotNull()).select(
        F.col(band_bucket).alias("_b"), F.col(low).alias("_v"), take.alias("_band"), F.lit(False).alias("_asked"))
    points = facts.select(F.col(bucket).alias("_b"), F.col(value).alias("_v")).filter("_b IS NOT NULL AND _v IS NOT NULL").distinct()
    points = points.select("_b", "_v", F.lit(None).cast(starts.schema["_band"].dataType).alias("_band"), F.lit(True).alias("_asked"))
    at = starts.unionByName(points).groupBy("_b", "_v").agg(F.max_by("_band", F.when(F.col("_band").isNotNull(), 1)).alias("_band"), F.max("_asked").alias("_asked"))
    held = running(at, ["_b"], "_v", {"_held": ("last", "_band")}, **options).filter("_asked")
    held = held.filter(F.col("_v") <= F.col(f"_held.{high}")).select("_b", "_v", "_held")
    out = facts.join(held, (F.col(bucket) == F.col("_b")) & (F.col(value) == F.col("_v")), how)
    return out.select(*facts.columns, *[F.col(f"_held.{c}").alias(c) for c in bands.columns])
