"""Aligned day ranges: windows and days meet by equality on spans of 1, 4, 16, ... days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: 2^22 days from year 1 reach past year 9999.
LEVELS = 22
_STEPS = f"sequence(0, {LEVELS}, 2)"  # a span holds four of the next smaller ones
_SPAN = f"shiftleft(1, {LEVELS} - j) + "


def day_number(day) -> Column:
    """Days since 0001-01-01, within the spans."""
    return F.greatest(F.lit(0), F.datediff(day, F.lit("0001-01-01").cast("date")))


def spans_of_day(number: str) -> Column:
    """All aligned spans that hold a day: one per size."""
    return F.expr(f"transform({_STEPS}, j -> {_SPAN} shiftright({number}, j))")


def spans_of_range(first: str, last: str) -> Column:
    """The fewest aligned spans that make up a closed range: three per size at either end at most, none for an empty range.

    At each size, what is left of the range after whole larger spans is less than one of these at either end.
    """
    left, right = f"shiftright({first} + shiftleft(1, j) - 1, j)", f"shiftright({last} + 1, j)"
    inner_left, inner_right = f"shiftleft(shiftright({left} + 3, 2), 2)", f"shiftleft(shiftright({right}, 2), 2)"
    def places(a: str, b: str) -> str:
        return f"if({left} < {right} and {a} < {b}, sequence({a}, {b} - 1), array())"
    ends = f"concat({places(left, f'least({inner_left}, {right})')}, {places(f'greatest({inner_right}, {inner_left})', right)})"
    return F.expr(f"flatten(transform({_STEPS}, j -> transform({ends}, x -> {_SPAN} x)))")


def spread(windows: DataFrame, start: str, end: str, span: str = "_span") -> DataFrame:
    """One row per span of each window; a NULL end is open, a NULL start makes no window."""
    top = F.lit((1 << LEVELS) - 1)
    numbered = windows.filter(F.col(start).isNotNull()).withColumns({
        "_first": day_number(start), "_last": F.when(F.col(end).isNull(), top).otherwise(day_number(end))})
    return numbered.withColumn(span, F.explode(spans_of_range("_first", "_last"))).drop("_first", "_last")


def covering(pairs: DataFrame, windows: DataFrame, keys: list[str], day: str, start: str, end: str) -> DataFrame:
    """``keys``, ``day`` and the window's other columns for every window of the key that covers the day.

    A window covers a day exactly if one of its spans holds it, and then one only: an equi-join, without a
    condition on the range. It is a merge join, as Spark takes either side for as small as it was before
    its rows were multiplied and would send it through the driver.
    """
    days = pairs.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col(day).alias("_p_day"), day_number(day).alias("_n"))
    days = days.filter("_p_day IS NOT NULL").withColumn("_p_span", F.explode(spans_of_day("_n"))).drop("_n")
    on = F.col("_p_span") == F.col("_span")
    for k in keys:
        on = on & (F.col(f"_p_{k}") == F.col(k))
    return days.join(spread(windows, start, end).hint("merge"), on).drop("_span", "_p_span", *keys)
