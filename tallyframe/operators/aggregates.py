"""Aggregations that stay bounded per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.operators.latest import top_k_by


def distinct_samples(df: DataFrame, keys: list[str], value: str, n: int, out: str, sep: str = " | ") -> DataFrame:
    """The ``n`` smallest distinct values per group as one text.

    Values are made distinct and cut to ``n`` per group before anything is collected, so
    no group holds more than ``n`` values.
    """
    few = top_k_by(df.filter(F.col(value).isNotNull()).select(*keys, value).distinct(), keys, [F.asc(value)], n)
    return few.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(value)), sep).alias(out))


def only_value(value) -> Column:
    """The value if all non-NULL values of the group agree, else NULL."""
    return F.when(F.min(value) == F.max(value), F.min(value))


def first_non_null(value, *order) -> Column:
    """Non-NULL value with the greatest ``order``."""
    v = value if isinstance(value, Column) else F.col(value)
    return F.max_by(v, F.when(v.isNotNull(), F.struct(*order)))


def signed_sum(amount: Column, negative: Column) -> Column:
    return F.sum(F.when(negative, -amount).otherwise(amount))


def sum_when(cond: Column, amount: Column) -> Column:
    return F.sum(F.when(cond, amount))


def wide_by_type(df: DataFrame, keys: list[str], type_col: str, types: list[str], value: Column, suffix: str) -> DataFrame:
    """Child rows to one column per type; the value list is given, so no extra job finds it."""
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col(type_col) == x, value)).alias(f"{x}_{suffix}") for x in types])
