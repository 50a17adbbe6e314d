"""Numeric expressions with warehouse NULL semantics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def money(x, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal, so that sums do not depend on the order of addition."""
    return _c(x).cast(f"decimal({precision},{scale})")


def strict_greatest(*cols) -> Column:
    """Largest value, NULL as soon as one argument is NULL."""
    cs = [_c(c) for c in cols]
    missing = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(~missing, F.greatest(*cs))


def strict_least(*cols) -> Column:
    cs = [_c(c) for c in cols]
    missing = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(~missing, F.least(*cs))


def safe_divide(a, b) -> Column:
    return F.try_divide(_c(a), _c(b))


def rate(x) -> Column:
    """Exchange rate narrow enough that a product with money keeps its scale."""
    return _c(x).cast("decimal(18,6)")


def converted(amount, rate_col) -> Column:
    """amount x rate as decimal(20,2); NULL when either side is missing."""
    return (_c(amount).cast("decimal(18,2)") * rate(rate_col)).cast("decimal(20,2)")


def as_double(x) -> Column:
    return _c(x).cast("double")


def sum_money(x, alias: str) -> Column:
    """Exact money sum, presented as double."""
    return F.sum(money(x)).cast("double").alias(alias)
