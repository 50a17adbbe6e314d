"""Surrogate and readable keys from natural keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _s(x) -> Column:
    return (x if isinstance(x, Column) else F.col(x)).cast("string")


def readable_key(*parts) -> Column:
    """``a|b|c``; NULL if any part is NULL."""
    cols = [_s(parts[0])]
    for p in parts[1:]:
        cols += [F.lit("|"), _s(p)]
    return F.concat(*cols)


def surrogate_key(*parts) -> Column:
    """64-bit integer key from the md5 of the readable key; NULL if any part is NULL.

    Equal keys are rare but possible among billions of rows: join facts on the natural key.
    """
    digest = F.md5(readable_key(*parts))
    high, low = (F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") for at in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)
