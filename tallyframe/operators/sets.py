"""Unions: padded, tagged, prioritised, unpivoted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def pad_to(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Select ``schema`` in order, with typed NULLs for columns the relation lacks."""
    have = set(df.columns)
    return df.select(*[
        (F.col(c) if c in have else F.lit(None)).cast(ty).alias(c) for c, ty in schema.items()])


def pad_union(parts: list[DataFrame], schema: dict[str, str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [pad_to(p, schema) for p in parts])


def tagged_union(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [d.withColumn(tag, F.lit(name)) for name, d in parts.items()])


def priority_union(primary: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """Primary rows plus those fallback rows whose key is absent from it."""
    return primary.unionByName(fallback.join(primary.select(*keys), keys, "left_anti"))


def unpivot_pairs(df: DataFrame, keep: list[str], pairs: dict[str, tuple[Column, Column]],
                  side: str, key: str, value: str) -> DataFrame:
    """One row per named (key, value) pair, in a single pass over the input."""
    arr = F.array(*[F.struct(F.lit(n).alias(side), k.alias(key), v.alias(value)) for n, (k, v) in pairs.items()])
    return df.select(*keep, F.explode(arr).alias("_p")).select(*keep, "_p.*")
