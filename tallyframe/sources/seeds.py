"""Inline reference relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def seed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small typed relation from literals; an empty list gives a typed empty relation."""
    return spark.createDataFrame(rows, StructType.fromDDL(schema))
