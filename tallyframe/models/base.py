"""Model lookup: a model is a function that asks a source for the relations it reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyframe.sinks.upsert import path_exists


class Warehouse:
    """Relations by name: given tables first, models otherwise, each model planned once."""

    def __init__(self, tables: Callable[[str], DataFrame], models: dict[str, Callable[["Warehouse"], DataFrame]]):
        self._tables = tables
        self._models = models
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A staging or bronze table."""
        return self._tables(name)

    def optional(self, name: str) -> DataFrame | None:
        """A staging or bronze table, or nothing where that source is not loaded."""
        try:
            return self._tables(name)
        except (KeyError, AnalysisException):
            return None

    def model(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._models[name](self)
        return self._built[name]

    def hold(self, name: str, relation: DataFrame) -> None:
        """Use a stored copy of a model, so that everything above reads it instead of replanning it."""
        self._built[name] = relation


def stored_tables(spark: SparkSession, root: str, schemas: dict[str, StructType] | None = None) -> Callable[[str], DataFrame]:
    """Staging tables as written by the keyed merges; a table without files yet is empty."""

    def read(name: str) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        known = (schemas or {}).get(name)
        if known is None:
            return spark.read.option("mergeSchema", "true").parquet(path).drop("_split", "_bucket")
        return spark.read.schema(known).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], known)

    return read
