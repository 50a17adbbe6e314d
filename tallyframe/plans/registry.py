"""Query registry: operator name -> Spark query and its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.plans import derived
from tallyframe.sources.registry import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register ``fn(tables)`` under ``name``.

    ``uses`` lists the derived relations (space separated) that the oracle text
    refers to; their SQL definitions are put in front of it.
    """

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = derived.with_relations(uses.split(), sql)
        return fn

    return wrap
