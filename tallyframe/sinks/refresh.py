"""Materialised models that are refreshed by the tenants that changed (K4)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sinks.upsert import path_exists
from tallyframe.sinks.versioned import VersionedTable


@dataclass(frozen=True)
class RefreshedModel:
    """A model over the splits (such as tenants) of a versioned table, one folder per split.

    ``part`` turns the rows of some splits, which carry ``_split``, into the model's rows for these splits. A
    model that spans splits keeps partial aggregates in its parts and puts them together in ``finish``.
    A refresh takes the snapshots of the last refresh and of now, recomputes only splits with a folder
    that differs, and overwrites only their folders.
    """

    path: str
    source: VersionedTable
    part: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame] | None = None

    def _mark(self, number: int) -> str:
        return f"{self.path}/_refreshed/{number:020d}"

    def last(self, spark: SparkSession) -> int | None:
        """Number of the source's snapshot that the model shows."""
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_refreshed")
        if not path_exists(spark, f"{self.path}/_refreshed"):
            return None
        return max(int(s.getPath().getName()) for s in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder))

    def refresh(self, spark: SparkSession) -> list[str]:
        """Bring the model up to the newest snapshot; returns the splits that were recomputed.

        Repeating a refresh that failed half-way writes the same folders again.
        """
        now = self.source.versions(spark)[-1]
        changed = self.source.changed_splits(spark, self.last(spark), now)
        if changed:
            rows = self.part(self.source.read_splits(spark, changed, now))
            (rows.hint("rebalance", "_split").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_split").parquet(f"{self.path}/parts"))
        mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._mark(now))
        mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(mark, True).close()
        return changed

    def read(self, spark: SparkSession) -> DataFrame:
        schema = self.part(self.source.read_splits(spark, [], self.last(spark))).schema
        parts = spark.read.schema(schema).parquet(f"{self.path}/parts")
        return self.finish(parts) if self.finish else parts.drop("_split")

