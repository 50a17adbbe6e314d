"""Append sinks that take each micro-batch once.

A stream repeats a batch whose handler did not return, so a plain append doubles what it had
already written. A :class:`BatchSink` gives every batch a folder of its own, which a repeated write
replaces, and lists a batch in its ledger only after the folder is complete. Readers see the listed
batches alone; a listed batch is not written again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyframe.sinks.upsert import path_exists


@dataclass(frozen=True)
class BatchSink:
    """Folder of batches below ``path``; call it with a DataFrame and the number of its batch."""

    path: str

    def _entry(self, batch_id: int) -> str:
        return f"{self.path}/_ledger/{batch_id:020d}"

    def has(self, spark: SparkSession, batch_id: int) -> bool:
        return path_exists(spark, self._entry(batch_id))

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if self.has(spark, batch_id):
            return
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/batch={batch_id}")
        entry = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._entry(batch_id))
        # an empty file; that it exists is all it says
        entry.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(entry, True).close()

    def batches(self, spark: SparkSession) -> list[int]:
        """Numbers of the listed batches."""
        if not path_exists(spark, f"{self.path}/_ledger"):
            return []
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_ledger")
        return sorted(int(s.getPath().getName()) for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p))

    def read(self, spark: SparkSession, schema: StructType | str) -> DataFrame:
        """Rows of all listed batches."""
        paths = [f"{self.path}/batch={b}" for b in self.batches(spark)]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*paths)
