"""Pages and sidecars landed in matching key buckets, so that they meet without moving a page body."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.session import work_path
from tallyframe.sources.pages import body_path


@dataclass(frozen=True)
class BucketedLanding:
    """Two tables of the session's catalog over files below ``path``, both bucketed and sorted by the object key without suffix.

    Writing deals the rows of each task into bucket files, without a shuffle. Joins of the two tables read
    bucket next to bucket. The tables are dropped with :meth:`drop`, their files stay.
    """

    path: str
    buckets: int
    name: str

    @classmethod
    def create(cls, pages: DataFrame, sidecars: DataFrame, buckets: int, path: str | None = None) -> "BucketedLanding":
        """Land ``pages`` (``path`` and any columns) and ``sidecars`` (``meta_path``, ``meta``)."""
        made = cls(path or work_path(pages.sparkSession, "bucketed-landing"), buckets, f"landing_{uuid.uuid4().hex}")
        made._write(pages.withColumn("_stem", F.regexp_replace("path", r"\.json$", "")), "pages")
        made._write(sidecars.withColumn("_stem", F.regexp_replace(body_path("meta_path"), r"\.json$", "")), "sidecars")
        return made

    def _write(self, df: DataFrame, kind: str) -> None:
        df.write.bucketBy(self.buckets, "_stem").sortBy("_stem").option("path", f"{self.path}/{kind}").saveAsTable(f"{self.name}_{kind}")

    def pages(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_pages")

    def sidecars(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_sidecars")

    def joined(self, spark: SparkSession) -> DataFrame:
        """Each page with its sidecar; a page without one is left out, as in ``with_sidecar``."""
        return self.pages(spark).join(self.sidecars(spark).hint("merge"), "_stem").drop("_stem")

    def drop(self, spark: SparkSession) -> None:
        for kind in ("pages", "sidecars"):
            spark.sql(f"DROP TABLE IF EXISTS {self.name}_{kind}")
