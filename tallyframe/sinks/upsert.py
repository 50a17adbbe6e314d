"""Keyed upserts (K1, K2, K3, K8) and the table they maintain."""

from __future__ import annotations

import threading
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyframe.operators.latest import latest_by


def fully_keyed(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def content_hash(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """Hash of a row's columns that can be hashed; settles ties alike in every run."""
    plain = [c for c, kind in df.dtypes if c not in without and not kind.startswith(("map", "variant")) and "variant" not in kind and "map<" not in kind]
    return F.xxhash64(*plain)


def collapse(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the latest by ``order``, ties by content; rows lacking a key column stay as they are."""
    full = fully_keyed(keys)
    tie = [F.desc(content_hash(batch, tuple(order)))]
    one = latest_by(batch.filter(full), keys, [*[F.desc_nulls_last(c) for c in order], *tie])
    return one.unionByName(batch.filter(~full))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target after the batch: latest row per key across all time, the batch wins ties.

    One pass over the union does the batch collapse and the merge together. Columns only
    one side has are NULL on the other.
    """
    both = target.withColumn("_arrival", F.lit(0)).unionByName(
        batch.withColumn("_arrival", F.lit(1)), allowMissingColumns=True)
    return collapse(both, keys, [*order, "_arrival"]).drop("_arrival")


def merge_outcome(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Counts of inserted, updated, unchanged and outdated keys of a batch, with an anomaly flag."""
    b = collapse(batch, keys, order).select(*keys, F.struct(*order).alias("_b"))
    t = target.select(*keys, F.struct(*order).alias("_t"))
    j = b.join(t, keys, "left")
    outcome = (F.when(F.col("_t").isNull(), "inserted").when(F.col("_b") > F.col("_t"), "updated")
               .when(F.col("_b") == F.col("_t"), "unchanged").otherwise("outdated"))
    return j.agg(
        F.count(F.lit(1)).alias("batch_keys"),
        *[F.count_if(outcome == o).alias(o) for o in ("inserted", "updated", "unchanged", "outdated")],
    ).select("*", ((F.col("batch_keys") > 0) & (F.col("inserted") == F.col("batch_keys"))).alias("all_inserted"),
             ((F.col("inserted") + F.col("updated")) == 0).alias("nothing_changed"))


def payload_hash(df: DataFrame, keys: list[str]) -> Column:
    rest = [c for c in df.columns if c not in keys]
    return F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256)


def conflicting_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur with different payloads."""
    return (
        df.select(*keys, payload_hash(df, keys).alias("_h")).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"), F.count_distinct("_h").alias("variants"))
        .filter("variants > 1")
    )


def null_safe_merge(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Replace matching rows, add the rest; NULL key parts match NULL."""
    b = batch.select(*[F.col(k).alias(f"_b_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    return target.join(b, on, "left_anti").unionByName(batch, allowMissingColumns=True)


def strict_load(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Loader merge: identical duplicates collapse, missing keys and conflicts are errors."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull() | (F.col(k).cast("string") == "")
    if not batch.filter(missing).isEmpty():
        raise ValueError(f"batch has rows without a value in {keys}")
    if not conflicting_duplicates(batch, keys).isEmpty():
        raise ValueError(f"batch has different payloads for the same {keys}")
    return null_safe_merge(target, batch.dropDuplicates(keys), keys)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


@contextmanager
def single_writer(spark: SparkSession, lock: str, lease_seconds: float = 900):
    """Hold a lock file, whose creation is atomic; raise if another writer has it.

    The holder touches the file again and again. A file that was not touched for ``lease_seconds`` belongs to
    a writer that died and is taken over, by a rename that only one of several can make.
    """
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(lock)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > lease_seconds:
        stale = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{lock}.{uuid.uuid4().hex}")
        if fs.rename(p, stale):
            fs.delete(stale, False)
    if fs.exists(p) or not fs.createNewFile(p):
        raise RuntimeError(f"another merge holds {lock}")
    ended = threading.Event()

    def touch() -> None:
        while not ended.wait(lease_seconds / 10):
            fs.setTimes(p, int(time.time() * 1000), -1)

    beat = threading.Thread(target=touch, daemon=True)
    beat.start()
    try:
        yield
    finally:
        ended.set()
        beat.join()
        fs.delete(p, False)


@dataclass(frozen=True)
class KeyedTable:
    """Parquet table holding one current row per key, spread over key buckets.

    A merge rewrites only what the batch touches: those folders are read, merged with
    :func:`upsert` and overwritten through Spark's staged partition commit. Splitting by
    ``split_by`` (part of the key, e.g. the tenant) keeps a batch of one tenant away from
    the folders of the others; size ``buckets`` so that a folder holds about one task's
    work. The first merge stores keys and bucket count with the table, and a later merge
    with others is refused. Rows with a NULL key part are kept as they come, but not
    once more when a batch is replayed; ``loose`` counts them. One writer at a time: a merge holds a
    lease and refuses to start while another one does. A batch that touches every folder rewrites them all;
    :class:`~tallyframe.sinks.versioned.VersionedTable` writes only the batch.
    A declared ``schema`` saves reading the footers of all files to find the columns.
    """

    path: str
    keys: list[str]
    order: list[str]
    buckets: int = 64
    split_by: list[str] = field(default_factory=list)
    schema: StructType | None = None

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self.path)

    def _placed(self, df: DataFrame) -> DataFrame:
        # the leading letter keeps folder names from being read back as numbers or dates
        split = F.concat_ws("|", F.lit("k"), *[F.col(c).cast("string") for c in self.split_by])
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.withColumn("_split", split).withColumn("_bucket", bucket)

    def _stored(self, spark: SparkSession) -> DataFrame:
        if self.schema is None:
            return spark.read.option("mergeSchema", "true").parquet(self.path)
        placed = StructType([*self.schema.fields, StructField("_split", StringType()), StructField("_bucket", IntegerType())])
        return spark.read.schema(placed).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop("_split", "_bucket")

    def _write(self, df: DataFrame) -> None:
        (df.hint("rebalance", "_split", "_bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_split", "_bucket").parquet(self.path))

    def loose(self, spark: SparkSession) -> int:
        """Stored rows without a full key."""
        t = self.read(spark)
        return t.filter(~fully_keyed(self.keys)).count()

    def _check_layout(self, spark: SparkSession) -> None:
        """Store keys and bucket count, or compare them with the stored ones."""
        path, own = f"{self.path}/_layout", f"{','.join(self.keys)}|{','.join(self.split_by)}|{self.buckets}"
        if path_exists(spark, path):
            held = spark.read.schema("layout string").json(path).first()[0]
            if held != own:
                raise ValueError(f"{self.path} is laid out as {held}, not as {own}")
        else:
            spark.range(1).select(F.lit(own).alias("layout")).coalesce(1).write.json(path)

    def _without_replays(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """New rows, but of those without a full key only the ones not stored yet."""
        full = fully_keyed(self.keys)
        plain = [c for c in new.columns if c in old.columns]
        stored = old.filter(~fully_keyed(self.keys)).select(content_hash(old.select(*plain)).alias("_content"))
        loose = new.filter(~full).withColumn("_content", content_hash(new.select(*plain)))
        return new.filter(full).unionByName(loose.join(stored, "_content", "left_anti").drop("_content"))

    def merge(self, batch: DataFrame) -> None:
        spark = batch.sparkSession
        with single_writer(spark, f"{self.path}.lock"):
            self._merge(spark, batch)

    def _merge(self, spark: SparkSession, batch: DataFrame) -> None:
        new = self._placed(batch)
        keys = [*self.keys, "_split", "_bucket"]
        if not self.exists(spark):
            self._write(collapse(new, keys, self.order))
            if self.exists(spark):
                self._check_layout(spark)
            return
        self._check_layout(spark)
        # read twice, for the folders and for the merge; lost parts are recomputed
        held = new.persist()
        try:
            # folder names only: at most splits x buckets of them; they prune what is read
            touched: dict[str, set[int]] = {}
            for split, bucket in held.select("_split", "_bucket").distinct().collect():
                touched.setdefault(split, set()).add(bucket)
            if touched:
                inside = F.lit(False)
                for split, buckets in sorted(touched.items()):
                    inside = inside | ((F.col("_split") == split) & F.col("_bucket").isin(sorted(buckets)))
                old = self._stored(spark).filter(inside)
                self._write(upsert(old, self._without_replays(old, held), keys, self.order))
        finally:
            held.unpersist()
