"""Event-driven ingestion: new files to tables (T1-T3) and selection of what to re-read."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.operators.digests import missing_keys
from tallyframe.sinks.upsert import KeyedTable, path_exists
from tallyframe.sources.pages import page_key_columns, with_sidecar
from tallyframe.streaming.ledger import BatchSink


def new_sidecars(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of arriving sidecars; page bodies and other objects are ignored."""
    return (
        spark.readStream.format("text").schema("value string").option("wholetext", True)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.meta.json")
        .option("maxFilesPerTrigger", files_per_batch).load(f"{root.rstrip('/')}/raw")
        .select(F.col("_metadata.file_path").alias("meta_path"), F.from_json("value", "map<string,string>").alias("meta"))
    )


def pages_of(sidecars: DataFrame, on_missing: Callable[[list[str]], None] | None = None) -> DataFrame:
    """Pages behind a micro-batch of sidecars; only the named files are opened.

    The path list is bounded by the files per batch of the stream. A sidecar whose page is
    absent does not stop the stream: its path goes to ``on_missing`` or into a warning.
    """
    spark = sidecars.sparkSession
    metas = [r[0] for r in sidecars.select("meta_path").collect()]
    if not metas:
        return None
    paths = [m[: -len(".meta.json")] for m in metas]
    paths = [p if p.endswith(".json") else p + ".json" for p in paths]
    with ThreadPoolExecutor(32) as pool:  # waiting for the file system, side by side
        missing = [p for p, there in zip(paths, pool.map(lambda p: path_exists(spark, p), paths)) if not there]
    if missing:
        (on_missing or (lambda lost: warnings.warn(f"pages without a body: {lost}", stacklevel=3)))(missing)
        paths = [p for p in paths if p not in set(missing)]
        if not paths:
            return None
    body = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    return with_sidecar(body.select("*", *page_key_columns(F.col("path"))), sidecars)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Drain what has arrived, batch by batch, and stop."""
    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def keep_latest(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """Batch handler that merges into a keyed table; an older row never replaces a newer one."""

    def handle(batch: DataFrame, _batch_id: int) -> None:
        table.merge(batch)

    return handle


def deliver(sink: Callable, df: DataFrame, batch_id: int) -> None:
    """Hand rows to a sink: one that knows batches gets the number and takes each batch once."""
    if isinstance(sink, BatchSink):
        sink(df, batch_id)
    else:
        sink(df)


def route(parsers: dict[str, Callable], endpoint: str, on_drift: Callable) -> Callable[[DataFrame, int], None]:
    """Batch handler that hands each endpoint's records to its parser and the rest to ``on_drift``.

    A stream repeats a batch whose handler failed half-way. Parsers that append should be a
    :class:`BatchSink`, which takes no batch twice; any other callable gets the rows again and must bear that,
    as the keyed merges do.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for name, parse in parsers.items():
                deliver(parse, held.filter(F.col(endpoint) == name), batch_id)
            deliver(on_drift, held.filter(~F.coalesce(F.col(endpoint).isin(list(parsers)), F.lit(False))), batch_id)
        finally:
            held.unpersist()

    return handle


def lookback_start(as_of: Column, days: int) -> Column:
    """First day of a window of ``days`` days that ends on ``as_of``; one day or less collapses to it."""
    return F.date_sub(as_of, max(days - 1, 0))


def in_window(day: Column, start: Column, end: Column) -> Column:
    """Business-date window, both ends included."""
    return (day >= start) & (day <= end)


def modified_between(keys: list[Column], start: Column | None, end: Column | None) -> Column:
    """Half-open filter on the first present key; rows without one pass only when no end is set."""
    at = F.coalesce(*keys)
    hit = F.lit(True)
    if start is not None:
        hit = hit & (at >= start)
    if end is not None:
        hit = hit & (at < end)
    return F.when(at.isNull(), F.lit(end is None)).otherwise(hit)


def business_between(keys: list[Column], start: Column | None, end: Column | None) -> Column:
    """Half-open filter on the business date; rows without one are dropped."""
    at = F.coalesce(*keys)
    hit = at.isNotNull()
    if start is not None:
        hit = hit & (at >= start)
    if end is not None:
        hit = hit & (at < end)
    return F.coalesce(hit, F.lit(False))


def deleted_keys(table: DataFrame, reread: DataFrame, keys: list[str], inside: Column) -> DataFrame:
    """Rows of the re-read window whose keys a full read of it no longer returns; see ``digests.missing_keys``."""
    return missing_keys(table.filter(inside), reread, keys)
