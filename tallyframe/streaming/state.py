"""Latest row per key of a stream, held in Spark's state store.

The current winner of each key is the state of a streaming aggregation; a micro-batch reads and
writes the state of its own keys only, and a restart goes on from the checkpoint. Nothing stored
is rewritten: what a batch changes leaves as new rows.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.sinks.upsert import content_hash, fully_keyed

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def winners(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The greatest row of each key by ``order``, then content; of equal rows the one that came first.

    Rows without a full key are left out, as no later row could replace them. ``arrived`` is the time of
    the batch that brought the winner, ``touched`` that of the key's last batch. Rows are compared by
    one struct whose first fields are ``order``; a null is before all values.
    """
    now = F.current_timestamp()
    rest = [c for c in stream.columns if c not in keys and c not in order]
    rank = F.struct(*order, content_hash(stream).alias("_tie"), (-F.unix_micros(now)).alias("_earliest"), *rest)
    kept = stream.filter(fully_keyed(keys)).select(*keys, rank.alias("_row"), F.unix_micros(now).alias("_now"))
    best = kept.groupBy(*keys).agg(F.max("_row").alias("_row"), F.max("_now").alias("touched"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [*order, *rest]], (-F.col("_row._earliest")).alias("arrived"), "touched")


@contextmanager
def _store_provider(spark: SparkSession, provider: str):
    """A query takes the provider that is set when it starts and keeps it in its checkpoint."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, provider)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def run_latest(stream: DataFrame, keys: list[str], order: list[str], emit: Callable[[DataFrame, int], None], checkpoint: str,
               provider: str = ROCKSDB) -> StreamingQuery:
    """Drain what has arrived; ``emit`` gets, batch by batch, the new rows of the keys whose winner changed.

    A repeated batch gives the same rows, so ``emit`` should be a sink that knows batch numbers
    (:class:`~tallyframe.streaming.ledger.BatchSink`, or ``VersionedTable.merge`` with a writer's name).
    """

    def changed(batch: DataFrame, batch_id: int) -> None:
        emit(batch.filter("arrived = touched").drop("arrived", "touched"), batch_id)

    with _store_provider(stream.sparkSession, provider):
        q = (winners(stream, keys, order).writeStream.outputMode("update").foreachBatch(changed)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
