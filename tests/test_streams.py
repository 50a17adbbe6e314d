"""Batches that fail half-way, repeat, and state over a restart."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tallyframe.sinks.upsert import KeyedTable, single_writer
from tallyframe.sinks.versioned import VersionedTable
from tallyframe.streaming import ingest, state
from tallyframe.streaming.ledger import BatchSink

EVENTS = "user int, kind string, at int, v string"


def arrive(spark, folder, rows, name):
    """One file per call, in the order of the calls."""
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    time.sleep(0.02)


def stream(spark, folder, name):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name}")


def test_a_handler_that_died_half_way_doubles_no_row(spark, folder):
    arrive(spark, folder, [(1, "a", 1, "x"), (2, "b", 1, "x"), (3, "odd", 1, "x"), (4, None, 1, "x")], "in")
    arrive(spark, folder, [(5, "a", 1, "x"), (6, "odd", 1, "x")], "in")
    a, b, drift = (BatchSink(f"{folder}/{n}") for n in ("a", "b", "drift"))
    failed = []

    class Failing(BatchSink):
        def __call__(self, df, batch_id):
            if not failed:
                failed.append(batch_id)
                df.write.parquet(f"{self.path}/batch={batch_id}")  # written, but not listed
                raise RuntimeError("drift sink is away")
            super().__call__(df, batch_id)

    for expected in (False, True):
        handler = ingest.route({"a": a, "b": b}, "kind", Failing(drift.path))
        if expected:
            ingest.run_available(stream(spark, folder, "in"), handler, f"{folder}/cp")
        else:
            with pytest.raises(Exception, match="drift sink is away"):
                ingest.run_available(stream(spark, folder, "in"), handler, f"{folder}/cp")
    got = {n: sorted(r["user"] for r in s.read(spark, EVENTS).collect()) for n, s in (("a", a), ("b", b), ("drift", drift))}
    assert got == {"a": [1, 5], "b": [2], "drift": [3, 4, 6]}
    assert a.batches(spark) == [0, 1] and BatchSink(f"{folder}/none").read(spark, EVENTS).count() == 0


def test_latest_per_key_over_a_restart(spark, folder):
    out = BatchSink(f"{folder}/out")
    run = lambda: state.run_latest(stream(spark, folder, "in"), ["user"], ["at"], out, f"{folder}/cp")
    arrive(spark, folder, [(1, "a", 5, "new"), (2, "a", 1, "x"), (None, "a", 1, "x")], "in")
    arrive(spark, folder, [(1, "a", 3, "late in a batch")], "in")
    run()
    arrive(spark, folder, [(1, "a", 4, "late"), (2, "a", 1, "x"), (3, "a", 1, "y")], "in")  # late, repeated, new
    arrive(spark, folder, [(2, "a", 9, "z")], "in")
    run()
    by_batch = [sorted((r["user"], r["v"]) for r in spark.read.schema(EVENTS).parquet(f"{folder}/out/batch={b}").collect()) for b in out.batches(spark)]
    assert [b for b in by_batch if b] == [[(1, "new"), (2, "x")], [(3, "y")], [(2, "z")]]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != state.ROCKSDB


def test_winners_go_into_a_versioned_table(spark, folder):
    table = VersionedTable(f"{folder}/t", ["user"], ["at"], buckets=2)
    for n in range(2):
        arrive(spark, folder, [(k, "a", (k * 3 + n) % 5, f"{n}") for k in range(8)], "in")
        state.run_latest(stream(spark, folder, "in"), ["user"], ["at"], lambda df, b: table.merge(df, "latest", b), f"{folder}/cp")
    want = {k: max(((k * 3 + n) % 5, f"{n}") for n in range(2)) for k in range(8)}
    assert {r["user"]: (r["at"], r["v"]) for r in table.read(spark).collect()} == want


def test_a_dead_writers_lease_is_taken_over(spark, folder):
    lock = f"{folder}/t.lock"
    open(lock, "w").close()
    with pytest.raises(RuntimeError):
        KeyedTable(f"{folder}/t", ["k"], ["at"]).merge(spark.range(1).selectExpr("id as k", "1 as at"))
    os.utime(lock, (time.time() - 3600,) * 2)
    KeyedTable(f"{folder}/t", ["k"], ["at"]).merge(spark.range(1).selectExpr("id as k", "1 as at"))
    assert not os.path.exists(lock)
    with single_writer(spark, lock, lease_seconds=1):
        time.sleep(1.5)  # touched meanwhile, so still held
        with pytest.raises(RuntimeError):
            with single_writer(spark, lock, lease_seconds=1):
                pass
