import pathlib
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.sinks import upsert as up
from tallyframe.sinks.versioned import VersionedTable, wider

SCHEMA = "k int, v string, at int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def size(folder):
    return sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*.parquet"))


def test_runs_equal_the_merge_in_memory(spark, folder):
    """Late, equal and new rows over several batches, before and after compaction, with compaction in between."""
    table = VersionedTable(f"{folder}/t", ["k"], ["at"], buckets=3)
    plain = None
    for b in range(6):
        rows = [(k, f"{b}-{k}", (k * 7 + b * 5) % 11) for k in range(b, 60, b + 1)]
        batch = spark.createDataFrame(rows, SCHEMA)
        table.merge(batch)
        plain = up.collapse(batch, ["k"], ["at"]) if plain is None else up.upsert(plain, batch, ["k"], ["at"])
        if b == 3:
            assert table.compact(spark) == 3
    want = rows_of(plain)
    assert rows_of(table.read(spark)) == want and len(table.snapshot(spark).deltas) == 2
    assert table.compact(spark) == 3 and not table.snapshot(spark).deltas
    assert rows_of(table.read(spark)) == want and table.compact(spark) == 0


def test_a_small_batch_writes_little(spark, folder):
    table = VersionedTable(f"{folder}/t", ["k"], ["at"], buckets=4)
    table.merge(spark.range(200_000).selectExpr("cast(id as int) k", "md5(string(id)) v", "1 at"))
    table.compact(spark)
    before = size(folder)
    table.merge(spark.range(2000).selectExpr("cast(id * 97 as int) k", "md5(string(id)) v", "2 at"))
    assert size(folder) - before < 0.05 * before / 2  # run and base of the first batch both lie there
    assert table.read(spark).where("at = 2").count() == 2000 and table.read(spark).count() == 200_000


def test_replays_change_nothing(spark, folder):
    table = VersionedTable(f"{folder}/t", ["k"], ["at"], buckets=2)
    batch = spark.createDataFrame([(1, "a", 1), (None, "x", 1), (None, "x", 1), (None, "y", 1)], SCHEMA)
    assert table.merge(batch, "stream", 0)
    assert not table.merge(batch, "stream", 0) and table.versions(spark) == [1]
    want = rows_of(batch)
    table.merge(batch)  # without a writer's number, told by content
    assert rows_of(table.read(spark)) == want
    table.compact(spark)
    table.merge(batch)
    assert rows_of(table.read(spark)) == want
    assert table.merge(batch, "stream", 1) and table.snapshot(spark).applied == {"stream": 1}


def test_readers_see_whole_snapshots(spark, folder):
    table = VersionedTable(f"{folder}/t", ["k"], ["at"], buckets=2)
    for b in range(3):
        table.merge(spark.createDataFrame([(k, f"{b}", b) for k in range(20)], SCHEMA))
    # a run that no snapshot lists, as a writer leaves it that dies before its commit
    table._write(spark, table._placed(spark.createDataFrame([(1, "torn", 9)], SCHEMA)).withColumn("_run", F.lit(9).cast("bigint")), "orphan")
    for n in (1, 2, 3):
        assert {r["v"] for r in table.read(spark, n).collect()} == {f"{n - 1}"}
    early = table.read(spark, 1)
    table.compact(spark)
    assert {r["v"] for r in early.collect()} == {"0"}
    assert table.expire(spark) == 4 and {r["v"] for r in table.read(spark).collect()} == {"2"}
    with pytest.raises(ValueError):
        VersionedTable(f"{folder}/none", ["k"], ["at"]).read(spark)


def test_two_writers_at_once_lose_nothing(spark, folder):
    table = VersionedTable(f"{folder}/t", ["k"], ["at"], buckets=2)
    table.merge(spark.createDataFrame([(0, "first", 0)], SCHEMA))
    stale = table.snapshot(spark)
    real = VersionedTable.snapshot
    calls = []

    def snapshot(self, spark, number=None):  # the second writer starts from the same snapshot as the first
        calls.append(number)
        return stale if len(calls) == 1 else real(self, spark, number)

    batches = [spark.createDataFrame([(w * 100 + k, f"w{w}", 1) for k in range(10)], SCHEMA) for w in (1, 2)]
    table.merge(batches[0])
    try:
        VersionedTable.snapshot = snapshot
        table.merge(batches[1])
    finally:
        VersionedTable.snapshot = real
    assert table.read(spark).count() == 21 and table.versions(spark) == [1, 2, 3]
    threads = [threading.Thread(target=table.merge, args=(b.withColumn("at", F.lit(2)),)) for b in batches]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert table.read(spark).where("at = 2").count() == 20


def test_a_faster_compaction_wins(spark, folder):
    table = VersionedTable(f"{folder}/t", ["k"], ["at"], buckets=2)
    table.merge(spark.createDataFrame([(k, "a", 0) for k in range(20)], SCHEMA))
    real = VersionedTable._write

    def overtaken(self, spark, rows, run):
        VersionedTable._write = real
        self.merge(spark.createDataFrame([(99, "late", 1)], SCHEMA))
        assert self.compact(spark) == 2
        return real(self, spark, rows, run)

    try:
        VersionedTable._write = overtaken
        assert table.compact(spark) == 0
    finally:
        VersionedTable._write = real
    assert table.read(spark).count() == 21


def test_columns_are_added_at_any_depth_and_widened(spark, folder):
    table = VersionedTable(f"{folder}/t", ["k"], ["at"], buckets=2)
    table.merge(spark.createDataFrame([(1, 5, (1,), 0)], "k int, n int, s struct<a: int>, at int"))
    table.merge(spark.createDataFrame([(2, 2**40, (2,), 0)], "k int, n bigint, s struct<a: int>, at int"))
    table.merge(spark.createDataFrame([(3, 7, (3, "x"), 0, "new")], "k int, n int, s struct<a: int, b: string>, at int, extra string"))
    for _ in range(2):
        got = {r["k"]: r for r in table.read(spark).collect()}
        assert [got[k]["n"] for k in (1, 2, 3)] == [5, 2**40, 7] and [got[k]["s"]["b"] for k in (1, 2, 3)] == [None, None, "x"]
        assert got[1]["extra"] is None and got[3]["extra"] == "new"
        assert "mergeSchema" not in table.read(spark)._jdf.queryExecution().toString()
        table.compact(spark)
    assert [n for n, _ in table.schema_log(spark)] == [1, 2, 3]
    assert "b" not in table.read(spark, 2).schema["s"].dataType.names
    with pytest.raises(ValueError, match="no common type"):
        table.merge(spark.createDataFrame([(1, "text", 0)], "k int, n string, at int"))
    with pytest.raises(ValueError, match="laid out"):
        VersionedTable(f"{folder}/t", ["k"], ["at"], buckets=5).merge(spark.createDataFrame([(1, 0)], "k int, at int"))


def test_wider_types():
    t = lambda s: StructType.fromDDL(s)
    assert wider(t("a decimal(10,2), d date, l array<struct<x: int>>"), t("d timestamp_ntz, a decimal(9,4), l array<struct<x: bigint, y: int>>, z float")) == \
        t("a decimal(12,4), d timestamp_ntz, l array<struct<x: bigint, y: int>>, z float")


def test_only_touched_folders_are_compacted(spark, folder):
    table = VersionedTable(f"{folder}/t", ["s", "k"], ["at"], buckets=1, split_by=["s"])
    table.merge(spark.createDataFrame([(s, k, 0) for s in ("a|b", "b", None) for k in range(5)], "s string, k int, at int"))
    assert table.compact(spark) == 3
    before = table.snapshot(spark).base
    table.merge(spark.createDataFrame([("b", 1, 1)], "s string, k int, at int"))
    assert table.compact(spark) == 1
    after = table.snapshot(spark).base
    assert [f for f in after if after[f] != before[f]] in (["_split=k%7Cb/_bucket=0"], ["_split=k|b/_bucket=0"])
    assert table.read(spark).count() == 15 and table.read(spark).where("s = 'b' and at = 1").count() == 1
