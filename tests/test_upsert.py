import pathlib

import pytest
from pyspark.sql import functions as F

from tallyframe.sinks import tables, upsert as up
from tallyframe.sinks.upsert import KeyedTable, single_writer

SCHEMA = "tenant string, id string, v int, synced int"


def test_insert_update_mixed(spark, rows):
    target = spark.createDataFrame([("t", "r1", 1, 1), ("t", "r2", 2, 1)], SCHEMA)
    batch = spark.createDataFrame([("t", "r2", 9, 2), ("t", "r3", 3, 2)], SCHEMA)
    out = up.upsert(target, batch, ["tenant", "id"], ["synced"])
    assert rows(out) == [("t", "r1", 1, 1), ("t", "r2", 9, 2), ("t", "r3", 3, 2)]


def test_batch_collapses_to_the_latest(spark, rows):
    batch = spark.createDataFrame([("t", "r", 1, 3), ("t", "r", 2, 7), ("t", "r", 3, 5)], SCHEMA)
    assert rows(up.collapse(batch, ["tenant", "id"], ["synced"])) == [("t", "r", 2, 7)]


def test_rows_without_key_never_collapse(spark):
    batch = spark.createDataFrame([("t", None, 1, 1), ("t", None, 1, 1), ("t", "a", 1, 1)], SCHEMA)
    assert up.collapse(batch, ["tenant", "id"], ["synced"]).count() == 3


def test_older_row_never_replaces_newer(spark, rows):
    target = spark.createDataFrame([("t", "r", 5, 10)], SCHEMA)
    late = spark.createDataFrame([("t", "r", 1, 2)], SCHEMA)
    assert rows(up.upsert(target, late, ["tenant", "id"], ["synced"])) == [("t", "r", 5, 10)]


def test_strict_load(spark, rows):
    target = spark.createDataFrame([("t", "a", 1, 1), (None, "b", 2, 1)], SCHEMA)
    same = spark.createDataFrame([("t", "a", 7, 2), ("t", "a", 7, 2)], SCHEMA)
    assert ("t", "a", 7, 2) in rows(up.strict_load(target, same, ["tenant", "id"]))
    clash = spark.createDataFrame([("t", "a", 7, 2), ("t", "a", 8, 2)], SCHEMA)
    with pytest.raises(ValueError, match="different payloads"):
        up.strict_load(target, clash, ["tenant", "id"])
    with pytest.raises(ValueError, match="without a value"):
        up.strict_load(target, spark.createDataFrame([("t", "", 7, 2)], SCHEMA), ["tenant", "id"])
    empty = spark.createDataFrame([], SCHEMA)
    assert up.strict_load(target, empty, ["tenant", "id"]).count() == 2


def test_null_safe_merge_matches_null_keys(spark, rows):
    target = spark.createDataFrame([(None, "b", 2, 1)], SCHEMA)
    batch = spark.createDataFrame([(None, "b", 3, 2)], SCHEMA)
    assert rows(up.null_safe_merge(target, batch, ["tenant", "id"])) == [(None, "b", 3, 2)]


def test_keyed_table_replay_and_new_column(spark, folder, rows):
    table = up.KeyedTable(f"{folder}/t", ["id"], ["synced"], buckets=4)
    first = spark.createDataFrame([(str(i), i, 1) for i in range(20)], "id string, v int, synced int")
    table.merge(first)
    table.merge(first)
    assert table.read(spark).count() == 20
    wider = spark.createDataFrame([("3", 33, 2, "x"), ("99", 1, 2, "y")], "id string, v int, synced int, extra string")
    table.merge(wider)
    got = {r["id"]: (r["v"], r["extra"]) for r in table.read(spark).collect()}
    assert len(got) == 21 and got["3"] == (33, "x") and got["99"] == (1, "y") and got["4"] == (4, None)
    table.merge(spark.createDataFrame([("3", -1, 1)], "id string, v int, synced int"))
    assert {r["id"]: r["v"] for r in table.read(spark).collect()}["3"] == 33


def test_outcome_flags_suspicious_merges(spark):
    target = spark.createDataFrame([("t", "a", 1, 5)], SCHEMA)
    fresh = spark.createDataFrame([("t", "x", 1, 1), ("t", "y", 1, 1)], SCHEMA)
    r = up.merge_outcome(target, fresh, ["tenant", "id"], ["synced"]).first()
    assert r["all_inserted"] and not r["nothing_changed"]
    r = up.merge_outcome(target, target, ["tenant", "id"], ["synced"]).first()
    assert r["unchanged"] == 1 and r["nothing_changed"]


def test_snapshots_are_append_only(spark, rows):
    old = spark.createDataFrame([("tb|1", 5)], "record_id string, v int")
    new = spark.createDataFrame([("tb|1", 9), ("tb|2", 6)], "record_id string, v int")
    assert rows(tables.append_snapshots(old, new, "record_id")) == [("tb|1", 5), ("tb|2", 6)]


def test_landing_keeps_all_rows(spark, folder):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("part"))
    tables.land(df, f"{folder}/landing", ["part"])
    assert tables.read_landed(spark, f"{folder}/landing").groupBy("part").count().count() == 3
    assert tables.read_landed(spark, f"{folder}/landing").count() == 1000


def stored_rows(spark, table):
    return sorted((tuple(r) for r in table.read(spark).collect()), key=repr)


def test_rows_without_a_full_key_survive_and_a_replay_adds_none(spark, folder):
    table = KeyedTable(f"{folder}/t", ["k", "j"], ["at"], buckets=2)
    batch = spark.createDataFrame([("a", "x", 1), (None, "x", 1), (None, "x", 2), ("b", None, 1)], "k string, j string, at int")
    table.merge(batch)
    table.merge(batch)
    assert stored_rows(spark, table) == sorted([("a", "x", 1), (None, "x", 1), (None, "x", 2), ("b", None, 1)], key=repr)
    assert table.loose(spark) == 3


def test_another_bucket_count_is_refused(spark, folder):
    batch = spark.range(20).selectExpr("id as k", "1 as at")
    KeyedTable(f"{folder}/t", ["k"], ["at"], buckets=4).merge(batch)
    with pytest.raises(ValueError):
        KeyedTable(f"{folder}/t", ["k"], ["at"], buckets=8).merge(batch)
    assert KeyedTable(f"{folder}/t", ["k"], ["at"], buckets=4).read(spark).count() == 20


def test_only_touched_folders_are_rewritten(spark, folder):
    table = KeyedTable(f"{folder}/t", ["s", "k"], ["at"], buckets=2, split_by=["s"])
    rows = [(s, k, 1) for s in "ab" for k in range(30)]
    table.merge(spark.createDataFrame(rows, "s string, k int, at int"))
    place = {(r["s"], r["k"]): r["_bucket"] for r in table._placed(spark.createDataFrame(rows, "s string, k int, at int")).collect()}
    one = next(k for k in range(30) if place["a", k] == 0)
    two = next(k for k in range(30) if place["b", k] == 1)
    files = lambda: {str(p.parent.relative_to(folder)): p.name for p in pathlib.Path(folder).rglob("*.parquet")}
    before = files()
    table.merge(spark.createDataFrame([("a", one, 2), ("b", two, 2)], "s string, k int, at int"))
    after = files()
    changed = {d for d in before if before[d] != after[d]}
    assert len(before) == 4 and {d[-1] for d in changed if "k|a" in d or "k%7Ca" in d} == {"0"} and len(changed) == 2
    assert table.read(spark).where("at = 2").count() == 2 and table.read(spark).count() == 60


def test_ties_do_not_depend_on_order(spark, folder):
    rows = [("a", 1, v) for v in range(8)]
    got = set()
    for k in range(3):
        table = KeyedTable(f"{folder}/t{k}", ["k"], ["at"], buckets=1)
        table.merge(spark.createDataFrame(rows[k:] + rows[:k], "k string, at int, v int").repartition(3))
        got.add(table.read(spark).first()["v"])
    assert len(got) == 1


def test_two_writers_are_refused(spark, folder):
    with single_writer(spark, f"{folder}/t.lock"):
        with pytest.raises(RuntimeError):
            KeyedTable(f"{folder}/t", ["k"], ["at"]).merge(spark.range(1).selectExpr("id as k", "1 as at"))
    KeyedTable(f"{folder}/t", ["k"], ["at"]).merge(spark.range(1).selectExpr("id as k", "1 as at"))
