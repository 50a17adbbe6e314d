"""Dyadic windows, scans over ranges and the lookups built on them, with hot keys, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import lookups, ranges, scans

D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_make_few_spans(spark):
    rows = [(day(0), None), (day(3), day(36524)), (day(5), day(5)), (day(5), day(4)), (None, day(3)), (dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    df = spark.createDataFrame(rows, "s date, e date").withColumn("id", F.monotonically_increasing_id())
    n = {(r["s"], r["e"]): r["n"] for r in ranges.spread(df, "s", "e").groupBy("s", "e").agg(F.count("*").alias("n")).collect()}
    assert n[day(0), None] <= 22 and n[day(3), day(36524)] < 40 and n[day(5), day(5)] == 1 and len(n) == 4
    assert n[dt.date(1, 1, 1), dt.date(9999, 12, 31)] <= 44


def test_every_day_meets_a_window_once(spark):
    rng = random.Random(5)
    wins = [(i, "k", day(a := rng.randrange(300)), day(a + rng.randrange(200))) for i in range(40)]
    days = spark.range(600).select(F.lit("k").alias("k"), F.date_add(F.lit(D0), F.col("id").cast("int")).alias("d"))
    got = ranges.covering(days, spark.createDataFrame(wins, "i int, k string, s date, e date"), ["k"], "d", "s", "e")
    pairs = [(r["i"], r["_p_day"]) for r in got.collect()]
    want = [(i, day(n)) for i, _, s, e in wins for n in range(600) if s <= day(n) <= e]
    assert sorted(pairs) == sorted(want)
    text = plan(got)
    assert "<=" not in text.split("Join")[1].split("\n")[0] and "NestedLoop" not in text


def written(spark, folder, name, rows, schema):
    """Rows as a file, whose size Spark knows and takes for small."""
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}")
    return spark.read.schema(schema).parquet(f"{folder}/{name}")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_windows_and_days_are_not_broadcast(spark, folder, how):
    facts = written(spark, folder, "facts", [(i, i % 7, day(i)) for i in range(50)], "i int, k int, d date")
    wins = written(spark, folder, "wins", [(k, day(3 * k), None) for k in range(7)], "k int, s date, e date")
    got = lookups.validity_join(facts, wins, ["k"], "d", "s", "e", how)
    assert "Broadcast" not in plan(got) and "SortMergeJoin" in plan(got)
    assert got.where("s IS NOT NULL").count() == sum(3 * (i % 7) <= i for i in range(50))


@pytest.mark.parametrize("n", [1, 4, 23])
def test_running_values_of_a_hot_key_with_moments(spark, n):
    """One key with thousands of moments, and small ones; nulls, equal moments, a null key."""
    rng = random.Random(n)
    rows = [("hot", rng.randrange(3000), rng.choice([None, 1, 2, 5])) for _ in range(4000)]
    rows += [(rng.choice("abcdefgh"), rng.randrange(50), rng.randrange(9)) for _ in range(300)] + [(None, k % 5, k) for k in range(20)] + [("z", None, 3), ("z", 1, 4)]
    df = spark.createDataFrame(rows, "k string, at int, v int").withColumn("id", F.monotonically_increasing_id())
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy(F.col("at").asc_nulls_first())
    want = {r["id"]: r["s"] for r in df.select("id", F.sum("v").over(w).alias("s")).collect()}
    got = {r["id"]: r["s"] for r in scans.running_sum(df, ["k"], "at", "v", "s", ranges=n).collect()}
    assert got == want
    at = df.groupBy("k", "at").agg(F.sum("v").alias("v"))
    rows_before = w.rowsBetween(Window.unboundedPreceding, -1)
    values = {"m": ("max", "v"), "n": ("min", "v"), "l": ("last", "v"), "s": ("sum", "v")}
    want = {(r["k"], r["at"]): tuple(r[2:]) for r in at.select(
        "k", "at", F.max("v").over(rows_before), F.min("v").over(rows_before), F.last("v", True).over(rows_before), F.sum("v").over(rows_before)).collect()}
    got = {(r["k"], r["at"]): (r["m"], r["n"], r["l"], r["s"]) for r in scans.running(at, ["k"], "at", values, before=True, ranges=n).collect()}
    assert got == want


def test_a_hot_key_is_spread_over_ranges(spark, monkeypatch):
    df = spark.range(20_000).selectExpr("'hot' as k", "id as at", "1 as v")
    kept = []
    real = scans.stored
    monkeypatch.setattr(scans, "stored", lambda d, name: kept.append(real(d, name)) or kept[-1])
    out = scans.running(df, ["k"], "at", {"s": ("sum", "v")}, ranges=16)
    assert out.where("s <> at + 1").count() == 0
    sizes = [r["count"] for r in kept[0].groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 20_000 / 6


def test_moments_merge_into_disjoint_intervals(spark):
    rng = random.Random(8)
    rows = []
    for k in ["hot"] * 600 + list("abc") * 10:
        a = rng.randrange(20_000)
        rows.append((k, a, a + rng.randrange(1, 40)))
    got = sorted(tuple(r) for r in scans.merge_moments(spark.createDataFrame(rows, "k string, s int, e int"), ["k"], "s", "e", ranges=7).select("k", "s", "e", "interval_count").collect())
    want = []
    for k in {r[0] for r in rows}:
        for s, e in sorted((s, e) for q, s, e in rows if q == k):
            if want and want[-1][0] == k and s <= want[-1][2]:
                want[-1] = (k, want[-1][1], max(e, want[-1][2]), want[-1][3] + 1)
            else:
                want.append((k, s, e, 1))
    assert got == sorted(want)


def test_predecessor_lookup_of_many_bands(spark):
    bands = spark.range(100_000).selectExpr("if(id % 3 = 0, 'x', 'hot') as b", "id * 10 as lo", "id * 10 + 6 as hi", "id as band")
    rng = random.Random(3)
    facts = [(i, rng.choice(["hot", "hot", "x", "none", None]), rng.choice([None, rng.randrange(-20, 1_000_050)])) for i in range(3000)]
    got = {r["i"]: r["band"] for r in scans.predecessor_lookup(spark.createDataFrame(facts, "i int, k string, v bigint"), bands, "k", "v", "b", "lo", "hi").collect()}
    assert len(got) == len(facts)
    for i, k, v in facts:
        n = None if v is None else v // 10
        held = v is not None and 0 <= n < 100_000 and v % 10 <= 6 and k == ("x" if n % 3 == 0 else "hot")
        assert got[i] == (n if held else None), (i, k, v)


def test_six_optional_columns_take_two_joins(spark):
    rng = random.Random(7)
    cols = list("abcdef")
    rules = [tuple(rng.choice([None, None, "x", "y"]) for _ in cols) + (rng.choice("pq"), f"r{n:03d}") for n in range(120)]
    facts = [(i, *[rng.choice(["x", "y", "z", None]) for _ in cols], "p" if i % 3 else "q") for i in range(300)]
    r = spark.createDataFrame(rules, ", ".join(f"{c} string" for c in cols) + ", g string, cat string")
    f = spark.createDataFrame(facts, "i int, " + ", ".join(f"f{c} string" for c in cols) + ", fg string")
    out = lookups.wildcard_lookup(f, r, {"g": "fg"}, {c: f"f{c}" for c in cols}, ["cat"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 2
    got = {x["i"]: x["cat"] for x in out.collect()}
    for fact in facts:
        hits = [x for x in rules if x[6] == fact[7] and all(c is None or c == v for c, v in zip(x[:6], fact[1:7]))]
        hits.sort(key=lambda x: (-sum(c is not None for c in x[:6]), [c is None for c in x[:6]], x[7]))
        assert got[fact[0]] == (hits[0][7] if hits else None)


def test_labels_meet_names_by_their_rarest_word(spark):
    names = spark.createDataFrame([(f"the common part {k}",) for k in range(500)] + [("the rare gear",), ("the gear",), ("gear the rare",)], "n string")
    labels = spark.createDataFrame([("the rare gear",), ("the unknown",), ("the",)], "l string")
    out = lookups.word_match(names, "n", labels.filter("l <> 'the'"), "l")
    assert [tuple(r) for r in out.collect()] == [("the rare gear", "the rare gear")]
    # the join brings two names for "rare", not the 502 that hold "the"
    assert lookups.word_match(names, "n", labels, "l").filter("l = 'the'").count() == 503
