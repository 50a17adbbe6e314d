"""Operators against brute force on small fixtures, with hot keys where they matter."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import aggregates, asof, documents as dm, fx, intervals, latest, lookups, quality, resolve, sets

D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def hot_key(rng):
    """A key that holds a third of all rows next to rarer ones."""
    return "hot" if rng.random() < 0.34 else rng.choice("abcdef")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_validity_join(spark, rows, how):
    rng = random.Random(1)
    facts = [(i, hot_key(rng), day(rng.randrange(0, 200))) for i in range(300)]
    wins = [(j, hot_key(rng), day(rng.randrange(-50, 150)), None if rng.random() < .3 else day(rng.randrange(-20, 260))) for j in range(60)]
    f = spark.createDataFrame(facts, "i int, k string, d date")
    w = spark.createDataFrame(wins, "j int, k string, s date, e date")
    got = rows(lookups.validity_join(f, w, ["k"], "d", "s", "e", how).select("i", "j"))
    want = [(i, j) for i, k, d in facts for j, k2, s, e in wins if k == k2 and s <= d and (e is None or d <= e)]
    if how == "left":
        seen = {i for i, _ in want}
        want += [(i, None) for i, _, _ in facts if i not in seen]
    assert got == sorted(want, key=repr)


def test_asof_join_never_looks_ahead(spark, rows):
    rng = random.Random(2)
    series = {(k, day(rng.randrange(0, 60))): rng.random() for k in "ab" for _ in range(12)}
    facts = [(i, rng.choice("abc"), day(rng.randrange(-5, 70))) for i in range(200)]
    s = spark.createDataFrame([(k, d, v) for (k, d), v in series.items()], "k string, sd date, v double")
    f = spark.createDataFrame(facts, "i int, k string, d date")
    got = {r["i"]: (r["held_since"], r["v"]) for r in asof.asof_join(f, s, ["k"], "d", "sd", ["v"]).collect()}
    for i, k, d in facts:
        past = [sd for (kk, sd) in series if kk == k and sd <= d]
        assert got[i] == ((max(past), series[(k, max(past))]) if past else (None, None))
    assert len(got) == len(facts)


def test_wildcard_lookup(spark):
    rng = random.Random(3)
    opts = [None, "x", "y"]
    rules = [("b", t, s, f"r{n}") for n, (t, s) in enumerate((t, s) for t in opts for s in opts) if n != 4] + [("c", "x", None, "rc"), ("c", "x", None, "ra")]
    facts = [(i, rng.choice("bcd"), rng.choice(["x", "y", "z", None]), rng.choice(["x", "y", "z"])) for i in range(100)]
    r = spark.createDataFrame(rules, "brand string, t string, s string, cat string")
    f = spark.createDataFrame(facts, "i int, fb string, ft string, fs string")
    got = {x["i"]: x["cat"] for x in lookups.wildcard_lookup(f, r, {"brand": "fb"}, {"t": "ft", "s": "fs"}, ["cat"]).collect()}
    for i, b, t, s in facts:
        hits = [x for x in rules if x[0] == b and x[1] in (None, t) and x[2] in (None, s) and not (x[1] is not None and t is None)]
        hits.sort(key=lambda x: (-((x[1] is not None) + (x[2] is not None)), x[1] is None, x[3]))
        assert got[i] == (hits[0][3] if hits else None)
    assert len(got) == len(facts)


def test_word_match(spark, rows):
    names = spark.createDataFrame([("old rod",), ("cold-ring",), ("Hot Gear x",), ("gearhot",), ("blåbær old",)], "n string")
    labels = spark.createDataFrame([("old",), ("hot gear",), ("ring",), ("",), ("gear",), ("blåbær",)], "l string")
    assert rows(lookups.word_match(names, "n", labels, "l")) == sorted([
        ("old rod", "old"), ("cold-ring", "ring"), ("Hot Gear x", "hot gear"), ("Hot Gear x", "gear"), ("blåbær old", "old"),
        ("blåbær old", "blåbær")], key=repr)


def test_either_key_prefers_the_first(spark, rows):
    dim = spark.createDataFrame([(1, "2", "one"), (2, "two", "deux"), (3, None, "x")], "id int, num string, label string")
    facts = spark.createDataFrame([("1",), ("2",), ("two",), ("9",), (None,)], "ref string")
    got = rows(lookups.either_key_lookup(facts, dim, "ref", ["id", "num"], ["label"], "how"))
    assert got == sorted([("1", "one", "id"), ("2", "deux", "id"), ("two", "deux", "num"), ("9", None, None), (None, None, None)], key=repr)


def test_merge_intervals_disjoint_and_complete(spark):
    rng = random.Random(4)
    data = []
    for _ in range(400):
        s = rng.randrange(0, 400)
        data.append((hot_key(rng), day(s), day(s + rng.randrange(0, 12))))
    got = intervals.merge_intervals(spark.createDataFrame(data, "k string, s date, e date"), ["k"], "s", "e").collect()
    for k in {r[0] for r in data}:
        covered = sorted({s + dt.timedelta(days=n) for kk, s, e in data if kk == k for n in range((e - s).days + 1)})
        mine = sorted((r["s"], r["e"]) for r in got if r["k"] == k)
        assert all(b[0] > a[1] + dt.timedelta(days=1) for a, b in zip(mine, mine[1:]))
        assert covered == [s + dt.timedelta(days=n) for s, e in mine for n in range((e - s).days + 1)]
    assert sum(r["interval_count"] for r in got) == len(data)


def test_daily_rates(spark):
    s = spark.createDataFrame([("EUR", day(2), "11.5"), ("EUR", day(5), "12"), ("SEK", day(0), "1.01")], "currency string, rate_date date, r string").select(
        "currency", "rate_date", F.col("r").cast("decimal(18,6)").alias("exchange_rate"))
    ref = spark.createDataFrame([(day(7),)], "max_date date")
    got = {(r["currency"], r["calendar_date"]): r for r in fx.daily_rates(s, "NOK", ref).collect()}
    assert len(got) == 3 * 8
    assert got[("EUR", day(1))]["exchange_rate"] is None and not got[("EUR", day(1))]["has_market_rate"]
    assert got[("EUR", day(4))]["rate_date"] == day(2) and got[("EUR", day(4))]["is_rate_filled_forward"]
    assert not got[("EUR", day(5))]["is_rate_filled_forward"] and float(got[("EUR", day(7))]["exchange_rate"]) == 12
    assert got[("NOK", day(7))]["is_same_currency"] and float(got[("NOK", day(0))]["exchange_rate"]) == 1
    early = spark.createDataFrame([(day(-3),)], "max_date date")
    assert fx.daily_rates(s, "NOK", early).agg(F.max("calendar_date")).first()[0] == day(5)


def test_group_amount_steps(spark):
    df = spark.createDataFrame([("NOK", "5", "9", "2", "3"), ("SEK", "5", "9", "2", "3"), ("SEK", None, "9", "2", "3"), ("SEK", "5", None, "2", "3"),
                                ("SEK", None, None, "2", None), (None, "5", None, "2", None)], "b string, ba string, br string, da string, dr string")
    dec = lambda c: F.col(c).cast("decimal(18,2)")
    got = [float(r[0]) for r in df.select(fx.group_amount(F.col("b"), "NOK", dec("ba"), dec("br"), dec("da"), dec("dr"))).collect()]
    assert got == [5, 45, 6, 6, 2, 5]


def test_samples_are_bounded_and_exact(spark):
    rng = random.Random(5)
    data = [(hot_key(rng), f"v{rng.randrange(50):02d}") for _ in range(1000)] + [("a", None)]
    got = {r["k"]: r["s"] for r in aggregates.distinct_samples(spark.createDataFrame(data, "k string, v string"), ["k"], "v", 5, "s").collect()}
    assert got == {k: " | ".join(sorted({v for kk, v in data if kk == k and v})[:5]) for k in {k for k, _ in data}}


def test_latest_flag_and_only_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 1)], "k string, o int")
    assert sorted((r["k"], r["o"]) for r in latest.latest_flag(df, ["k"], ["o"]).filter("is_latest").collect()) == [("a", 3), ("b", 1)]
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", "x"), ("b", "y"), ("c", None)], "k string, v string")
    assert dict(tuple(r) for r in df.groupBy("k").agg(aggregates.only_value("v")).collect()) == {"a": "x", "b": None, "c": None}


def test_header_value(spark):
    lines = [("o1", "A", 10, 1, True, False), ("o1", "B", 3, 2, True, True), ("o2", "A", 1, 1, True, False), ("o2", "B", 5, 2, True, False),
             ("o3", None, 5, 1, True, False), ("o3", "A", 1, 2, True, False), ("o4", "A", 1, 1, False, False), ("o5", "B", 1, 1, True, True)]
    df = spark.createDataFrame(lines, "o string, u string, a int, n int, m boolean, anc boolean")
    got = {r["o"]: (r["representative"], r["agreed_value"], r["selection_method"]) for r in resolve.header_value(
        df, "o", "u", "a", "n", F.col("m"), F.col("anc")).collect()}
    assert got == {"o1": ("A", "A", "unanimous"), "o2": ("B", None, "multiple_values"), "o3": ("A", None, "unresolved_lines"),
                   "o4": (None, None, "no_material_lines"), "o5": ("B", "B", "unanimous")}


def test_resolve_by_window_prefers_segment_then_newest(spark, rows):
    wins = spark.createDataFrame([("t", None, day(0), None, "default"), ("t", None, day(5), None, "newer"), ("t", "R", day(2), day(9), "special")],
                                 "k string, ws string, s date, e date, unit string")
    facts = spark.createDataFrame([(1, "t", "R", day(3)), (2, "t", "R", day(10)), (3, "t", "N", day(3)), (4, "t", None, day(6)), (5, "t", "R", day(-1))],
                                  "i int, k string, seg string, d date")
    got = rows(resolve.resolve_by_window(facts.filter("seg IS NOT NULL"), wins, ["k"], "seg", "d", "s", "e", "ws", ["unit"]).select("i", "unit"))
    assert got == [(1, "special"), (2, "newer"), (3, "default"), (5, None)]


def test_priority_union_and_padding(spark, rows):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "b")], "k int, v string")
    assert rows(sets.priority_union(a, b, ["k"])) == [(1, "a"), (2, "b")]
    assert sets.pad_to(a, {"v": "string", "w": "date"}).dtypes == [("v", "string"), ("w", "date")]


def test_assertions(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    assert quality.unique_key(df, ["k"], "t").first()["failures"] == 1
    assert {r["subject"]: r["failures"] for r in quality.non_null(df, ["k", "v"], "t").collect()} == {"k": 0, "v": 1}
    j = spark.createDataFrame([("j1", "1.00"), ("j1", "-1.00"), ("j2", "1.00")], "j string, a string").select("j", F.col("a").cast("decimal(18,2)").alias("a"))
    bad = quality.unbalanced(j, ["j"], "a")
    assert [r["j"] for r in bad.collect()] == ["j2"]
    assert quality.fails_above(bad, 5, "n").count() == 0 and quality.fails_above(bad, 0, "n").first()["n"] == 1


def test_flatten_documents(spark):
    doc = {"ID": "m1", "Date": "/Date(1773360000000+0000)/", "Lines": [
        {"A": "1.50", "IsBlank": False, "Tracking": [{"Name": "x"}, {"Name": "y"}]}, {"A": "9", "IsBlank": True}, {"A": "oops"}]}
    spec = dm.DocumentSpec("ID", [("on", "Date", "epoch_date"), ("nested", "Lines", "string")], {
        "lines": dm.ChildSpec("Lines", [("amount", "A", "money"), ("first", "Tracking[0].Name", "string")], position="pos", blank_flag="IsBlank"),
        "tracking": dm.ChildSpec("Lines", [("amount", "A", "money")], nested="Tracking", nested_fields=[("name", "Name", "string")])},
        counts={"n": "Lines", "none": "Missing"})
    rec = dm.parse_records(spark.createDataFrame([("t", json.dumps(doc)), ("t", "{bad"), ("t", '{"ID":"m2"}')], "tenant string, payload string"))
    out = dm.flatten(rec, spec, ["tenant"])
    heads = {r["record_id"]: r for r in out["header"].collect()}
    assert heads["m1"]["on"] == dt.date(2026, 3, 13) and heads["m1"]["n"] == 3 and heads["m1"]["nested"] is None and heads["m2"]["n"] == 0
    lines = [(r["pos"], r["amount"] and float(r["amount"]), r["first"]) for r in out["lines"].collect()]
    assert lines == [(0, 1.5, "x"), (1, None, None)]
    assert [r["name"] for r in out["tracking"].collect()] == ["x", "y"]


def test_report_cells(spark):
    cell = lambda v, a=None: {"Value": v, "Attributes": a} if a else {"Value": v}
    attr = [{"Id": "account", "Value": "u1"}, {"Id": "tracking", "Value": "z"}]
    tree = {"ReportID": "TB", "Rows": [
        {"RowType": "Header", "Cells": [cell(""), cell("YTD")]},
        {"RowType": "Section", "Title": "S", "Rows": [{"RowType": "Row", "Cells": [cell("Cash", attr), cell("1,234.50", attr)]}]},
        {"RowType": "Row", "Cells": [cell("Bare")]},
        {"RowType": "Section", "Title": "Empty", "Rows": []}]}
    df = spark.createDataFrame([("t", json.dumps(tree))], "tenant string, payload string")
    got = dm.report_cells(df, "payload", ["tenant"]).orderBy("section_index", "row_index", "cell_index").collect()
    assert [(r["section_index"], r["section_title"], r["row_index"], r["cell_index"], r["row_label"], r["column_header"], r["attribute_value"]) for r in got] == [
        (1, "S", 0, 0, "Cash", "", "u1"), (1, "S", 0, 1, "Cash", "YTD", "u1"), (2, None, -1, 0, "Bare", "", None)]
    assert json.loads(got[0]["attributes_json"]) == attr and got[2]["attributes_json"] is None
    assert [str(x[0]) for x in dm.report_cells(df, "payload", []).filter("column_header = 'YTD'").select(dm.report_number("cell_value")).collect()] == ["1234.50"]


def test_resolve_by_window_does_not_pair_segments_with_windows(spark):
    day = "DATE'2024-01-10' AS d"
    facts = spark.range(400).selectExpr("'t' AS k", "concat('s', id) AS seg", day)
    wins = spark.range(400).selectExpr("'t' AS k", "concat('s', id) AS ws", "DATE'2024-01-01' AS s", "CAST(NULL AS DATE) AS e", "concat('u', id) AS unit").unionByName(
        spark.sql("SELECT 't' AS k, CAST(NULL AS STRING) AS ws, DATE'2023-01-01' AS s, CAST(NULL AS DATE) AS e, 'base' AS unit"))
    out = resolve.resolve_by_window(facts, wins, ["k"], "seg", "d", "s", "e", "ws", ["unit"])
    assert out.where("unit = concat('u', substring(seg, 2))").count() == 400
    none = resolve.resolve_by_window(facts.limit(1).withColumn("seg", F.lit(None).cast("string")), wins, ["k"], "seg", "d", "s", "e", "ws", ["unit"])
    assert none.first()["unit"] == "base"


def test_resolve_by_window_broadcasts_nothing(spark, folder):
    spark.range(40).selectExpr("id % 5 AS k", "IF(id % 2 = 0, 'R', NULL) AS seg", "DATE'2024-01-10' AS d").write.parquet(f"{folder}/facts")
    spark.range(5).selectExpr("id AS k", "IF(id < 2, 'R', NULL) AS ws", "DATE'2024-01-01' AS s", "CAST(NULL AS DATE) AS e", "concat('u', id) AS unit").write.parquet(f"{folder}/wins")
    facts, wins = spark.read.parquet(f"{folder}/facts"), spark.read.parquet(f"{folder}/wins")
    out = resolve.resolve_by_window(facts, wins, ["k"], "seg", "d", "s", "e", "ws", ["unit"])
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("unit = concat('u', k)").count() == 32
