import pathlib

from pyspark.sql import functions as F

from tallyframe.operators import digests
from tallyframe.sinks.refresh import RefreshedModel
from tallyframe.sinks.versioned import VersionedTable

SCHEMA = "tenant string, k int, v int, at int"


def part(rows):
    return rows.groupBy("_split", "tenant").agg(F.sum("v").alias("s"), F.count("*").alias("n"))


def finish(parts):
    return parts.agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def test_a_refresh_recomputes_only_changed_tenants(spark, folder):
    table = VersionedTable(f"{folder}/t", ["tenant", "k"], ["at"], 2, ["tenant"])
    seen = []

    def counted(rows):
        seen.append(sorted(r[0] for r in rows.select("tenant").distinct().collect()))
        return part(rows)

    model = RefreshedModel(f"{folder}/m", table, counted, finish)
    table.merge(spark.createDataFrame([(t, k, k, 0) for t in ("a", "b|c", "d") for k in range(10)], SCHEMA))
    assert model.refresh(spark) == ["k|a", "k|b|c", "k|d"]
    files = lambda: {str(p.relative_to(folder)) for p in pathlib.Path(f"{folder}/m/parts").rglob("*.parquet")}
    before = files()
    table.merge(spark.createDataFrame([("b|c", 3, 100, 1), ("b|c", 77, 5, 1)], SCHEMA))
    assert model.refresh(spark) == ["k|b|c"] and seen[-1] == ["b|c"]
    assert len(before - files()) == 1
    full = RefreshedModel(f"{folder}/full", table, part, finish)
    full.refresh(spark)
    assert model.read(spark).first() == full.read(spark).first() and model.read(spark).first()["s"] == 45 * 3 - 3 + 105
    table.compact(spark)
    assert model.refresh(spark) == [] and model.last(spark) == 3
    table.merge(spark.createDataFrame([("new", 1, 1, 0)], SCHEMA))
    assert model.refresh(spark) == ["k|new"] and model.read(spark).first()["n"] == 32


def test_three_deletions_of_a_million_touch_few_buckets(spark):
    table = spark.range(1_000_000).selectExpr("cast(id as string) as k", "id % 7 as j", "id as v")
    other = table.where("v not in (5, 77777, 999999)").drop("v")
    odd = digests.differing(digests.digests(table, ["k", "j"]), digests.digests(other, ["k", "j"]))
    assert odd.count() == 3 < 0.01 * digests.BUCKETS
    assert sorted(r["v"] for r in digests.missing_keys(table, other, ["k", "j"]).collect()) == [5, 77777, 999999]


def test_digests_of_odd_tables(spark):
    a = spark.createDataFrame([(1, None), (None, None), (2, 3)], "x int, y int")
    assert digests.missing_keys(a, a, ["x"]).count() == 0  # equal digests, nothing to compare
    assert digests.missing_keys(a, a.limit(0), ["x"]).count() == 3 and digests.missing_keys(a.limit(0), a, ["x"]).count() == 0
    twice = a.where("x = 2").unionByName(a.where("x = 2"))
    assert [r["x"] for r in digests.missing_keys(a.where("x is not null"), twice, ["x"]).collect()] == [1]
    kept = digests.digests(a.where("x is not null"), ["x"])
    assert digests.missing_keys(a.where("x is not null"), twice, ["x"], known=kept).count() == 1
