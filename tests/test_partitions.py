"""Partitions grow with the rows, so that no task's share does."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import partitions
from tallyframe.plans import derived, resolution


@pytest.fixture()
def tables(spark, folder):
    """40 orders of 5 lines, two versions of each, of 6 parts."""
    made = {
        "orders": spark.range(40).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey", "'O' AS o_orderstatus", "1.0D AS o_totalprice", "TIMESTAMP_NTZ'2024-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "lineitem": spark.range(400).selectExpr(
            "id % 40 AS l_orderkey", "id % 6 AS l_partkey", "id % 3 AS l_suppkey", "CAST(id DIV 40 % 5 AS INT) AS l_linenumber", "CAST(id % 50 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice",
            "0.1D AS l_discount", "0.02D AS l_tax", "'R' AS l_returnflag", "'F' AS l_linestatus", "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(CAST(id DIV 200 AS INT)) AS l_shipdate"),
        "part": spark.range(6).selectExpr("id AS p_partkey", "concat('Brand#', id) AS p_brand", "'PROMO' AS p_type"),
    }
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return SimpleNamespace(spark=spark, **{name: spark.read.parquet(f"{folder}/{name}.parquet") for name in made})


def test_lines_of_orders_get_partitions_by_their_number(spark, rows, tables, monkeypatch):
    queries = [derived.ln, resolution.brand_lines, resolution.d17, resolution.d18, resolution.d16]
    few = [rows(q(tables)) for q in queries]
    assert [len(x) for x in few] == [200, 200, 40, len({(r[0], r[2]) for r in few[1]}), 40]
    monkeypatch.setattr(partitions, "ROWS_A_TASK", 10)
    assert [rows(q(tables)) for q in queries] == few
    for q in (derived.ln, resolution.brand_lines, resolution.d17):
        assert q(tables).rdd.getNumPartitions() == 40


def test_small_tables_are_left_to_spark(spark):
    df = spark.range(100)
    assert partitions.dealt(df, 100, "id") is df
    assert partitions.dealt(df, 5 * partitions.ROWS_A_TASK, "id").rdd.getNumPartitions() == 5
    grouped = partitions.dealt(df, 5 * partitions.ROWS_A_TASK, "id").groupBy("id").agg(F.count("*"))
    assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
