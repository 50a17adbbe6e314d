"""Every registered query next to its SQL oracle on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallyframe import plans
from tallyframe.sources.registry import SCHEMAS

ROOT = "/root/testdata/sf0.001"
QUERIES, ORACLES = plans.QUERIES, plans.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in SCHEMAS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return con


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, ROOT)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert canon(got, df.columns) == canon(cur.fetchall(), columns)


def test_entry_registers_every_plan():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
