"""Registered corpus queries and the pipeline on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm.queries import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    got = QUERIES[name](spark, ROOT)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(cur.fetchall(), key=repr)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    before = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.stored(stage(spark, docs, ROOT), "stage")
        assert out.columns[:5] == docs.columns[:5] and out.count() <= before
        if k < 4:
            assert out.columns == docs.columns
        before, docs = out.count(), out
    assert before > 50 and docs.select(F.min("mix_rate")).first()[0] > 0
    assert corpus_pipeline.run(spark, ROOT).count() == before
