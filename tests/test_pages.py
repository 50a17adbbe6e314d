import json
import pathlib

import pytest
from pyspark.sql import functions as F

from tallyframe.sinks.upsert import KeyedTable
from tallyframe.sources import pages as pg
from tallyframe.sources.endpoints import endpoint_config
from tallyframe.streaming import ingest


def put(root, tenant, endpoint, run, page, records, key, synced):
    d = pathlib.Path(root) / "raw" / "erp" / tenant / "2.0" / endpoint / "2026-03-13"
    d.mkdir(parents=True, exist_ok=True)
    stem = d / f"20260313T000000_{run}_p{page:03d}"
    stem.with_suffix(".json").write_text(json.dumps({key: records}))
    meta = {"x-tenant-id": tenant, "x-endpoint": endpoint, "x-run-id": run, "x-synced-at": synced}
    pathlib.Path(f"{stem}.meta.json").write_text(json.dumps(meta))


@pytest.fixture()
def landing(folder):
    put(folder, "t1", "invoices", "run_1", 1, [{"InvoiceID": "a", "Total": 1}, {"InvoiceID": "b", "Total": 2}], "Invoices", "2026-03-13T01:00:00Z")
    put(folder, "t1", "invoices", "run_2", 1, [{"InvoiceID": "a", "Total": 5}, {"InvoiceID": "", "Total": 2}, {"Total": 3}], "Invoices", "2026-03-14T01:00:00Z")
    put(folder, "t2", "currencies", "run_1", 1, [{"Code": "EUR"}], "Currencies", "2026-03-13T01:00:00Z")
    put(folder, "t2", "mystery", "run_1", 1, [{"X": 1}], "Mystery", "2026-03-13T01:00:00Z")
    return folder


def test_page_key_and_tight_prefix(spark, landing):
    p = pg.read_pages(spark, landing, tenant="t1", endpoint="invoices").orderBy("run_id").collect()
    assert [(r["vendor"], r["tenant"], r["endpoint"], r["run_id"], r["page"]) for r in p] == [
        ("erp", "t1", "invoices", "run_1", 1), ("erp", "t1", "invoices", "run_2", 1)]
    assert pg.read_pages(spark, landing).count() == 4


def test_envelopes_drop_missing_ids(spark, landing):
    joined = pg.with_sidecar(pg.read_pages(spark, landing), pg.read_sidecars(spark, landing))
    env = pg.record_envelopes(joined, endpoint_config(spark))
    got = sorted((r["tenant_id"], r["endpoint"], r["record_id"], str(r["synced_at"])) for r in env.collect())
    assert got == [("t1", "invoices", "a", "2026-03-13 01:00:00"), ("t1", "invoices", "a", "2026-03-14 01:00:00"),
                   ("t1", "invoices", "b", "2026-03-13 01:00:00"), ("t2", "currencies", "EUR", "2026-03-13 01:00:00")]


def test_drift(spark, landing):
    found = pg.drift(pg.read_pages(spark, landing), "endpoint", endpoint_config(spark)).collect()
    assert [(r["endpoint"], r["row_count"]) for r in found] == [("mystery", 1)]


def test_stream_from_sidecars_to_keyed_table(spark, landing, folder):
    table = KeyedTable(f"{folder}/out", ["tenant_id", "endpoint", "record_id"], ["synced_at"], buckets=2)
    config = endpoint_config(spark)
    drifted = []

    def handle(batch, batch_id):
        pages = ingest.pages_of(batch)
        if pages is None:
            return
        known = pages.join(F.broadcast(config), "endpoint", "left_semi")
        drifted.extend(r[0] for r in pages.join(F.broadcast(config), "endpoint", "left_anti").select("endpoint").collect())
        env = pg.record_envelopes(known, config).drop("meta")
        ingest.keep_latest(table)(env, batch_id)

    # one file per batch: the newer page of record "a" may arrive first or last
    stream = ingest.new_sidecars(spark, landing, files_per_batch=1)
    ingest.run_available(stream, handle, f"{folder}/cp")
    got = {(r["tenant_id"], r["record_id"]): json.loads(r["payload"]) for r in table.read(spark).collect()}
    assert got[("t1", "a")]["Total"] == 5 and len(got) == 3 and drifted == ["mystery"]
    put(landing, "t1", "invoices", "run_0", 1, [{"InvoiceID": "a", "Total": -1}], "Invoices", "2026-03-01T01:00:00Z")
    ingest.run_available(ingest.new_sidecars(spark, landing, files_per_batch=1), handle, f"{folder}/cp")
    assert {r["record_id"]: json.loads(r["payload"]) for r in table.read(spark).collect()}["a"]["Total"] == 5


def test_lookback_window(spark):
    day = F.lit("2026-06-17").cast("date")
    got = spark.range(1).select(ingest.lookback_start(day, 30).cast("string"), ingest.lookback_start(day, 1).cast("string"),
                                ingest.lookback_start(day, 0).cast("string")).first()
    assert tuple(got) == ("2026-05-19", "2026-06-17", "2026-06-17")


def test_half_open_filters(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-01-12",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    lo, hi = (F.lit(x).cast("date") for x in ("2024-01-05", "2024-01-12"))
    assert df.filter(ingest.modified_between([F.col("d")], lo, hi)).count() == 1
    assert df.filter(ingest.modified_between([F.col("d")], lo, None)).count() == 3
    assert df.filter(ingest.business_between([F.col("d")], lo, None)).count() == 2


def test_a_missing_page_does_not_stop_the_stream(spark, landing, folder):
    lost = next(pathlib.Path(landing).rglob("*run_2_p001.json"))
    lost.unlink()
    seen, missing = [], []

    def handle(batch, batch_id):
        pages = ingest.pages_of(batch, missing.extend)
        seen.append(0 if pages is None else pages.count())

    ingest.run_available(ingest.new_sidecars(spark, landing), handle, f"{folder}/cp")
    assert sum(seen) == 3 and [m.rsplit("/", 1)[1] for m in missing] == [lost.name]


def test_report_snapshot_keys(spark):
    path = "file:/x/raw/erp/t1/2.0/report_trial_balance/2026-03-13/20260313T000000_r1__2026_02.json"
    got = spark.createDataFrame([(path,)], "path string").select(*pg.page_key_columns(F.col("path"))).first()
    assert (got["endpoint"], got["run_id"], got["period"], got["page"]) == ("report_trial_balance", "r1", "2026_02", None)


def test_bucketed_landing_moves_no_body(spark, folder):
    from tallyframe.sources.landing import BucketedLanding

    pages = spark.range(200).selectExpr("concat('raw/', id, if(id % 2 = 0, '.json', '')) as path", "id", "repeat('x', 500) as body").repartition(5)
    sides = spark.range(200).where("id % 3 <> 0").selectExpr("concat('raw/', id, if(id % 4 = 0, '.json', ''), '.meta.json') as meta_path", "map('k', string(id)) as meta")
    landing = BucketedLanding.create(pages, sides, 8, f"{folder}/landing")
    out = landing.joined(spark)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "SortMergeJoin" in text
    want = pg.with_sidecar(pages, sides)
    assert sorted(out.columns) == sorted(want.columns)
    assert sorted((r["id"], r["meta"]["k"]) for r in out.collect()) == sorted((r["id"], r["meta"]["k"]) for r in want.collect())
    landing.drop(spark)
    assert not spark.catalog.tableExists(f"{landing.name}_pages")
