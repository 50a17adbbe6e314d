import datetime as dt
import json
import pathlib

from pyspark.sql import functions as F

from tallyframe.models.base import Warehouse, stored_tables
from tallyframe.models.ods import MODELS
from tallyframe.sources.documents import DOCUMENTS, json_name
from tallyframe.sources.endpoints import ENDPOINTS
from tallyframe.streaming import ingest, staging


def put(root, tenant, endpoint, run, key, records, synced, **meta):
    d = pathlib.Path(root) / "raw" / "erp" / tenant / "2.0" / endpoint / "2026-03-13"
    d.mkdir(parents=True, exist_ok=True)
    # report snapshots end with their period, pages of records with a number
    stem = str(d / f"20260313T000000_{run}_{'_2026_03_13' if endpoint.startswith('report_') else 'p001'}")
    pathlib.Path(stem + ".json").write_text(json.dumps({key: records}))
    side = {"x-tenant-id": tenant, "x-endpoint": endpoint, "x-run-id": run, "x-synced-at": synced, **meta}
    pathlib.Path(stem + ".meta.json").write_text(json.dumps(side))


ACCOUNT = "0a1b2c3d-0001-4000-8000-000000000000"
INVOICE = {
    "InvoiceID": "i1", "InvoiceNumber": "N1", "Type": "ACCREC", "Status": "PAID", "LineAmountTypes": "Inclusive", "Contact": {"ContactID": "c1", "Name": "Ann"},
    "Date": "/Date(1773360000000+0000)/", "DateString": "2026-03-13T00:00:00", "CurrencyCode": "SEK", "CurrencyRate": 1.5, "SubTotal": 80.0, "TotalTax": 20, "Total": 100,
    "HasErrors": False, "LineItems": [
        {"LineItemID": "l1", "AccountCode": "200", "LineAmount": 60, "TaxAmount": 12, "Quantity": 2, "Tracking": [{"Name": "Dept", "Option": "A", "TrackingOptionID": "o1"}]},
        {"LineItemID": "l2", "AccountCode": "0300", "LineAmount": "40.00", "TaxAmount": 8}],
    "Payments": [{"PaymentID": "p1", "Amount": 100, "Date": "/Date(1773446400000)/"}]}


def fill(root):
    put(root, "t1", "invoices", "r1", "Invoices", [INVOICE], "2026-03-13T01:00:00Z")
    newer = json.loads(json.dumps(INVOICE))
    newer["Status"] = "VOIDED"
    newer["LineItems"] = newer["LineItems"][:1]
    newer["LineItems"][0]["LineAmount"] = 61
    put(root, "t1", "invoices", "r2", "Invoices", [newer], "2026-03-14T01:00:00.123456789Z")
    put(root, "t1", "contacts", "r1", "Contacts", [{
        "ContactID": "c1", "Name": "Ann", "ContactStatus": "ACTIVE", "Balances": {"AccountsReceivable": {"Outstanding": 5.5}},
        "Phones": [{"PhoneType": "DEFAULT", "PhoneNumber": "  "}, {"PhoneType": "MOBILE", "PhoneNumber": "1"}],
        "ContactGroups": [{"ContactGroupID": "g1", "Name": "G"}]}], "2026-03-13T01:00:00Z")
    put(root, "t1", "report_trial_balance", "r1", "Reports", [{
        "ReportID": "TrialBalance", "ReportTitles": ["Trial Balance", "Org"], "Rows": [
            {"RowType": "Header", "Cells": [{"Value": "Account"}, {"Value": "YTD Debit"}]},
            {"RowType": "Section", "Title": "Assets", "Rows": [{"RowType": "Row", "Cells": [
                {"Value": "Bank", "Attributes": [{"Id": "account", "Value": ACCOUNT}]}, {"Value": "12.00", "Attributes": [{"Id": "account", "Value": ACCOUNT}]}]}]}]}],
        "2026-03-13T01:00:00Z", **{"x-report": "report_trial_balance", "x-report-params": "date=2026-03-13"})


def test_every_document_kind_has_a_configured_endpoint():
    known = {e: k for e, _, k in ENDPOINTS}
    assert all(known[e] == s.record_id for e, s in DOCUMENTS.items())
    assert json_name("contact_id") == "ContactID" and json_name("sub_total") == "SubTotal"


def test_all_specs_resolve(spark):
    empty = spark.createDataFrame([], "tenant_id string, endpoint string, record_id string, payload string, first_seen_at timestamp_ntz, "
                                      "synced_at timestamp_ntz, meta map<string,string>")
    for e in [*DOCUMENTS, "report_balance_sheet"]:
        for name, df in staging.stage(empty, e).items():
            assert set(staging.staging_keys(e)[name]) <= set(df.columns), (e, name)


def check(spark, root):
    t = lambda n: spark.read.parquet(f"{root}/{n}").drop("_split", "_bucket")
    head = t("invoices").collect()
    assert len(head) == 1 and head[0]["status"] == "VOIDED" and head[0]["contact_name"] == "Ann" and head[0]["sub_total"] == 80.0
    assert head[0]["invoice_date"] == dt.datetime(2026, 3, 13) and head[0]["invoice_date_local"] == dt.date(2026, 3, 13)
    assert head[0]["line_item_count"] == 1 and head[0]["payment_count"] == 1 and head[0]["credit_note_count"] == 0
    lines = {r["line_item_id"]: r for r in t("invoice_lines").collect()}
    assert lines["l1"]["line_amount"] == 61 and lines["l1"]["tracking_option_1_name"] == "A" and lines["l1"]["tracking_option_2_name"] is None
    assert lines["l2"]["account_code"] == "0300" and lines["l2"]["line_amount"] == 40 and lines["l2"]["invoice_id"] == "i1"
    assert t("invoice_payments").first()["payment_date"] == dt.datetime(2026, 3, 14)
    c = t("contacts").first()
    assert c["is_active"] and c["ar_outstanding"] == 5.5 and c["phone_count"] == 2
    assert [r["phone_type"] for r in t("contact_phones").collect()] == ["MOBILE"]
    snap = t("report_snapshots").first()
    assert snap["record_id"] == "report_trial_balance|r1" and snap["report_date"] == dt.date(2026, 3, 13) and snap["report_titles"] == "Trial Balance | Org"
    cell = t("report_rows").filter("cell_index = 1").first()
    assert cell["column_header"] == "YTD Debit" and cell["attribute_value"] == ACCOUNT and cell["section_title"] == "Assets"


KINDS = ["invoices", "contacts", "report_trial_balance"]


def test_backfill_twice_equals_stream(spark, folder):
    fill(folder)
    staging.backfill(spark, folder, f"{folder}/s1", KINDS, buckets=2)
    check(spark, f"{folder}/s1")
    staging.backfill(spark, folder, f"{folder}/s1", KINDS, buckets=2)
    check(spark, f"{folder}/s1")
    drift = []
    put(folder, "t1", "novelties", "r1", "Novelties", [{"X": 1}], "2026-03-13T01:00:00Z")
    handler = staging.arriving(spark, f"{folder}/s2", KINDS, lambda df: drift.extend(r[0] for r in df.select("endpoint").collect()), buckets=2)
    ingest.run_available(ingest.new_sidecars(spark, folder, files_per_batch=2), handler, f"{folder}/cp")
    check(spark, f"{folder}/s2")
    assert drift == ["novelties"]
    w = Warehouse(stored_tables(spark, f"{folder}/s2", staging.staging_schemas(spark)), MODELS)
    assert w.model("fact_invoice_line").count() == 2 and w.model("fact_payment").count() == 0
    assert w.model("fact_report_row").filter("cell_value_numeric = 12").count() == 1
    assert [(r["account_id"], r["reported_net"], r["our_net"]) for r in w.model("recon_trial_balance").collect()] == [(ACCOUNT, 12.0, 0.0)]
