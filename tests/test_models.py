import datetime as dt
import json

import pytest

from tallyframe.models.base import Warehouse, stored_tables
from tallyframe.models.ods import MODELS, constraint_report
from tallyframe.sources.documents import DOCUMENTS
from tallyframe.streaming import staging

A1, A2, A3 = (f"{i:08x}-0000-4000-8000-000000000000" for i in (1, 2, 3))
ENV = "tenant_id string, endpoint string, record_id string, payload string, first_seen_at timestamp_ntz, synced_at timestamp_ntz, meta map<string,string>"
NOW = dt.datetime(2026, 3, 14)


def ms(day):
    return f"/Date({int(dt.datetime.fromisoformat(day + 'T00:00:00+00:00').timestamp() * 1000)}+0000)/"


def report(kind, params, rows):
    return (kind, {"ReportID": kind, "Rows": rows}, {"x-report": kind, "x-run-id": "r1", "x-report-params": params})


def cells(label, *values):
    attr = [{"Id": "account", "Value": label[1]}]
    return {"RowType": "Row", "Cells": [{"Value": label[0], "Attributes": attr}, *[{"Value": v, "Attributes": attr} for v in values]]}


def journal(jid, kind, day, *lines):
    return ("journals", {"JournalID": jid, "JournalDate": ms(day), "SourceType": kind, "JournalLines": [
        {"JournalLineID": f"{jid}{n}", "AccountID": a, "NetAmount": amt, "TrackingCategories": [{"TrackingCategoryID": "cat", "Name": "Dept", "Option": "North"}]}
        for n, (a, amt) in enumerate(lines)]}, {})


RECORDS = [
    ("organisations", {"OrganisationID": "org", "Name": "Org", "BaseCurrency": "NOK", "FinancialYearEndDay": 31, "FinancialYearEndMonth": 12}, {}),
    ("accounts", {"AccountID": A1, "Code": "1500", "Name": "Receivable", "Class": "ASSET", "Status": "ACTIVE"}, {}),
    ("accounts", {"AccountID": A2, "Code": "3000", "Name": "Sales", "Class": "REVENUE", "Status": "ACTIVE"}, {}),
    ("accounts", {"AccountID": A3, "Code": "x9", "Name": "Odd", "Class": "", "Status": "ARCHIVED"}, {}),
    ("items", {"ItemID": "it1", "Code": "SKU"}, {}), ("items", {"ItemID": "it2", "Code": "SKU"}, {}),
    ("tracking_categories", {"TrackingCategoryID": "cat", "Name": "Dept", "Options": [
        {"TrackingOptionID": "o2", "Name": "North"}, {"TrackingOptionID": "o1", "Name": "North"}]}, {}),
    ("contacts", {"ContactID": "c1", "Name": "Ann", "ContactStatus": "ACTIVE", "Addresses": [
        {"AddressType": "STREET", "City": "Oslo"}, {"AddressType": "POBOX", "City": "Bergen", "Country": "NO"}],
        "Phones": [{"PhoneType": "MOBILE", "PhoneNumber": "99"}]}, {}),
    ("invoices", {"InvoiceID": "i1", "Type": "ACCREC", "Status": "PAID", "LineAmountTypes": "Inclusive", "CurrencyCode": "SEK", "CurrencyRate": 2,
                  "Contact": {"ContactID": "c1", "Name": "Ann"}, "Date": ms("2026-02-01"), "SubTotal": 80, "LineItems": [
                      {"LineItemID": "l1", "AccountID": A2, "ItemCode": "SKU", "LineAmount": 60, "TaxAmount": 12,
                       "Tracking": [{"TrackingCategoryID": "cat", "Name": "Dept", "Option": "North"}]},
                      {"LineItemID": "l2", "AccountID": A2, "LineAmount": 32}]}, {}),
    ("invoices", {"InvoiceID": "i2", "Type": "ACCREC", "Status": "VOIDED", "LineAmountTypes": "Exclusive", "Date": ms("2026-02-02"), "SubTotal": 10,
                  "LineItems": [{"LineItemID": "l3", "AccountID": A2, "LineAmount": 70, "TaxAmount": 5}]}, {}),
    ("bank_transfers", {"BankTransferID": "b1", "FromBankAccount": {"AccountID": A1}, "ToBankAccount": {"AccountID": A3}, "Amount": 7, "Date": ms("2026-02-03")}, {}),
    ("payments", {"PaymentID": "p1", "PaymentType": "ACCRECPAYMENT", "Status": "AUTHORISED", "Account": {"AccountID": A1}, "Amount": 5, "Date": ms("2026-02-03"),
                  "BatchPayment": {"BatchPaymentID": "bp"}}, {}),
    ("manual_journals", {"ManualJournalID": "m1", "Status": "POSTED", "LineAmountTypes": "Exclusive", "Date": ms("2026-02-03"), "JournalLines": [
        {"AccountID": A1, "LineAmount": 4, "TaxAmount": 1}, {"AccountID": A1, "IsBlank": True}, {"AccountID": A3, "LineAmount": -5}]}, {}),
    journal("j1", "ACCREC", "2026-02-01", (A1, 160), (A2, -160)), journal("j0", "ACCREC", "2025-12-31", (A1, 50), (A2, -50)),
    report("report_trial_balance", "date=2026-02-28", [
        {"RowType": "Header", "Cells": [{"Value": ""}, {"Value": "YTD Debit"}, {"Value": "YTD Credit"}]},
        {"RowType": "Section", "Title": "All", "Rows": [cells(("Receivable", A1), "161.00", ""), cells(("Sales", A2), "", "160.00"), cells(("FX", "FXGROUPID"), "9", "")]}]),
    report("report_profit_and_loss", "fromDate=2026-02-01&toDate=2026-02-28", [
        {"RowType": "Header", "Cells": [{"Value": ""}, {"Value": "Feb"}]},
        {"RowType": "Section", "Title": "Income", "Rows": [cells(("Sales", A2), "1,60.00")]}]),
]


@pytest.fixture(scope="module")
def warehouse(spark):
    rows = [("t1", e, f"{n}", json.dumps(p), NOW, NOW, {"x-tenant-id": "t1", "x-endpoint": e, **m}) for n, (e, p, m) in enumerate(RECORDS)]
    env = spark.createDataFrame(rows, ENV).persist()
    tables = {}
    for e in DOCUMENTS:
        tables.update(staging.stage(env, e))
    tables.update(staging.stage_reports(env))
    return Warehouse(tables.__getitem__, MODELS)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_every_model_plans(warehouse):
    for name in MODELS:
        assert warehouse.model(name).columns, name


def test_invoice_lines(warehouse):
    l = by(warehouse.model("fact_invoice_line"), "line_item_id")
    assert len(l) == 3
    assert (l["l1"]["amount_in_currency"], l["l1"]["amount"], l["l1"]["tax_amount"]) == (48, 96, 24)
    assert l["l2"]["amount_in_currency"] == 32 and l["l3"]["amount"] == 70
    assert l["l1"]["item_key"] == "t1|it1" and l["l1"]["tracking_option_key_1"] == "t1|o1" and l["l1"]["tracking_option_key_2"] is None
    assert l["l1"]["account_key"] == f"t1|{A2}" and l["l1"]["date_key"] == 20260201 and l["l2"]["line_number"] == 2
    assert l["l1"]["contact_key"] == "t1|c1" and l["l3"]["contact_key"] is None and l["l1"]["document_type"] == "ACCREC"


def test_dimensions(warehouse):
    a = by(warehouse.model("dim_account"), "source_account_id")
    assert (a[A1]["bs_pl"], a[A2]["fsli_1"], a[A3]["bs_pl"], a[A3]["account_mapping_method"]) == ("BS", "Revenue", None, "unmapped")
    assert a[A2]["account_cd_numeric"] == 3000 and a[A3]["account_cd_numeric"] is None and a[A1]["is_active"] and not a[A3]["is_active"]
    c = warehouse.model("dim_contact").first()
    assert (c["street_city"], c["pobox_country"], c["mobile_number"], c["phone_number"], c["party_name"]) == ("Oslo", "NO", "99", None, "Ann")


def test_reconciliations(warehouse):
    tb = by(warehouse.model("recon_trial_balance"), "account_id")
    assert set(tb) == {A1, A2} and tb[A1]["fiscal_year_start"] == dt.date(2026, 1, 1)
    assert (tb[A1]["reported_net"], tb[A1]["our_net"], tb[A1]["diff"]) == (161, 160, -1) and tb[A2]["diff"] == 0
    pl = by(warehouse.model("recon_profit_and_loss"), "account_id")
    assert set(pl) == {A2} and (pl[A2]["reported_signed"], pl[A2]["ours"], pl[A2]["diff"]) == (-160, -160, 0)
    docs = {(r["account_id"], r["document_type"]): r for r in warehouse.model("recon_document_facts").collect()}
    assert docs[(A2, "ACCREC")]["doc_amount"] == -160 and docs[(A2, "ACCREC")]["gl_amount"] == -210 and docs[(A2, "ACCREC")]["diff"] == 50
    assert docs[(A1, "TRANSFER")]["doc_amount"] == -7 and docs[(A3, "TRANSFER")]["doc_amount"] == 7
    assert docs[(A1, "ACCRECPAYMENT")]["doc_amount"] == 5 and docs[(A1, "MANJOURNAL")]["doc_amount"] == 5


def test_assertions(warehouse):
    bad = warehouse.model("assert_fact_invoice_line_reconciles").collect()
    assert [r["invoice_id"] for r in bad] == ["i2"] and bad[0]["diff"] == 60
    assert warehouse.model("assert_fact_general_ledger_balances").count() == 0
    assert warehouse.model("assert_fact_manual_journal_line_balances").count() == 0
    r = {(x["assertion"], x["subject"]): x["failures"] for x in constraint_report(
        warehouse, "fact_invoice_line", ["invoice_line_key"], ["invoice_line_key", "contact_key"]).collect()}
    assert r == {("non_null", "invoice_line_key"): 0, ("non_null", "contact_key"): 1, ("unique_key", "invoice_line_key"): 0}


def test_payment_and_journal_details(warehouse):
    p = warehouse.model("native.fact_payment").first()
    assert p["batch_payment_id"] == "bp"
    lines = by(warehouse.model("fact_manual_journal_line"), "line_number")
    assert set(lines) == {0, 1} and lines[0]["amount"] == 5 and lines[1]["account_id"] == A3
    g = warehouse.model("fact_general_ledger").first()
    assert g["tracking_option_key_1"] == "t1|o1" and g["account_key"].startswith("t1|")
