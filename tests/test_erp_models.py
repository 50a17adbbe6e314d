import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyframe.models.base import Warehouse
from tallyframe.models.erp import MODELS, price_class_periods

S1, S2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
D = dt.date


def line(item, price, amount=None, **more):
    return {"inventory": {"id": item}, "unitPrice": price, "amount": amount, **more}


TABLES = {
    "market_rates": ("currency_code string, quote_currency string, rate string, date string, source string, created_at string", [
        ("SEK", "NOK", "1.1", "2026-01-05", "f", "2026-01-05 10:00:00"), ("SEK", "NOK", "1.2", "2026-01-05", "f", "2026-01-05 12:00:00"),
        ("EUR", "NOK", "11", "2026-01-06", "f", "2026-01-06 12:00:00"), ("EUR", "NOK", "bad", "2026-01-07", "f", None)]),
    "general_ledger_transactions": (
        "tenantId string, syncedAt timestamp_ntz, organizationName string, isDeleted boolean, batchNumber string, refNumber string, lineNumber int, account string, "
        "subaccount string, branch string, ledger string, currency string, module string, tranDate string, period string, description string, debitAmount double, "
        "creditAmount double, currDebitAmount double, currCreditAmount double", [
            ("tenant-se-1", S1, "Org SE", None, "b1", "r1", 1, '{"number":"1500","type":"Asset"}', "100", "{}", "GL", "EUR", "AR", "2026-01-07T00:00:00", "202601", "x", 100.0, 0.0, 10.0, 0.0),
            ("tenant-se-1", S2, "Org SE", None, "b1", "r1", 1, '{"number":"1500","type":"Asset"}', "100", "{}", "GL", "EUR", "AR", "2026-01-07T00:00:00", "202601", "x", 200.0, 0.0, 20.0, 0.0),
            ("tenant-se-1", S1, "Org SE", True, "b1", "r1", 2, "1500", "100", "1", "GL", "EUR", "AR", "2026-01-07", "202601", "gone", 1.0, 0.0, 1.0, 0.0),
            ("tenant-no-1", S1, "Org NO", False, "b2", "r2", 1, "3000", "N-7", "1", "GL", "NOK", "GL", None, "202601", "y", 0.0, 50.0, 0.0, 50.0),
            ("tenant-no-1", S1, "Org NO", False, "b2", "r2", 2, "3000", None, "1", "GL", "EUR", "GL", "2026-01-08", "202601", "z", 0.0, 0.0, 3.0, 0.0)]),
    "general_ledger_balances": ("tenantId string, account string", [("tenant-no-1", "9999")]),
    "customer_documents": ("tenantId string, referenceNumber string, project string, isDeleted boolean", [
        ("tenant-se-1", "r1", '{"id":"P1"}', None), ("tenant-se-1", "r1", '{"id":"P1"}', False), ("tenant-no-1", "r2", '{"id":"P2"}', None)]),
    "dim_subaccount": ("tenant_id string, subaccount_id string, subaccount_number string, segment1 string, segment1_value_description string, segment2 string, "
                       "segment3 string, segment3_value_description string", [
                           ("tenant-se-1", "100", "A-1", "IC1", "Intercompany", "7", "000", None), ("tenant-no-1", "101", "N-7", None, None, None, "010", "Dept")]),
    "seed_business_unit_mapping": ("tenant_id string, source_segment_2_value string, business_unit_id string, business_unit_name string, valid_from date, valid_to date", [
        ("tenant-se-1", None, "U0", "Default", D(2020, 1, 1), None), ("tenant-se-1", "7", "U7", "Seven", D(2020, 1, 1), D(2026, 12, 31)),
        ("tenant-se-1", "7", "U8", "Seven new", D(2026, 1, 1), None), ("tenant-no-1", "9", "U9", "Nine", D(2020, 1, 1), None)]),
    "dim_branch": ("tenant_id string, branch_id string, branch_name string, organization_name string, is_main_branch boolean, synced_at timestamp_ntz", [
        ("tenant-se-1", "1", "Side", "Org SE", None, S2), ("tenant-se-1", "2", "Main", "Org SE", True, S1), ("tenant-no-1", "1", "Only", "Org NO", None, S1)]),
    "organizations": ("tenantId string, baseCurrency string, syncedAt timestamp_ntz, isDeleted boolean", [("tenant-se-1", "NOK", S1, None), ("tenant-se-1", "SEK", S2, None)]),
    "seed_entity_mapping": ("tenant_id string, company_id string, entity_code string, entity_name string, group_name string", [("tenant-s", "1", "E1", None, "G")]),
    "raw_chart_of_accounts": (", ".join(f"{c} string" for c in (
        "bs_pl fsli_1 fsli_2 fsli_3 cf1 cf2 cf3 nwc capex ebitda_flag net_income_flag intercompany_flag account_code_1 account_code_2 account_code_3").split()), [
            ("P&L", "Revenue", "Sales", "Goods", None, None, None, None, None, "x", "no", None, "3", "3000", "3000"),
            ("BS", "Assets", "12", "Cash", None, None, None, None, None, None, None, None, "1", "1500", "1500"),
            ("BS", "Assets", None, None, None, None, None, None, None, None, None, None, "1", "1600", "1600"),
            ("BS", "Assets", "Mid", "Better", None, None, None, None, None, None, None, None, "1", "1600", "1600"),
            (" ", "Blank", None, None, None, None, None, None, None, None, None, None, "1", "1700", "1700"),
            ("P&L", "Cost", "From", "Bronze", None, None, None, None, None, None, None, None, "5", "5000", "5000")]),
    "seed_chart_of_accounts": ("bs_pl string, fsli_1 string, fsli_2 string, fsli_3 string, ebitda_flag boolean, net_income_flag boolean, cf1 string, cf2 string, "
                               "cf3 string, nwc string, capex string, account_code_1 bigint, account_code_2 bigint, account_code_3 bigint", [
                                   ("BS", "Assets", "Seeded", "Receivable", False, False, None, None, None, None, None, 1, 1500, 1500),
                                   ("P&L", "Cost", "Seed", "Cost", True, True, None, None, None, None, None, 5, 5000, 5000)]),
    "accounts": ("tenantId string, syncedAt timestamp_ntz, organizationName string, accountCD string, type string, description string, lastModifiedDateTime string, isDeleted boolean", [
        ("tenant-no-1", S1, "Org NO", "3000", "Income", "Sales", None, None), ("tenant-no-1", S1, "Org NO", "1640", "Asset", "Near root", None, None),
        ("tenant-no-1", S1, "Org NO", "9999", "Expense", "Odd", None, None), ("tenant-no-1", S1, "Org NO", "77", None, "None", None, None),
        ("tenant-se-1", S1, "Org SE", "1500", "Asset", "Receivable", None, None), ("tenant-se-1", S1, "Org SE", "4013", "Expense", "Buy", None, None)]),
    "seed_global_account_mapping_scope": ("mapping_scope string, organization_name string, country_code string", [("NO_SE_DK", "Org SE", "SE")]),
    "seed_company_account_mapping": ("organization_name string, local_account_code bigint, mapped_account_code_3 bigint", [("Org NO", 3000, 5000)]),
    "seed_global_account_range_mapping": ("mapping_scope string, local_account_digits bigint, range_start_account_code bigint, mapped_account_code_3 bigint, mapped_account_description string", [
        ("NO_SE_DK", 4, 1500, 1500, "a"), ("NO_SE_DK", 4, 4000, 5000, "b")]),
    "price_classes": ("tenantId string, id string, description string, syncedAt timestamp_ntz, isDeleted boolean", [
        ("t1", "A", "Class A", S1, None), ("t1", "B", "Class B", S1, None), ("t2", "A", "Class A", S1, None)]),
    "customer_locations": ("tenantId string, customerId string, locationId string, priceClassId string, syncedAt timestamp_ntz, isDeleted boolean", [
        ("t1", "c1", "L1", "A", S1, None), ("t1", "c1", "L2", "B", S1, None), ("t1", "c2", "L1", None, S1, None)]),
    "customer_sales_prices": ("tenantId string, priceType string, priceCode string, inventoryId string, price string, effectiveDate string, expirationDate string, "
                              "breakQty double, promotion boolean, isDeleted boolean", [
                                  ("t1", "CustomerPriceClass", "A", "i1", "10", "2025-01-01T00:00:00", "2025-06-30T00:00:00", 0.0, None, None),
                                  ("t1", "CustomerPriceClass", "A", "i2", "20", "2025-07-01T00:00:00", "2025-12-31T00:00:00", None, False, None),
                                  ("t1", "CustomerPriceClass", "B", "i1", "12", "2025-01-01T00:00:00", None, 0.0, None, None),
                                  ("t1", "CustomerPriceClass", "B", "i3", "30", "2024-01-01T00:00:00", "2024-02-01T00:00:00", 5.0, None, None)]),
    "sales_orders": ("tenantId string, customerId string, orderNo string, orderId string, orderType string, type string, location string, date string, syncedAt timestamp_ntz, "
                     "lastModifiedDateTime string, isDeleted boolean, lines string, orderLines string", [
                         ("t1", "c1", "1", "1", "SO", None, "L1", "2025-03-01T00:00:00", S1, None, None, json.dumps([line("i1", 10, 100, lineType="GoodsForInventory", subaccount={"2": "7"}, salesPersonId="p1")]), None),
                         ("t1", "c1", "2", "2", "SO", None, "L2", "2025-04-01T00:00:00", S1, None, None, json.dumps([
                             line("i1", 12, 60, lineNbr=1, subaccount={"2": "7"}), line("frt", 5, 5, lineNbr=2, salesPersonId="p2"), line("i9", 1, 0, lineNbr=3)]), None),
                         ("t1", "c2", "3", "3", "SO", None, "L1", "2025-08-01T00:00:00", S1, None, None, json.dumps([line("i2", 20, 1), line("i1", 12, 1, hasManualPrice=True)]), None),
                         ("t1", "c3", "4", "4", "SO", None, None, "2025-03-02T00:00:00", S1, None, None, json.dumps([line("i1", 10, 1), line("i1", 12, 1)]), None)]),
    "seed_line_strategy": ("inventory_id string, line_type string, sales_account_id string, line_business_unit_strategy string", [("frt", None, None, "allocate_to_material_goods_bu")]),
    "dim_customer": ("customer_key string, tenant_id string, customer_id string, organization_name string, customer_name string, corporate_id string, main_country string, "
                     "price_class_id string, synced_at timestamp_ntz", [
                         ("k1", "t1", "c1", "O1", "ACME AS", "NO 123", "no", "A", S1), ("k2", "t2", "c9", "O2", "Acme", "NO123", "NO", None, S2),
                         ("k3", "t1", "c2", "O1", "ACME AS", "000000000", "no", "B", S1), ("k4", "t2", "c3", "O2", "ACME AS", None, " NO ", None, S1),
                         ("k5", "t1", "c5", "O1", "low", None, None, None, S1)]),
    "supplier_invoices": ("tenantId string, organizationName string, referenceNumber string, documentType string, date string, supplier string, invoiceLines string, isDeleted boolean", [
        ("t1", "O1", "INV1", "Invoice", "2025-01-01T00:00:00", '{"internalId":5,"name":"Sup"}', json.dumps([
            {"lineNumber": 1, "inventoryNumber": "x", "description": "ok", "amount": 1}, {"lineNbr": 2, "description": "Frakt", "cost": 2},
            {"sortOrder": 3, "inventory": json.dumps({"number": "n"}), "amount": "3"}, {"lineNumber": 4, "description": "thing", "amount": 9}, {"lineNumber": 5, "inventory.id": "q", "description": "d"}]), None)]),
    "purchase_orders": ("tenantId string, organizationName string, orderNbr string, orderType string, date string, supplier string, lines string, isDeleted boolean", [
        ("t1", "O1", "PO1", "RO", "2025-01-02", None, json.dumps([{"lineNbr": 1, "extCost": 4}]), None)]),
    "seed_rls_sales_person": ("user_principal_name string, tenant_id string, sales_person_id string, access_scope string, is_active boolean, notes string", [
        (" Ann@X.com ", "tenant-no-1", "s1", "all", None, None), (None, "tenant-no-1", "s1", None, None, None)]),
    "dim_sales_person": ("tenant_id string, sales_person_id string, sales_person_name string, email string, is_active boolean", [
        ("tenant-no-1", "s1", "Ann", "ann@x.com", True), ("tenant-no-1", "s2", "Bob", "bob@x.com", False), ("tenant-se-1", "s3", "Cy", "cy@x.com", True)]),
}


@pytest.fixture(scope="module")
def w(spark):
    frames = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in TABLES.items()}
    return Warehouse(frames.__getitem__, MODELS)


def by(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


def test_currency(w):
    r = by(w.model("dim_currency_market_rate"), "from_currency_id", "to_currency_id")
    assert r[("SEK", "NOK")]["exchange_rate"] == 1.2 and r[("NOK", "SEK")]["is_inverse_rate"] and r[("EUR", "NOK")]["is_latest_rate_for_pair"]
    d = by(w.model("dim_currency_market_rate_daily"), "currency", "calendar_date")
    assert float(d[("SEK", D(2026, 1, 8))]["exchange_rate"]) == 1.2 and d[("EUR", D(2026, 1, 5))]["exchange_rate"] is None and ("NOK", D(2026, 1, 8)) in d


def test_company(w):
    c = by(w.model("dim_company"), "tenant_id")
    assert c["tenant-se-1"]["branch_name"] == "Main" and c["tenant-se-1"]["base_currency"] == "SEK" and c["tenant-se-1"]["entity_name"] == "Org SE"
    assert c["tenant-no-1"]["base_currency"] == "NOK" and c["tenant-no-1"]["entity_code"] is None


def test_chart_and_accounts(w):
    ch = by(w.model("chart_of_accounts"), "account_code_3")
    assert {k: v["_source"] for k, v in ch.items()} == {3000: "bronze", 1500: "seed", 1600: "bronze", 5000: "seed"}
    assert ch[1600]["fsli_3"] == "Better" and ch[3000]["ebitda_flag"] and not ch[3000]["net_income_flag"]
    a = by(w.model("dim_account"), "tenant_id", "account_cd")
    m = {k: (v["account_mapping_method"], v["account_code_3"], v["bs_pl"]) for k, v in a.items()}
    assert m[("tenant-no-1", "3000")] == ("company_workbook_exact_match", 5000, "P&L")
    assert m[("tenant-no-1", "1640")] == ("account_family_root_fallback", 1600, "BS")
    assert m[("tenant-no-1", "9999")] == ("native_account_type_fallback", None, "P&L") and m[("tenant-no-1", "77")] == ("unmapped", None, None)
    assert m[("tenant-se-1", "1500")] == ("global_account_exact_match", 1500, "BS") and m[("tenant-se-1", "4013")] == ("global_previous_account_range_fallback", 5000, "P&L")
    assert a[("tenant-se-1", "4013")]["fsli_3"] == "Cost" and len(a) == 6


def test_ledger_and_finance_table(w):
    g = by(w.model("silver.fact_general_ledger"), "tenant_id", "line_number")
    assert len(g) == 3
    se = g[("tenant-se-1", "1")]
    assert (se["debit_amount"], se["account_cd"], se["project_id"], se["business_unit_id"], se["department_id"]) == (200, "1500", "P1", "U8", "000")
    no = g[("tenant-no-1", "1")]
    assert (no["transaction_date"], no["project_id"], no["business_unit_id"], no["business_unit_name"]) == (D(2026, 1, 1), None, "tenant-no-1|UNMAPPED", "Org NO")
    b = by(w.model("BI_FinanceTable"), "tenant_id", "line_number")
    assert b[("tenant-se-1", "1")]["amount_group"] == 240 and b[("tenant-se-1", "1")]["amount_local_currency"] == 20
    assert b[("tenant-no-1", "1")]["amount_group"] == -50 and b[("tenant-no-1", "2")]["amount_group"] == 33
    assert b[("tenant-no-1", "1")]["department_code"] == "010 - Dept" and b[("tenant-se-1", "1")]["ic"] == "IC1 - Intercompany"
    assert b[("tenant-se-1", "1")]["accounts"] == "1500 - Receivable" and b[("tenant-se-1", "1")]["financial_month"] == 1


def test_missing_accounts(w):
    m = by(w.model("dim_missing_gl_accounts"), "tenant_id", "account_cd")
    assert ("tenant-no-1", "3000") not in m and m[("tenant-no-1", "9999")]["has_gl_balance"] and not m[("tenant-no-1", "77")]["has_gl_balance"]


def test_price_classes(w):
    r = by(w.model("bridge_customer_price_class"), "customer_id", "price_class_id")
    assert set(r) == {("c1", "A"), ("c1", "B"), ("c2", "A")}
    assert r[("c1", "A")]["customer_has_multiple_price_classes"] and r[("c2", "A")]["source_field"] == "sales_order_price_signature_inferred"
    assert r[("c1", "B")]["sample_location_ids"] == "L2" and r[("c1", "A")]["sales_order_count"] == 2 and r[("c2", "A")]["price_class_description"] == "Class A"
    p = by(price_class_periods(w, F.lit("2025-05-01").cast("date")), "customer_id", "price_class_id")
    assert set(p) == {("c1", "A"), ("c1", "B"), ("c2", "A"), ("c3", "A"), ("c3", "B")}
    a = p[("c1", "A")]
    assert (a["valid_from"], a["valid_to"], a["is_current"], a["evidence_count"]) == (D(2025, 1, 1), D(2025, 12, 31), True, 1)
    assert a["source_method"] == "sales_order_order_location_price_class" and p[("c1", "B")]["valid_to"] == D(9999, 12, 30)


def test_customer_groups(w):
    g = by(w.model("bridge_customer_to_combined"), "customer_key")
    assert g["k1"]["customer_combined_key"] == g["k2"]["customer_combined_key"] == "corporate_id|NO123"
    assert g["k3"]["customer_combined_key"] == g["k4"]["customer_combined_key"] == "name_country|NO|ACMEAS"
    assert g["k5"]["combined_match_method"] == "tenant_customer" and g["k1"]["combined_match_confidence"] == "high"
    c = w.model("customer_price_class_cross_tenant_candidates").collect()
    assert [(r["customer_key"], r["candidate_price_class_id"], r["sample_supporting_customers"]) for r in c] == [("k2", "A", "O1: ACME AS")]


def test_gaps(w):
    s = by(w.model("source_gap_supplier_invoice_line"), "line_number")
    assert {k: (v["source_gap_reason"], v["source_gap_severity"]) for k, v in s.items()} == {
        "2": ("missing_inventory_id_expected_non_item_charge", "low"), "3": ("missing_line_description", "low"),
        "4": ("missing_inventory_id_unexpected", "medium"), "5": ("missing_amount", "high")}
    assert s["3"]["inventory_id"] == "n" and s["2"]["supplier_id"] == "5"
    b = by(w.model("source_gap_procurement_line_backlog"), "source_model")
    assert b["supplier_invoice"]["backlog_priority"] == "critical" and b["supplier_invoice"]["sample_document_lines"] == "INV1:2 | INV1:3 | INV1:4 | INV1:5"
    assert b["purchase_order"]["backlog_reason"] == "small_gap_backlog" and b["purchase_order"]["sample_document_lines"] == "PO1:1"


def test_order_units(spark):
    frames = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in TABLES.items()}
    frames["seed_business_unit_mapping"] = spark.createDataFrame(
        [("t1", None, "U0", "Default", D(2020, 1, 1), None), ("t1", "7", "U7", "Seven", D(2020, 1, 1), None)], TABLES["seed_business_unit_mapping"][0])
    w = Warehouse(frames.__getitem__, MODELS)
    h = by(w.model("sales_order_header_unit"), "order_key")
    assert (h["t1|1"]["agreed_value"], h["t1|2"]["agreed_value"], h["t1|2"]["material_lines"]) == ("U7", "U7", 2) and h["t1|3"]["agreed_value"] == "U0"
    u = by(w.model("fact_sales_order_business_unit"), "order_id", "business_unit_id")
    assert u[("2", "U7")]["line_amount"] == 60 and u[("2", "U0")]["ancillary_line_count"] == 1 and u[("2", "U0")]["zero_value_line_count"] == 1
    p = by(w.model("sales_order_sales_person"), "order_id")
    assert p["1"]["sales_person_id"] == "p1" and p["2"]["sales_person_id"] == "p2" and p["2"]["from_material_lines"]


def test_access(w):
    r = by(w.model("RLS_sales_person"), "user_principal_name")
    assert set(r) == {"ann@x.com", "cy@x.com"} and r["ann@x.com"]["mapping_source"] == "manual_seed" and r["ann@x.com"]["has_active_sales_person_match"]
    assert r["cy@x.com"]["entity_code"] == "E1"
