import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyframe.models import erp_masters
from tallyframe.models.base import Warehouse
from tallyframe.models.erp import MODELS

S1, S2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
D = dt.date
BALANCE = ("tenantId string, syncedAt timestamp_ntz, organizationName string, account string, subaccountId string, subAccountCd string, branch string, ledger string, "
           "currencyId string, balanceType string, financialPeriod string, yearClosed boolean, beginningBalance double, periodToDateDebit double, periodToDateCredit double, "
           "yearToDateBalance double, beginningBalanceInCurrency double, periodToDateDebitInCurrency double, periodToDateCreditInCurrency double, "
           "yearToDateBalanceInCurrency double, lastModifiedDateTime string, isDeleted boolean")


def balance(tenant, account, sub, cd, period, amounts, currency="EUR", synced=S1, gone=None):
    return (tenant, synced, "Org", account, sub, cd, '{"number":"B1"}', "GL", currency, "A", period, False, *amounts, *amounts, "2026-01-02T00:00:00", gone)


SUPPLIER = "tenantId string, number int, name string, status string, supplierClass string, currencyId string, creditTerms string, vatZone string, vatRegistrationId string, corporateId string, lastModifiedDateTime string, isDeleted boolean"
PROJECT = ("tenantId string, projectID string, description string, status string, startDate string, endDate string, customer string, billingRule string, branch string, "
           "customerLocation string, projectManager string, defSub string, template string, visibility string, lastModifiedDateTime string")
TABLES = {
    "seed_business_unit_mapping": ("tenant_id string, source_segment_2_value string, business_unit_id string, business_unit_name string, valid_from date, valid_to date", [
        ("t1", None, "U0", "Default", D(2020, 1, 1), None), ("t1", "7", "U7", "Seven", D(2020, 1, 1), D(2025, 12, 31)), ("t1", "0", "UZ", "Zero", D(2026, 1, 1), None),
        ("t2", "9", "U9", "Nine", D(2020, 1, 1), None), ("t3", None, "UX", "Ended", D(2020, 1, 1), D(2021, 1, 1))]),
    "suppliers": (SUPPLIER, [
        ("t1", 5, "Old", "Active", None, "NOK", None, None, None, None, "2026-01-01T00:00:00", None), ("t1", 5, "New", "Hold", None, "NOK", None, None, None, None, "2026-02-01T00:00:00", False),
        ("t1", 5, "Gone", None, None, None, None, None, None, None, "2026-03-01T00:00:00", True), ("t2", 5, "Other", None, None, None, None, None, None, None, "bad", None),
        ("t3", None, "No number", None, None, None, None, None, None, None, None, None)]),
    "projects": (PROJECT, [("t1", "P1", "Bridge", "Active", "2026-01-05T00:00:00", "x", '{"number":"c1","name":"Ann"}', '{"id":"R","active":true}', None, "broken {", None,
                            '{"id":"100"}', None, '{"visibleInGl":true,"visibleInCr":"no"}', None)]),
    "subaccounts": ("tenantId string, syncedAt timestamp_ntz, organizationName string, subaccountId int, subaccountNumber string, description string, active boolean, segments string, lastModifiedDateTime string, isDeleted boolean", [
        ("t1", S1, "Org", 100, "A-1", "old", True, None, None, None),
        ("t1", S2, "Org", 100, "A-1", "new", True, json.dumps([{"segmentId": 2, "segmentValue": "7", "segmentValueDescription": "Seven"}, {"segmentId": "1", "segmentValue": "IC"}, {"segmentId": 2, "segmentValue": "later"}]), None, None),
        ("t1", S1, "Org", 101, "A-2", "x", False, "not json", None, None)]),
    "dim_subaccount": ("tenant_id string, subaccount_id string, subaccount_number string, segment2 string", [("t1", "100", "A-1", "7"), ("t1", "101", "A-2", None), ("t2", "100", "A-1", "9")]),
    "general_ledger_balances": (BALANCE, [
        balance("t1", '{"number":"1500","type":"Asset"}', "100", None, "202501", (1.0, 2.0, 0.0, 3.0)), balance("t1", '{"number":"1500","type":"Asset"}', "100", None, "202501", (1.0, 5.0, 0.0, 6.0), synced=S2),
        balance("t1", "1500", "100", None, "202601", (3.0, 0.0, 0.0, 3.0)), balance("t1", "1600", None, "A-1", "202502", (0.0, 1.0, 1.0, 0.0), "NOK"),
        balance("t2", "1500", "100", None, "202601", (7.0, 0.0, 0.0, 7.0)), balance("t3", "1500", None, None, "202601", (7.0, 0.0, 0.0, 7.0)),
        balance("t1", "gone", None, None, "202601", (1.0, 0.0, 0.0, 1.0), gone=True), balance("t1", "1700", None, None, "bad", (1.0, 0.0, 0.0, 1.0))]),
    "dim_rates": ("currency string, calendar_date date, exchange_rate decimal(18,9), rate_date date, has_market_rate boolean, is_rate_filled_forward boolean", []),
}


@pytest.fixture(scope="module")
def w(spark):
    frames = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in TABLES.items()}
    made = Warehouse(frames.__getitem__, MODELS)
    made.hold("dim_currency_market_rate_daily", spark.sql("SELECT 'EUR' currency, DATE'2025-01-01' calendar_date, 11.0D exchange_rate, DATE'2024-12-31' rate_date, true has_market_rate, true is_rate_filled_forward"))
    return made


def test_masters_keep_the_newest_row_and_the_tenants_unit(spark, w):
    as_of = F.lit("2026-02-02").cast("date")
    got = {(r["tenant_id"], r["supplier_id"]): r for r in erp_masters.master(w, "silver.dim_supplier", as_of).collect()}
    assert len(got) == 3 and got["t1", "5"]["supplier_name"] == "New" and got["t1", "5"]["business_unit_id"] == "UZ"
    assert got["t2", "5"]["business_unit_id"] == "U9" and got["t2", "5"]["last_modified_at"] is None and got["t3", None]["business_unit_id"] is None
    early = {r["tenant_id"]: r["business_unit_id"] for r in erp_masters.tenant_units(w, F.lit("2020-06-01").cast("date")).collect()}
    assert early == {"t1": "U0", "t2": "U9", "t3": "UX"}


def test_project_objects_are_opened(w):
    p = w.model("silver.dim_project").first()
    assert (p["customer_name"], p["billing_rule_active"], p["start_date"], p["end_date"], p["default_subaccount_id"]) == ("Ann", True, None, None, "100") or p["start_date"] == D(2026, 1, 5)
    assert p["visible_in_gl"] and p["visible_in_cr"] is False and p["visible_in_ap"] is None and p["customer_location_id"] is None


def test_every_master_has_its_own_columns():
    assert all(m.key in m.columns and set(m.newest) <= set(m.columns) for m in erp_masters.MASTERS.values()) and set(erp_masters.MASTERS) <= set(MODELS)


def test_subaccount_segments(w):
    s = {r["subaccount_id"]: r for r in w.model("silver.dim_subaccount").collect()}
    assert (s["100"]["subaccount_description"], s["100"]["segment1"], s["100"]["segment2"], s["100"]["segment2_value_description"], s["100"]["segment3"]) == ("new", "IC", "7", "Seven", None)
    assert s["101"]["segment1"] is None and not s["101"]["is_active"]


def test_balances_by_period(w):
    got = {(r["tenant_id"], r["account_cd"], r["financial_period"]): r for r in w.model("fact_general_ledger_balance").collect()}
    assert len(got) == 6
    a = got["t1", "1500", "202501"]
    assert (a["ptd_debit"], a["business_unit_id"], a["business_unit_match_rule"], a["branch_id"], a["account_type"]) == (5.0, "U7", "subaccount_segment2_match", "B1", "Asset")
    assert a["ytd_balance_currency_market_group"] == 66.0 and a["is_market_rate_filled_forward"] and a["market_rate_date"] == D(2024, 12, 31) and a["account_key"] == "t1|1500"
    b = got["t1", "1500", "202601"]
    assert (b["business_unit_id"], b["business_unit_match_rule"], b["has_market_rate_to_group"]) == ("U0", "tenant_default_match", False)
    assert got["t1", "1600", "202502"]["business_unit_id"] == "U7" and got["t2", "1500", "202601"]["business_unit_id"] == "U9"
    assert got["t3", "1500", "202601"]["business_unit_id"] == "t3|UNMAPPED" and got["t3", "1500", "202601"]["business_unit_match_rule"] == "no_mapping"
    assert got["t1", "1700", "bad"]["accounting_period_date"] is None
