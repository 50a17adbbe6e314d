import datetime as dt
import json

from tallyframe.models.base import Warehouse
from tallyframe.models.erp import MODELS, MOVEMENTS

D = dt.date
HEAD = "tenantId string, referenceNumber string, date string, isDeleted boolean, warehouse string, toWarehouse string, {} string"


def test_movements_and_market_rates(spark):
    rows = {
        "inventory_adjustments": [{"lineNumber": 1, "inventory": {"id": "a", "description": "A"}, "quantity": "2", "amount": 5},
                                  {"lineNumber": 1, "inventory": {"id": "a"}, "quantity": "9", "amount": 1}],
        "inventory_issues": [{"lineNbr": 2, "inventory.id": "b", "warehouse": json.dumps({"id": "W"}), "quantity": 1}],
        "inventory_receipts": [],
        "inventory_transfers": [{"sortOrder": 3, "inventoryItem": {"number": "c"}, "toLocation": {"id": "T"}, "allocations": [{"x": 1}, {"x": 2}], "amount": 7}],
    }
    tables = {t: spark.createDataFrame([("t1", "R1", "2026-01-07T00:00:00", None, '{"id":"W1"}', '{"id":"W2"}', json.dumps(rows[t]))], HEAD.format(array))
              for _, t, array in MOVEMENTS}
    tables["seed_business_unit_mapping"] = spark.createDataFrame(
        [("t1", None, "U0", "Default", D(2020, 1, 1), None), ("t1", "0", "UZ", "Zero", D(2026, 1, 7), D(2026, 1, 7)), ("t1", "5", "U5", "Five", D(2020, 1, 1), None)],
        "tenant_id string, source_segment_2_value string, business_unit_id string, business_unit_name string, valid_from date, valid_to date")
    tables["market_rates"] = spark.createDataFrame([("EUR", "NOK", "11", "2026-01-05", "f", "2026-01-05 10:00:00")],
                                                   "currency_code string, quote_currency string, rate string, date string, source string, created_at string")
    tables["general_ledger_transactions"] = spark.createDataFrame([("2026-01-09", "202601")], "tranDate string, period string")
    tables["silver.fact_customer_invoice"] = spark.createDataFrame(
        [("t1", "EUR", D(2026, 1, 8), 2.0), ("t1", "NOK", D(2026, 1, 8), 3.0), ("t1", "USD", D(2026, 1, 8), 4.0), ("t1", "EUR", None, 5.0)],
        "tenant_id string, currency_id string, document_date date, amount_in_currency double")
    tables["dim_location"] = spark.createDataFrame([("t1", "U0", "L", "k1", "kt"), ("t1", "U9", "L", "k2", "kt")],
                                                   "tenant_id string, business_unit_id string, location_id string, location_key string, location_tenant_key string")
    tables["silver.fact_shipment_line"] = spark.createDataFrame([("t1", "U0", "L"), ("t1", "U7", "L"), ("t1", "U7", "X")],
                                                                "tenant_id string, business_unit_id string, location_id string")
    w = Warehouse(tables.__getitem__, MODELS)
    m = {r["movement_type"]: r for r in w.model("fact_inventory_movement_line").collect()}
    assert set(m) == {"ADJUSTMENT", "ISSUE", "TRANSFER"}
    assert m["ADJUSTMENT"]["quantity"] == 2 and m["ADJUSTMENT"]["business_unit_id"] == "UZ" and m["ADJUSTMENT"]["business_unit_resolution_method"] == "segment_zero_match"
    assert m["ISSUE"]["inventory_id"] == "b" and m["ISSUE"]["warehouse_id"] == "W" and m["ISSUE"]["line_number"] == "2"
    t = m["TRANSFER"]
    assert (t["inventory_id"], t["warehouse_id"], t["destination_warehouse_id"], t["to_location_id"], t["allocation_count"], t["amount"]) == ("c", "W1", "W2", "T", 2, None)
    assert w.model("fact_inventory_issue_line").count() == 1
    f = {(r["currency_id"], r["amount_in_currency"]): r for r in w.model("fact_customer_invoice").collect()}
    assert f[("EUR", 2.0)]["amount_in_currency_market"] == 22 and f[("EUR", 2.0)]["is_market_rate_filled_forward"] and f[("NOK", 3.0)]["amount_in_currency_market"] == 3
    assert f[("USD", 4.0)]["amount_in_currency_market"] is None and not f[("USD", 4.0)]["has_market_rate_to_group"] and len(f) == 4
    assert sorted((r["business_unit_id"], r["location_key"]) for r in w.model("fact_shipment_detail_line").filter("location_id = 'L'").collect()) == [("U0", "k1"), ("U7", "kt")]
