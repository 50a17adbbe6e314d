"""Master data of the second source and its ledger balances, by configuration.

A master model is a bronze table, its key and its columns; rows are typed, the newest per key is kept and
the unit that its tenant belongs to on a day is attached. Importing this module registers the models.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions import dates, jsonx
from tallyframe.functions.keys import readable_key, surrogate_key
from tallyframe.models import erp
from tallyframe.models.base import Warehouse
from tallyframe.operators import lookups, resolve
from tallyframe.operators.latest import latest_by


def words_of(source: str) -> Column:
    return F.col(source).cast("string")


def day_of(source: str) -> Column:
    return F.col(source).cast("string").try_cast("date")


def moment_of(source: str) -> Column:
    return F.col(source).cast("string").try_cast("timestamp_ntz")


def inside(source: str, path: str) -> Column:
    """Scalar inside a nested object that is held as text."""
    return jsonx.json_scalar(jsonx.parsed(F.col(source).cast("string")), path)


def flag_inside(source: str, path: str) -> Column:
    return inside(source, path).try_cast("boolean")


@dataclass(frozen=True)
class Master:
    """``columns`` maps model columns to functions of no argument, so that nothing is planned on import."""

    table: str
    key: str
    newest: list[str]
    columns: dict[str, Callable[[], Column]] = field(default_factory=dict)


def _plain(**names: str) -> dict[str, Callable[[], Column]]:
    return {new: (lambda old=old: F.col(old)) for new, old in names.items()}


def _nested(source: str, **paths: str) -> dict[str, Callable[[], Column]]:
    return {new: (lambda path=path: inside(source, f"$.{path}")) for new, path in paths.items()}


#: Column names of the source and of the models, and the modules a project may show in.
MODIFIED = {"last_modified_at": lambda: moment_of("lastModifiedDateTime")}
VISIBLE_IN = {"gl": "Gl", "ap": "Ap", "ar": "Ar", "so": "So", "po": "Po", "ea": "Ea", "ta": "Ta", "in": "In", "ca": "Ca", "cr": "Cr"}
MASTERS = {
    "silver.dim_supplier": Master("suppliers", "supplier_id", ["last_modified_at", "supplier_name"], {
        "supplier_id": lambda: words_of("number"),
        **_plain(supplier_name="name", status="status", supplier_class="supplierClass", currency_id="currencyId", credit_terms="creditTerms",
                 vat_zone="vatZone", vat_registration_id="vatRegistrationId", corporate_id="corporateId"), **MODIFIED}),
    "silver.dim_employee": Master("employees", "employee_id", ["last_modified_at", "employee_number"], {
        **_plain(employee_id="employeeId", employee_number="employeeNumber", employee_name="employeeName", status="status", department_id="department",
                 branch="branch"), **MODIFIED}),
    "silver.dim_fixed_asset": Master("fixed_assets", "asset_id", ["last_modified_at", "asset_description"], {
        **_plain(asset_id="assetID", asset_description="description", class_id="classID", asset_type="type", record_type="recordType",
                 is_depreciable="depreciable", is_tangible="isTangible", location="location", quantity="quantity", useful_life="usefulLife",
                 book_balance="bookBalance"), **MODIFIED}),
    "silver.dim_location": Master("locations", "location_id", ["last_modified_at", "location_name"], {
        "location_id": lambda: words_of("locationId"),
        **_plain(location_name="locationName", is_active="active", address="address", vat_zone="vatZone", gln="gln", corporate_id="corporateId"), **MODIFIED}),
    "silver.dim_warehouse": Master("warehouses", "warehouse_id", ["is_active", "warehouse_name"], {
        "warehouse_id": lambda: words_of("warehouseID"),
        **_plain(warehouse_name="description", is_active="active", branch="branch", receipt_location="receiptLocation", ship_location="shipLocation",
                 locations="locations")}),
    "silver.dim_project": Master("projects", "project_id", ["last_modified_at", "project_name"], {
        "project_id": lambda: words_of("projectID"), **_plain(project_name="description", status="status"),
        "start_date": lambda: day_of("startDate"), "end_date": lambda: day_of("endDate"),
        **_nested("customer", customer_id="number", customer_name="name"),
        **_nested("billingRule", billing_rule_id="id", billing_rule_description="description"),
        "billing_rule_active": lambda: flag_inside("billingRule", "$.active"),
        **_nested("branch", branch_id="number", branch_name="name"),
        **_nested("customerLocation", customer_location_id="id", customer_location_name="name"),
        **_nested("projectManager", project_manager_employee_id="employeeId", project_manager_employee_number="employeeNumber",
                  project_manager_name="employeeName", project_manager_department="department", project_manager_status="status"),
        **_nested("defSub", default_subaccount_id="id"),
        **_nested("template", template_id="number", template_description="description", template_status="status"),
        **{f"visible_in_{k}": (lambda v=v: flag_inside("visibility", f"$.visibleIn{v}")) for k, v in VISIBLE_IN.items()}, **MODIFIED}),
}


def tenant_units(w: Warehouse, as_of: Column | None = None) -> DataFrame:
    """The unit each tenant stands for on a day: segment 0 first, then the tenant's default, then any; the newest."""
    windows = erp.windows(w)
    segment = F.col("unit_segment")
    preference = F.when(segment == "0", 1).when(segment.isNull(), 2).otherwise(3)
    open_end = F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))
    found = resolve.current_member(windows, ["tenant_id"], F.current_date() if as_of is None else as_of, "valid_from", "valid_to",
                                   [preference.asc(), open_end.desc()])
    return found.select("tenant_id", "business_unit_id", "business_unit_name")


def master(w: Warehouse, name: str, as_of: Column | None = None) -> DataFrame:
    """One row per tenant and key, the newest, with the tenant's unit."""
    m = MASTERS[name]
    rows = erp.live(w.table(m.table)).select(F.col("tenantId").alias("tenant_id"), *[made().alias(c) for c, made in m.columns.items()])
    newest = latest_by(rows, ["tenant_id", m.key], [F.desc_nulls_last(c) for c in m.newest])
    return newest.join(tenant_units(w, as_of), "tenant_id", "left")


for _name in MASTERS:
    erp.model(_name)(lambda w, name=_name: master(w, name))


@erp.model("silver.dim_subaccount")
def subaccount(w: Warehouse) -> DataFrame:
    """Subaccounts with the values of their first three segments."""
    b = erp.current(w, "subaccounts", ["tenantId", "subaccountId"])
    entries = F.from_json(F.col("segments").cast("string"), "array<struct<segmentId: string, segmentValue: string, segmentValueDescription: string>>")
    b = b.withColumn("_entries", entries)

    def first(n: str) -> Column:
        return F.get(F.filter("_entries", lambda entry: entry["segmentId"] == n), F.lit(0))

    out = [first(n)[source].alias(f"segment{n}{name}") for n in "123" for source, name in (("segmentValue", ""), ("segmentValueDescription", "_value_description"))]
    return b.select(
        F.col("tenantId").alias("tenant_id"), F.col("syncedAt").alias("synced_at"), F.col("organizationName").alias("organization_name"),
        words_of("subaccountId").alias("subaccount_id"), F.col("subaccountNumber").alias("subaccount_number"),
        F.col("description").alias("subaccount_description"), F.col("active").alias("is_active"), *out, moment_of("lastModifiedDateTime").alias("last_modified_at"))


# ---------------------------------------------------------------------------- ledger balances
#: Amounts of a period, in books and in the account's currency.
AMOUNTS = {"beginning_balance": "beginningBalance", "ptd_debit": "periodToDateDebit", "ptd_credit": "periodToDateCredit", "ytd_balance": "yearToDateBalance"}
#: What told the unit of a balance.
RULES = {"none": "no_mapping", "segment": "subaccount_segment2_match", "default": "tenant_default_match"}


@erp.model("silver.fact_general_ledger_balance")
def silver_balances(w: Warehouse) -> DataFrame:
    """Typed period balances with the unit that was theirs in that period."""
    g = erp.live(w.table("general_ledger_balances"))
    g = g.select(
        F.col("tenantId").alias("tenant_id"), F.col("syncedAt").alias("synced_at"), F.col("organizationName").alias("organization_name"),
        F.coalesce(inside("account", "$.number"), words_of("account")).alias("account_cd"), inside("account", "$.type").alias("account_type"),
        words_of("subaccountId").alias("subaccount_id"), F.col("subAccountCd").alias("subaccount_cd"),
        F.coalesce(inside("branch", "$.number"), words_of("branch")).alias("branch_id"), F.coalesce(inside("ledger", "$.id"), words_of("ledger")).alias("ledger"),
        F.col("currencyId").alias("currency_id"), F.col("balanceType").alias("balance_type"), F.col("financialPeriod").alias("financial_period"),
        dates.any_date("financialPeriod").alias("accounting_period_date"), F.col("yearClosed").alias("year_closed"),
        *[F.col(f"{source}{more}").alias(f"{name}{suffix}") for more, suffix in (("", ""), ("InCurrency", "_currency")) for name, source in AMOUNTS.items()],
        moment_of("lastModifiedDateTime").alias("last_modified_at"))
    grain = ["tenant_id", "account_cd", "subaccount_id", "branch_id", "ledger", "financial_period", "currency_id"]
    g = latest_by(g, grain, [F.desc_nulls_last("synced_at"), F.desc_nulls_last("last_modified_at")])
    subs = w.table("dim_subaccount").select("tenant_id", F.col("subaccount_id").alias("_sid"), "subaccount_number", F.col("segment2").alias("_segment2"))
    # by id, else by number
    by_id = lookups.either_key_lookup(g, subs, "subaccount_id", ["_sid"], ["_segment2"], same=["tenant_id"]).withColumnRenamed("_segment2", "_by_id")
    g = lookups.either_key_lookup(by_id, subs, "subaccount_cd", ["subaccount_number"], ["_segment2"], same=["tenant_id"])
    g = g.withColumn("_seg", F.coalesce("_by_id", "_segment2", F.lit("0"))).drop("_by_id", "_segment2")
    g = resolve.resolve_by_window(g, erp.windows(w), ["tenant_id"], "_seg", "accounting_period_date", "valid_from", "valid_to", "unit_segment",
                                  ["business_unit_id", "business_unit_name"], rule="_rule")
    rule = F.create_map(*[F.lit(x) for kv in RULES.items() for x in kv])
    return g.select(
        *[c for c in g.columns if c not in ("_seg", "_rule", "business_unit_id", "business_unit_name")],
        F.coalesce("business_unit_id", F.concat("tenant_id", F.lit("|UNMAPPED"))).alias("business_unit_id"),
        F.coalesce("business_unit_name", "organization_name").alias("business_unit_name"), rule[F.col("_rule")].alias("business_unit_match_rule"))


@erp.model("fact_general_ledger_balance")
def balances(w: Warehouse) -> DataFrame:
    """Period balances with keys, and their currency amounts at the market rate of the period's first day."""
    g = w.model("silver.fact_general_ledger_balance")
    rates = w.model("dim_currency_market_rate_daily").select(
        F.col("currency").alias("currency_id"), F.col("calendar_date").alias("accounting_period_date"), F.col("rate_date").alias("market_rate_date"),
        F.col("exchange_rate").alias("market_exchange_rate_to_group"), F.col("has_market_rate").alias("_has"), F.col("is_rate_filled_forward").alias("_filled"))
    g = g.join(rates, ["currency_id", "accounting_period_date"], "left")
    rate = F.col("market_exchange_rate_to_group").cast("double")
    return g.select(
        surrogate_key("tenant_id").alias("company_key"), surrogate_key("currency_id").alias("currency_key"), readable_key("tenant_id", "account_cd").alias("account_key"),
        *[c for c in g.columns if not c.startswith("_")], F.coalesce("_has", F.lit(False)).alias("has_market_rate_to_group"),
        F.coalesce("_filled", F.lit(False)).alias("is_market_rate_filled_forward"),
        *[(F.col(f"{c}_currency").cast("double") * rate).alias(f"{c}_currency_market_group") for c in AMOUNTS], F.lit(erp.SOURCE_SYSTEM).alias("source_system"))
