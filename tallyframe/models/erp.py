"""Models on the second source: wide bronze tables with nested objects as JSON text.

Bronze names are those of the source without its prefix, seeds start with ``seed_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.functions import dates, jsonx, text
from tallyframe.functions.keys import readable_key, surrogate_key
from tallyframe.functions.numbers import safe_divide
from tallyframe.models.base import Warehouse
from tallyframe.operators import aggregates as agg, fx, intervals, lookups, quality, resolve
from tallyframe.operators.latest import latest_by
from tallyframe.sources.calendar import calendar

GROUP_CURRENCY = "NOK"
SOURCE_SYSTEM = "erp"
MODELS = {}


def model(name: str):
    def wrap(fn):
        MODELS[name] = fn
        return fn
    return wrap


def live(df: DataFrame) -> DataFrame:
    """Rows not soft-deleted."""
    return df.filter(~F.col("isDeleted").eqNullSafe(True)) if "isDeleted" in df.columns else df


def current(w: Warehouse, table: str, keys: list[str], extra: list[Column] | None = None) -> DataFrame:
    return latest_by(live(w.table(table)), keys, [F.desc("syncedAt"), *(extra or [])])


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Select with new names given as ``new="old"``."""
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])


def exact(c, scale: int = 4) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast(f"decimal(20,{scale})")


def windows(w: Warehouse) -> DataFrame:
    """Business-unit windows per tenant, by segment or as tenant default."""
    return renamed(w.table("seed_business_unit_mapping"), tenant_id="tenant_id", unit_segment="source_segment_2_value",
                   business_unit_id="business_unit_id", business_unit_name="business_unit_name", valid_from="valid_from", valid_to="valid_to")


# ------------------------------------------------------------------------------ currency
@model("dim_currency_market_rate")
def market_rate(w: Warehouse) -> DataFrame:
    r = w.table("market_rates").select(
        F.col("currency_code").alias("base"), F.col("quote_currency").alias("quote"), F.col("rate").try_cast("decimal(18,9)").cast("double").alias("rate"),
        F.col("date").cast("string").try_cast("date").alias("rate_date"), F.col("source").alias("rate_source"),
        F.col("created_at").cast("string").try_cast("timestamp_ntz").alias("source_timestamp"))
    r = r.filter("base IS NOT NULL AND quote IS NOT NULL AND rate IS NOT NULL AND rate_date IS NOT NULL")
    r = latest_by(r, ["base", "quote", "rate_date"], [F.desc("source_timestamp"), F.desc("rate_source")])
    inverse = safe_divide(F.lit(1.0), "rate")
    sides = F.array(
        F.struct(F.col("base").alias("from_currency_id"), F.col("quote").alias("to_currency_id"), F.col("rate").alias("exchange_rate"),
                 inverse.alias("inverse_exchange_rate"), F.lit(False).alias("is_inverse_rate")),
        F.struct(F.col("quote").alias("from_currency_id"), F.col("base").alias("to_currency_id"), inverse.alias("exchange_rate"),
                 F.col("rate").alias("inverse_exchange_rate"), F.lit(True).alias("is_inverse_rate")))
    rows = r.select("rate_date", "rate_source", "source_timestamp", F.explode(sides).alias("s")).select("s.*", "rate_date", "rate_source", "source_timestamp")
    # one row per pair and day: the window of a pair is bounded by the calendar
    order = Window.partitionBy("from_currency_id", "to_currency_id", "is_inverse_rate").orderBy(F.desc("rate_date"))
    return rows.withColumn("is_latest_rate_for_pair", F.row_number().over(order) == 1)


@model("dim_currency_market_rate_daily")
def daily_rate(w: Warehouse) -> DataFrame:
    series = w.model("dim_currency_market_rate").filter((F.col("to_currency_id") == GROUP_CURRENCY) & ~F.col("is_inverse_rate")).select(
        F.col("from_currency_id").alias("currency"), "rate_date", F.col("exchange_rate").cast("decimal(18,6)").alias("exchange_rate"))
    # rates run to the latest day of the ledger or of any document fact that is loaded
    days = live(w.table("general_ledger_transactions")).agg(F.max(ledger_date()).alias("d"))
    for name in RATED_DOCUMENTS:
        facts = w.optional(f"silver.{name}")
        if facts is not None:
            days = days.unionByName(facts.agg(F.max(F.to_date(MARKET_FACTS[name][0])).alias("d")))
    d = fx.daily_rates(series, GROUP_CURRENCY, days.agg(F.max("d").alias("max_date")))
    return d.withColumn("inverse_rate", F.try_divide(F.lit(1.0), F.col("exchange_rate").cast("double")))


def ledger_date() -> Column:
    return F.coalesce(dates.any_date("tranDate"), dates.any_date("period"))


@model("dim_date")
def calendar_dimension(w: Warehouse) -> DataFrame:
    bounds = live(w.table("general_ledger_transactions")).agg(F.min(ledger_date()).alias("lo"), F.max(ledger_date()).alias("hi"))
    return calendar(bounds, "lo", "hi")


# ------------------------------------------------------------------------------- company
@model("dim_company")
def company(w: Warehouse) -> DataFrame:
    b = w.table("dim_branch").withColumn("is_main_branch", F.coalesce("is_main_branch", F.lit(False)))
    main = latest_by(b, ["tenant_id"], [F.desc("is_main_branch"), F.desc("synced_at"), F.asc("branch_id")])
    entity = w.table("seed_entity_mapping").filter(F.col("tenant_id").isNotNull()).groupBy(F.col("tenant_id").alias("_prefix")).agg(
        *[F.min(c).alias(c) for c in ("company_id", "entity_code", "entity_name", "group_name")])
    base = latest_by(live(w.table("organizations")).filter(F.col("baseCurrency").isNotNull()), ["tenantId"], [F.desc("syncedAt")]).select(
        F.col("tenantId").alias("tenant_id"), F.col("baseCurrency").alias("base_currency"))
    j = main.join(entity, F.substring("tenant_id", 1, 8) == F.col("_prefix"), "left").join(base, "tenant_id", "left")
    return j.select(
        surrogate_key("tenant_id").alias("company_key"), "tenant_id", "branch_id", "branch_name", "organization_name", "company_id", "entity_code",
        F.coalesce("entity_name", "organization_name").alias("entity_name"), "group_name",
        F.coalesce("base_currency", F.lit(GROUP_CURRENCY)).alias("base_currency"), F.lit(SOURCE_SYSTEM).alias("source_system"))


# ------------------------------------------------------------------------------ accounts
CHART_TEXT = ["bs_pl", "fsli_1", "fsli_2", "fsli_3", "cf1", "cf2", "cf3", "nwc", "capex"]
CHART_FLAGS = ["ebitda_flag", "net_income_flag", "intercompany_flag"]
CHART_CODES = ["account_code_1", "account_code_2", "account_code_3"]
# Codes always taken from the curated chart, and roots safe as a fallback.
PREFERRED_SEED_CODES = [5000, 5200]
FAMILY_ROOT_CODES = [
    1400, 1500, 1600, 1900, 2400, 2450, 2500, 2600, 2700, 2800, 2900, 3000, 3100, 4000, 4100, 4200, 4300, 4400, 4700, 4900,
    5000, 5100, 5200, 5400, 6000, 6100, 6200, 6300, 6400, 6500, 6600, 6700, 6800, 6900, 7000, 7100, 7700, 8000, 8100,
]


@model("chart_of_accounts")
def chart_of_accounts(w: Warehouse) -> DataFrame:
    """Source chart rows that pass the quality gates, curated rows for the codes left."""
    raw = w.table("raw_chart_of_accounts")
    src = raw.select(
        *[text.blank_to_null(F.col(c).cast("string")).alias(c) for c in CHART_TEXT], *[text.is_true_word(F.col(c).cast("string")).alias(c) for c in CHART_FLAGS],
        *[F.col(c).cast("string").try_cast("bigint").alias(c) for c in CHART_CODES])
    src = src.filter(F.col("bs_pl").isNotNull() & F.col("account_code_3").isNotNull())
    curated = w.table("seed_chart_of_accounts").withColumn("intercompany_flag", F.lit(False)).select(
        *CHART_TEXT, *CHART_FLAGS, *[F.col(c).cast("bigint").alias(c) for c in CHART_CODES])
    lines = ["fsli_1", "fsli_2", "fsli_3"]
    weak = F.lit(False)
    for c in lines:
        weak = weak | F.col(c).isNull() | F.coalesce(F.col(c).rlike(r"^\d+$"), F.lit(False))
    gates = src.groupBy("account_code_3").agg(F.count(F.lit(1)).alias("_n"), F.max(weak).alias("_weak"))
    seeded = curated.select("account_code_3").distinct().withColumn("_seeded", F.lit(True))
    gates = gates.join(seeded, "account_code_3", "left").withColumn("_seeded", F.coalesce("_seeded", F.lit(False)))
    keep = (~F.col("account_code_3").isin(PREFERRED_SEED_CODES)) & (
        ((F.col("_n") == 1) & ~(F.col("_weak") & F.col("_seeded"))) | ((F.col("_n") > 1) & ~F.col("_seeded")))
    order = [*[F.col(c).isNotNull().desc() for c in reversed(lines)], *[F.length(F.coalesce(c, F.lit(""))).desc() for c in reversed(lines)],
             *[F.asc_nulls_last(c) for c in lines]]
    chosen = latest_by(src.join(gates.filter(keep).select("account_code_3"), "account_code_3"), ["account_code_3"], order).withColumn("_source", F.lit("bronze"))
    rest = curated.join(chosen.select("account_code_3"), "account_code_3", "left_anti").withColumn("_source", F.lit("seed"))
    return chosen.unionByName(rest)


@model("global_account_mapping")
def account_ranges(w: Warehouse) -> DataFrame:
    s = w.table("seed_global_account_range_mapping")
    start = F.col("range_start_account_code")
    cap = F.when(F.col("local_account_digits") == 4, F.lit(9999)).when(F.col("local_account_digits") == 5, F.lit(99999)).otherwise(start)
    return intervals.breakpoint_ranges(s, ["mapping_scope", "local_account_digits"], "range_start_account_code", "range_end_account_code", cap)


@model("dim_account")
def account(w: Warehouse) -> DataFrame:
    """Accounts with their place in the group chart and the method that found it."""
    a = current(w, "accounts", ["tenantId", "accountCD"], [F.desc("lastModifiedDateTime")]).select(
        F.col("tenantId").alias("tenant_id"), F.col("organizationName").alias("organization_name"), F.col("accountCD").cast("string").alias("account_cd"),
        F.col("accountCD").cast("string").try_cast("bigint").alias("account_cd_numeric"), F.col("type").alias("account_type"),
        F.col("description").alias("account_description"))
    scopes = w.table("seed_global_account_mapping_scope").filter("mapping_scope = 'NO_SE_DK'").select("organization_name", F.lit(True).alias("_scoped")).distinct()
    five = F.try_divide(F.count_if(F.length("account_cd") == 5), F.count(F.lit(1)))
    profile = a.join(scopes, "organization_name", "left").groupBy("tenant_id").agg(
        F.when(F.count("_scoped") > 0, "global_no_se_dk_chart").when(five >= 0.5, "local_five_digit_chart").otherwise("group_excel_chart").alias("account_mapping_profile"))
    a = a.join(profile, "tenant_id")
    chart = w.model("chart_of_accounts").select(F.col("account_code_3").alias("_code"), F.struct(*CHART_CODES, *CHART_TEXT, *CHART_FLAGS, "_source").alias("_row"))

    def through_chart(rel: DataFrame, code: str, tag: str) -> DataFrame:
        return rel.join(chart.withColumnRenamed("_row", tag), F.col(code) == F.col("_code")).drop("_code", code)

    num = F.col("account_cd_numeric")
    em = through_chart(w.table("seed_company_account_mapping").select("organization_name", F.col("local_account_code").alias("_l"), F.col("mapped_account_code_3").alias("_m")), "_m", "em")
    a = a.join(em, (F.col("_l") == num) & (a["organization_name"] == em["organization_name"]), "left").drop(em["organization_name"]).drop("_l")
    ranges = through_chart(w.model("global_account_mapping").filter("mapping_scope = 'NO_SE_DK'").select(
        F.col("local_account_digits").alias("_digits"), F.col("range_start_account_code").alias("_s"), F.col("range_end_account_code").alias("_e"),
        F.col("mapped_account_code_3").alias("_m")), "_m", "gm")
    a = a.join(ranges, (F.col("account_mapping_profile") == "global_no_se_dk_chart") & F.col("em").isNull()
               & (F.length(num.cast("string")) == F.col("_digits")) & num.between(F.col("_s"), F.col("_e")), "left")
    charted = F.col("account_mapping_profile").isin("group_excel_chart", "global_no_se_dk_chart")
    a = a.join(chart.withColumnRenamed("_row", "ex"), charted & F.col("gm").isNull() & (num == F.col("_code")), "left").drop("_code")
    roots = w.model("chart_of_accounts").filter((F.col("account_code_3") == F.col("account_code_2")) & F.col("account_code_2").isin(FAMILY_ROOT_CODES)).select(
        F.col("account_code_2").alias("_root"), F.struct(*CHART_CODES, *CHART_TEXT, *CHART_FLAGS, "_source").alias("rt"))
    a = a.join(roots, charted & F.col("gm").isNull() & F.col("ex").isNull() & num.between(1000, 9999)
               & (F.floor(num / 100) * 100 == F.col("_root")), "left")
    native = F.create_map(*[F.lit(x) for kv in {
        "Asset": "BS", "Liability": "BS", "Income": "P&L", "Expense": "P&L"}.items() for x in kv])[F.col("account_type")]
    first_line = F.create_map(*[F.lit(x) for kv in {
        "Asset": "Assets", "Liability": "Equity and liabilities", "Income": "Revenue", "Expense": "Operating expenses"}.items() for x in kv])[F.col("account_type")]
    method = quality.classify([
        (F.col("em").isNotNull(), "company_workbook_exact_match"), (F.col("gm").isNotNull() & (num == F.col("_s")), "global_account_exact_match"),
        (F.col("gm").isNotNull(), "global_previous_account_range_fallback"), (F.col("ex").isNotNull(), "exact_account_cd_match"),
        (F.col("rt").isNotNull(), "account_family_root_fallback"), (native.isNotNull(), "native_account_type_fallback")], "unmapped")
    a = a.withColumn("_hit", F.coalesce("em", "gm", "ex", "rt"))
    found = F.coalesce("em", "gm", "ex").isNotNull()
    third = F.when(found, F.col("_hit.fsli_3")).when(F.col("rt").isNotNull(), F.coalesce("rt.fsli_2", "rt.fsli_1", "rt.fsli_3"))
    return a.select(
        readable_key("tenant_id", "account_cd").alias("account_key"), "tenant_id", "organization_name", "account_cd", "account_cd_numeric", "account_type",
        "account_description", "account_mapping_profile", *[F.col(f"_hit.{c}").alias(c) for c in CHART_CODES],
        F.coalesce("_hit.bs_pl", native).alias("bs_pl"), F.coalesce("_hit.fsli_1", first_line).alias("fsli_1"), F.col("_hit.fsli_2").alias("fsli_2"),
        third.alias("fsli_3"), F.col("_hit.ebitda_flag").alias("is_ebitda"), F.col("_hit.net_income_flag").alias("is_net_income"),
        F.col("_hit").isNotNull().alias("has_chart_of_accounts_mapping"), method.alias("account_mapping_method"))


# -------------------------------------------------------------------------------- ledger
@model("silver.fact_general_ledger")
def silver_ledger(w: Warehouse) -> DataFrame:
    """Typed postings with project, department and business unit."""
    g = live(w.table("general_ledger_transactions"))
    acc, br, led = (jsonx.parsed(F.col(c).cast("string")) for c in ("account", "branch", "ledger"))
    g = g.select(
        F.col("tenantId").alias("tenant_id"), F.col("syncedAt").alias("synced_at"), F.col("organizationName").alias("organization_name"),
        F.col("batchNumber").alias("batch_number"), F.col("refNumber").alias("ref_number"), F.col("lineNumber").cast("string").alias("line_number"),
        F.coalesce(jsonx.json_scalar(acc, "$.number"), F.col("account")).alias("account_cd"), jsonx.json_scalar(acc, "$.type").alias("account_type"),
        F.col("subaccount").alias("subaccount_id"), F.coalesce(jsonx.json_scalar(br, "$.number"), F.col("branch")).alias("branch_id"),
        F.coalesce(jsonx.json_scalar(led, "$.id"), F.col("ledger")).alias("ledger"), F.col("currency").alias("currency_id"), "module",
        ledger_date().alias("transaction_date"), F.col("period").alias("financial_period"), "description",
        F.col("debitAmount").alias("debit_amount"), F.col("creditAmount").alias("credit_amount"),
        F.col("currDebitAmount").alias("debit_amount_currency"), F.col("currCreditAmount").alias("credit_amount_currency"))
    g = latest_by(g, ["tenant_id", "batch_number", "ref_number", "line_number"], [F.desc("synced_at")])
    project = jsonx.json_scalar(jsonx.parsed("project"), "$.id")
    projects = live(w.table("customer_documents")).groupBy(F.col("tenantId").alias("tenant_id"), F.col("referenceNumber").alias("ref_number")).agg(
        agg.only_value(project).alias("project_id")).filter("project_id IS NOT NULL").withColumn("module", F.lit("AR"))
    g = g.join(projects, ["tenant_id", "ref_number", "module"], "left")
    sub = w.table("dim_subaccount").select("tenant_id", F.col("subaccount_id").alias("_sid"), "subaccount_number", F.col("segment2").alias("segment2_value"), F.col("segment3").alias("department_id"))
    g = lookups.either_key_lookup(g, sub, "subaccount_id", ["_sid", "subaccount_number"], ["segment2_value", "department_id"], same=["tenant_id"])
    g = g.withColumn("_seg", F.coalesce("segment2_value", F.lit("0")))
    g = resolve.resolve_by_window(g, windows(w), ["tenant_id"], "_seg", "transaction_date", "valid_from", "valid_to", "unit_segment",
                                  ["business_unit_id", "business_unit_name"])
    return g.select(
        *[c for c in g.columns if c not in ("_seg", "segment2_value", "business_unit_id", "business_unit_name")],
        F.coalesce("business_unit_id", F.concat("tenant_id", F.lit("|UNMAPPED"))).alias("business_unit_id"),
        F.coalesce("business_unit_name", "organization_name").alias("business_unit_name"))


@model("fact_general_ledger")
def ledger(w: Warehouse) -> DataFrame:
    """Ledger with functional currency and both daily rates."""
    g = w.model("silver.fact_general_ledger")
    co = w.model("dim_company").select("tenant_id", "company_key", "base_currency", "entity_code", F.col("group_name").alias("company_group_name"), "entity_name")
    g = g.join(co, "tenant_id", "left").withColumn("base_currency", F.coalesce("base_currency", F.lit(GROUP_CURRENCY)))
    d = w.model("dim_currency_market_rate_daily")
    info = d.select(F.col("currency").alias("currency_id"), F.col("calendar_date").alias("transaction_date"), F.col("exchange_rate").alias("market_exchange_rate"),
                    F.col("rate_date").alias("market_rate_date"), "has_market_rate", "is_rate_filled_forward")
    g = g.join(info, ["currency_id", "transaction_date"], "left")
    g = fx.attach_rate(g, d, F.col("base_currency"), F.col("transaction_date"), "base_currency_market_rate")
    rate = F.col("market_exchange_rate").cast("double")
    return g.select(
        "*", dates.date_key("transaction_date").alias("date_key"), readable_key("tenant_id", "account_cd").alias("account_key"),
        F.coalesce("has_market_rate", F.lit(False)).alias("has_market_rate_to_group"),
        *[(F.col(c) * rate).alias(f"{c}_market") for c in ("debit_amount_currency", "credit_amount_currency")],
    ).drop("has_market_rate")


@model("BI_FinanceTable")
def bi_finance(w: Warehouse) -> DataFrame:
    g = w.model("fact_general_ledger")
    def net(d, c):
        return F.coalesce(exact(d, 2), F.lit(0).cast("decimal(18,2)")) - F.coalesce(exact(c, 2), F.lit(0).cast("decimal(18,2)"))
    books = F.when((F.coalesce("debit_amount", F.lit(0.0)) != 0) | (F.coalesce("credit_amount", F.lit(0.0)) != 0), net("debit_amount", "credit_amount"))
    # equal sides cancel to zero but are still a books amount
    local = net("debit_amount_currency", "credit_amount_currency")
    group = fx.group_amount(F.col("base_currency"), GROUP_CURRENCY, books, F.col("base_currency_market_rate"), local, F.col("market_exchange_rate"))
    acc = w.model("dim_account").select("account_key", "account_description", "fsli_1", "fsli_2", "fsli_3")
    sub = w.table("dim_subaccount").select("tenant_id", F.col("subaccount_id").alias("_sid"), "subaccount_number", F.col("segment1").alias("ic_code_id"),
                                           F.col("segment1_value_description").alias("ic_name"), F.col("segment3").alias("department_code_id"),
                                           F.col("segment3_value_description").alias("department_name"))
    wide = g.join(acc, "account_key", "left")
    wide = lookups.either_key_lookup(wide, sub, "subaccount_id", ["subaccount_number", "_sid"],
                                     ["ic_code_id", "ic_name", "department_code_id", "department_name"], same=["tenant_id"])
    return wide.select(
        surrogate_key("tenant_id", "batch_number", "ref_number", "line_number").alias("finance_row_key"), "date_key",
        F.col("transaction_date").alias("date"), F.year("transaction_date").alias("year"), F.month("transaction_date").alias("month"), "financial_period",
        F.substring("financial_period", 1, 4).try_cast("int").alias("financial_year"), F.substring("financial_period", 5, 2).try_cast("int").alias("financial_month"),
        "company_key", "tenant_id", "entity_code", text.code_label("entity_code", "entity_name").alias("entity"), "business_unit_id", "business_unit_name",
        F.col("company_group_name").alias("group_name"), "account_key", "account_cd", text.code_label("account_cd", "account_description").alias("accounts"),
        "fsli_1", "fsli_2", "fsli_3", local.cast("double").alias("amount_local_currency"), F.col("currency_id").alias("local_currency_id"),
        group.cast("double").alias("amount_group"), text.code_label("department_code_id", "department_name").alias("department_code"),
        text.code_label("ic_code_id", "ic_name").alias("ic"), "batch_number", "ref_number", "line_number", "module", "ledger", "description",
        "subaccount_id", "branch_id", F.col("market_exchange_rate").cast("double").alias("market_exchange_rate"), "has_market_rate_to_group",
        "is_rate_filled_forward")


@model("dim_missing_gl_accounts")
def missing_accounts(w: Warehouse) -> DataFrame:
    used = w.model("silver.fact_general_ledger").select("tenant_id", "account_cd").distinct()
    balances = w.table("general_ledger_balances").select(F.col("tenantId").alias("tenant_id"), F.col("account").alias("account_cd"), F.lit(True).alias("_bal")).distinct()
    rest = w.model("dim_account").join(used, ["tenant_id", "account_cd"], "left_anti").join(balances, ["tenant_id", "account_cd"], "left")
    has = F.coalesce("_bal", F.lit(False))
    return rest.select(
        "account_key", "tenant_id", "account_cd", "account_type", "account_mapping_method", has.alias("has_gl_balance"),
        F.when(has, "missing_from_gl_transactions_but_present_in_gl_balance").otherwise("missing_from_gl_transactions_and_gl_balance").alias("missing_gl_reason"))


# --------------------------------------------------------------------------- price class
# Fixed value: open end that leaves room for the day after it.
OPEN_PRICE_END = "9999-12-30"


def class_prices(w: Warehouse) -> DataFrame:
    p = live(w.table("customer_sales_prices")).filter((F.col("priceType") == "CustomerPriceClass") & F.col("priceCode").isNotNull())
    return p.select(
        F.col("tenantId").alias("tenant_id"), F.col("priceCode").alias("price_class_id"), F.col("inventoryId").alias("inventory_id"),
        F.col("price").cast("string").try_cast("decimal(18,4)").alias("price"), dates.any_date("effectiveDate").alias("effective_on"),
        dates.any_date("expirationDate").alias("expires_on"), F.coalesce(F.col("breakQty").cast("double"), F.lit(0.0)).alias("break_qty"),
        F.coalesce("promotion", F.lit(False)).alias("promotion"))


def orders(w: Warehouse) -> DataFrame:
    o = live(w.table("sales_orders")).filter(F.col("customerId").isNotNull())
    o = o.withColumn("_no", F.coalesce("orderNo", "orderId")).withColumn("_type", F.coalesce("orderType", "type"))
    return latest_by(o, ["tenantId", "_no", "_type"], [F.desc("syncedAt")]).select(
        F.col("tenantId").alias("tenant_id"), F.col("customerId").alias("customer_id"), F.col("location").alias("location_id"),
        dates.any_date("date").alias("order_date"), "lines")


def locations(w: Warehouse) -> DataFrame:
    return renamed(current(w, "customer_locations", ["tenantId", "customerId", "locationId"]), tenant_id="tenantId", customer_id="customerId",
                   location_id="locationId", price_class_id="priceClassId").filter(F.col("price_class_id").isNotNull())


def signature_matches(w: Warehouse) -> DataFrame:
    """Days on which a customer paid the list price of a class, from lines without manual pricing."""
    line = F.explode(jsonx.json_array(jsonx.parsed("lines"), "$")).alias("l")
    l = orders(w).select("tenant_id", "customer_id", "order_date", line).select(
        "tenant_id", "customer_id", "order_date", jsonx.json_scalar("l", "$.inventory.id").alias("inventory_id"),
        jsonx.json_number("l", "$.unitPrice", "decimal(18,4)").alias("price"),
        F.coalesce(jsonx.json_scalar("l", "$.hasManualPrice"), F.lit("false")).alias("mp"), F.coalesce(jsonx.json_scalar("l", "$.hasManualDiscount"), F.lit("false")).alias("md"),
        F.coalesce(jsonx.json_number("l", "$.discountPercent", "decimal(18,4)"), F.lit(0).cast("decimal(18,4)")).alias("disc"))
    l = l.filter("inventory_id IS NOT NULL AND price > 0 AND mp = 'false' AND md = 'false' AND disc = 0")
    seen = l.groupBy("tenant_id", "customer_id", "inventory_id", "price", "order_date").agg(F.count(F.lit(1)).alias("n"))
    listed = class_prices(w).filter("inventory_id IS NOT NULL AND price > 0 AND break_qty = 0 AND NOT promotion").select(
        "tenant_id", "inventory_id", "price", "price_class_id", "effective_on", "expires_on")
    hit = seen.join(listed, ["tenant_id", "inventory_id", "price"]).filter(
        (F.col("effective_on").isNull() | (F.col("effective_on") <= F.col("order_date"))) & (F.col("expires_on").isNull() | (F.col("order_date") <= F.col("expires_on"))))
    return hit.groupBy("tenant_id", "customer_id", "price_class_id", "order_date").agg(F.sum("n").alias("n"))


def located_orders(w: Warehouse) -> DataFrame:
    """Order counts per customer, class of the order's location and day."""
    o = orders(w).filter(F.col("location_id").isNotNull()).groupBy("tenant_id", "customer_id", "location_id", "order_date").agg(F.count(F.lit(1)).alias("n"))
    return o.join(locations(w), ["tenant_id", "customer_id", "location_id"])


@model("bridge_customer_price_class")
def price_class_bridge(w: Warehouse) -> DataFrame:
    key = ["tenant_id", "customer_id"]
    direct = located_orders(w).groupBy(*key, "location_id", "price_class_id").agg(F.sum("n").alias("evidence_count")).withColumn(
        "evidence_method", F.lit("sales_order_order_location_price_class"))
    found = signature_matches(w).groupBy(*key, "price_class_id").agg(F.sum("n").alias("evidence_count"))
    single = found.groupBy(*key).agg(agg.only_value("price_class_id").alias("price_class_id"), F.sum("evidence_count").alias("evidence_count")).filter(
        "price_class_id IS NOT NULL").join(direct.select(*key), key, "left_anti")
    rows = direct.unionByName(single.withColumn("location_id", F.lit(None).cast("string")).withColumn(
        "evidence_method", F.lit("sales_order_price_signature_inferred")))
    per = rows.groupBy(*key, "price_class_id", F.col("evidence_method").alias("source_field")).agg(F.count("location_id").alias("location_count_for_price_class"))
    few = agg.distinct_samples(rows, [*key, "price_class_id"], "location_id", 10, "sample_location_ids")
    classes = rows.groupBy(*key).agg(F.count_distinct("price_class_id").alias("distinct_price_class_count"))
    activity = orders(w).groupBy(*key).agg(F.count(F.lit(1)).alias("sales_order_count"), F.max("order_date").alias("last_sales_order_date"))
    book = renamed(current(w, "price_classes", ["tenantId", "id"]), tenant_id="tenantId", price_class_id="id", price_class_description="description")
    return per.join(few, [*key, "price_class_id"], "left").join(classes, key).join(activity, key, "left").join(book, ["tenant_id", "price_class_id"], "left").select(
        surrogate_key(*key).alias("customer_key"), "*", (F.col("distinct_price_class_count") > 1).alias("customer_has_multiple_price_classes"))


@model("bridge_customer_price_class_period")
def price_class_periods(w: Warehouse, as_of: Column | None = None) -> DataFrame:
    """Customer x class x merged price window with the evidence inside it; ``as_of`` decides what is current."""
    as_of = F.current_date() if as_of is None else as_of
    raw = class_prices(w).filter("effective_on IS NOT NULL").withColumn("valid_to", F.coalesce("expires_on", F.lit(OPEN_PRICE_END).cast("date")))
    span = intervals.merge_intervals(raw, ["tenant_id", "price_class_id"], "effective_on", "valid_to").select(
        "tenant_id", "price_class_id", F.col("effective_on").alias("valid_from"), "valid_to")
    direct = located_orders(w).groupBy("tenant_id", "customer_id", "price_class_id", "order_date").agg(F.sum("n").alias("n")).withColumn("_pr", F.lit(1))
    evidence = direct.unionByName(signature_matches(w).withColumn("_pr", F.lit(2))).filter("order_date IS NOT NULL")
    placed = lookups.validity_join(evidence, span, ["tenant_id", "price_class_id"], "order_date", "valid_from", "valid_to")
    key = ["tenant_id", "customer_id", "price_class_id", "valid_from", "valid_to"]
    per = placed.groupBy(*key, "_pr").agg(F.sum("n").alias("evidence_count"), F.min("order_date").alias("first_order_date_in_window"),
                                          F.max("order_date").alias("last_order_date_in_window"))
    best = latest_by(per, key, [F.asc("_pr"), F.desc("evidence_count")])
    counts = best.groupBy("tenant_id", "customer_id").agg(F.count(F.lit(1)).alias("price_class_period_count"),
                                                          F.count_distinct("price_class_id").alias("distinct_price_class_count"))
    return best.join(counts, ["tenant_id", "customer_id"]).select(
        surrogate_key("tenant_id", "customer_id").alias("customer_key"), *key, as_of.between(F.col("valid_from"), F.col("valid_to")).alias("is_current"),
        "first_order_date_in_window", "last_order_date_in_window", "evidence_count",
        F.when(F.col("_pr") == 1, "sales_order_order_location_price_class").otherwise("sales_order_price_signature_inferred").alias("source_method"),
        "price_class_period_count", "distinct_price_class_count", (F.col("distinct_price_class_count") > 1).alias("customer_has_multiple_price_classes"))


# ----------------------------------------------------------------------- customer groups
@model("customer_match_base")
def customer_matches(w: Warehouse) -> DataFrame:
    c = w.table("dim_customer")
    corporate = text.real_identifier("corporate_id")
    country = text.blank_to_null(F.upper("main_country"))
    method, value = resolve.match_key(corporate, text.normalize_identifier("customer_name"), country, F.concat("tenant_id", F.lit("|"), "customer_id"))
    return c.select("*", corporate.alias("corporate_id_norm"), country.alias("main_country_norm"), method.alias("combined_match_method"),
                    value.alias("combined_match_value")).withColumn("customer_combined_key", readable_key("combined_match_method", "combined_match_value"))


@model("dim_customer_combined")
def customers_combined(w: Warehouse) -> DataFrame:
    m = w.model("customer_match_base")
    g = ["customer_combined_key", "combined_match_method", "combined_match_value"]
    newest_first = -F.unix_micros(F.col("synced_at").cast("timestamp"))
    groups = resolve.group_entities(
        m, g, "tenant_id", "price_class_id", "customer_key", "customer_name",
        [F.col("price_class_id").isNull(), F.col("corporate_id_norm").isNull(), newest_first, F.col("tenant_id"), F.col("customer_id")])
    return groups.withColumnsRenamed({
        "member_count": "customer_reference_count", "attribute_count": "price_class_populated_count", "distinct_attributes": "distinct_price_class_count",
        "unified_attribute": "unified_price_class_id", "representative": "representative_customer_key", "sample_names": "sample_customer_names",
        "is_cross_tenant": "is_cross_tenant_customer", "has_safe_attribute": "has_safe_unified_price_class"})


@model("bridge_customer_to_combined")
def customer_bridge(w: Warehouse) -> DataFrame:
    g = w.model("dim_customer_combined").select("customer_combined_key", "tenant_count", "customer_reference_count", "distinct_price_class_count",
                                                "unified_price_class_id", "is_cross_tenant_customer", "has_safe_unified_price_class")
    return w.model("customer_match_base").join(g, "customer_combined_key").withColumn(
        "combined_match_confidence", resolve.match_confidence(F.col("combined_match_method")))


@model("customer_price_class_cross_tenant_candidates")
def class_candidates(w: Warehouse) -> DataFrame:
    b = w.model("bridge_customer_to_combined")
    book = renamed(current(w, "price_classes", ["tenantId", "id"]), tenant_id="tenantId", candidate_price_class_id="id", candidate_price_class_description="description")
    open_rows = b.filter(F.col("price_class_id").isNull() & F.col("is_cross_tenant_customer") & F.col("has_safe_unified_price_class")
                         & (F.col("combined_match_method") == "corporate_id")).withColumnRenamed("unified_price_class_id", "candidate_price_class_id")
    support = b.groupBy("customer_combined_key").agg(
        F.count("price_class_id").alias("supporting_rows_with_price_class"),
        F.count_distinct(F.when(F.col("price_class_id").isNotNull(), F.col("tenant_id"))).alias("supporting_tenants_with_price_class"))
    named = b.filter(F.col("price_class_id").isNotNull()).withColumn("_n", F.concat("organization_name", F.lit(": "), "customer_name"))
    few = agg.distinct_samples(named, ["customer_combined_key"], "_n", 8, "sample_supporting_customers")
    return open_rows.join(book, ["tenant_id", "candidate_price_class_id"]).join(support, "customer_combined_key", "left").join(
        few, "customer_combined_key", "left")


# --------------------------------------------------------------------------- source gaps
# Words of expected charge and service lines.
SUPPLIER_CHARGES = r"(TOTAL|FRAKT|FORTOLLING|EMBALLASJE|PALL|GEBYR|RENTE|OTP|PENSJON|INNSKUDDSPENSJON|ADMINISTRASJON|FORDELT PR\.? AVD)"
ORDER_CHARGES = r"(FRAKT|FORTOLLING|EMBALLASJE|PALL|GEBYR|AVGIFT|PROGRAMMERING|INTEGRERING|SERVICE|ADMINISTRASJON)"


def gap_lines(df: DataFrame, array: str, reference: str, kind: str, numbers: list[str], items: list[str], descriptions: list[str],
              amounts: list[str], charges: str, expected: str) -> DataFrame:
    """Lines without item, description or amount, classified; values sit under one of several paths."""
    def any_of(paths, node="l"):
        # "inner" paths read the inventory object that some lines carry as JSON inside text
        return F.coalesce(*[jsonx.json_scalar("_inner", p.removeprefix("inner ")) if p.startswith("inner ") else jsonx.json_scalar(node, p) for p in paths])
    head = jsonx.parsed("supplier")
    rows = live(df).select(
        F.col("tenantId").alias("tenant_id"), F.col("organizationName").alias("organization_name"), F.col(reference).alias("document_reference"),
        F.col(kind).alias("document_type"), dates.any_date("date").alias("document_date"), any_of(["$.number", "$.id", "$.internalId"], head).alias("supplier_id"),
        jsonx.json_scalar(head, "$.name").alias("supplier_name"), F.explode(jsonx.json_array(jsonx.parsed(array), "$")).alias("l"))
    rows = rows.withColumn("_inner", jsonx.double_encoded("l", "$.inventory"))
    rows = rows.select(
        "*", any_of(numbers).alias("line_number"), any_of(items).alias("inventory_id"), any_of(descriptions).alias("line_description"),
        any_of(amounts).try_cast("decimal(18,4)").alias("amount"), F.to_json("l").alias("source_line_json")).drop("l", "_inner")
    no_id, no_text, no_amount = F.col("inventory_id").isNull(), text.blank_to_null("line_description").isNull(), F.col("amount").isNull()
    charge = F.upper(F.trim(F.coalesce("line_description", F.lit("")))).rlike(charges)
    reason = quality.classify([
        (no_amount, "missing_amount"), (no_id & no_text, "missing_inventory_id_and_description"), (no_id & charge, f"missing_inventory_id_expected_{expected}"),
        (no_id, "missing_inventory_id_unexpected"), (no_text, "missing_line_description")], "ok")
    severity = quality.classify([(no_amount, "high"), (no_id & ~charge, "medium")], "low")
    return rows.filter(no_id | no_text | no_amount).select("*", charge.alias("is_expected_charge"), reason.alias("source_gap_reason"), severity.alias("source_gap_severity"))


# Places of the inventory id, most reliable first.
INVENTORY_PATHS = ["$.inventory.number", "inner $.number", "$.inventory.id", "$['inventory.id']", "inner $.id", "$.inventoryId"]


@model("source_gap_supplier_invoice_line")
def supplier_gaps(w: Warehouse) -> DataFrame:
    return gap_lines(
        w.table("supplier_invoices"), "invoiceLines", "referenceNumber", "documentType", ["$.lineNumber", "$.lineNbr", "$.sortOrder"],
        ["$.inventoryNumber", *INVENTORY_PATHS], ["$.transactionDescription", "$.lineDescription", "$.description", "inner $.description"],
        ["$.costInCurrency", "$.cost", "$.amount", "$.extendedPrice", "$.lineTotalBeforeDiscount"], SUPPLIER_CHARGES, "non_item_charge")


@model("source_gap_purchase_order_line")
def order_gaps(w: Warehouse) -> DataFrame:
    return gap_lines(
        w.table("purchase_orders"), "lines", "orderNbr", "orderType", ["$.lineNbr", "$.lineNumber", "$.sortOrder"], INVENTORY_PATHS,
        ["$.lineDescription", "$.description", "inner $.description"], ["$.amount", "$.extCost"], ORDER_CHARGES, "service_or_charge")


@model("source_gap_procurement_line_backlog")
def gap_backlog(w: Warehouse) -> DataFrame:
    gaps = w.model("source_gap_supplier_invoice_line").withColumn("source_model", F.lit("supplier_invoice")).unionByName(
        w.model("source_gap_purchase_order_line").withColumn("source_model", F.lit("purchase_order")))
    key = ["source_model", "tenant_id", "organization_name", "supplier_id", "supplier_name"]
    sev, why = F.col("source_gap_severity"), F.col("source_gap_reason")
    a = gaps.groupBy(*key).agg(
        F.count(F.lit(1)).alias("gap_row_count"), F.count_distinct("document_reference").alias("distinct_document_count"),
        F.min("document_date").alias("first_gap_date"), F.max("document_date").alias("latest_gap_date"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("total_gap_amount_source"),
        *[F.count_if(sev == s).alias(f"{s}_severity_gap_count") for s in ("high", "medium", "low")],
        F.count_if(why == "missing_inventory_id_unexpected").alias("unexpected_inventory_gap_count"),
        F.count_if(why.startswith("missing_inventory_id_expected")).alias("expected_charge_or_service_gap_count"))
    ref = F.concat("document_reference", F.lit(":"), F.coalesce("line_number", F.lit("?")))
    few = agg.distinct_samples(gaps.withColumn("_s", ref), key, "_s", 8, "sample_document_lines")
    # Thresholds of the ladder with priority and reason.
    steps = [
        (F.col("high_severity_gap_count") > 0, "critical", "missing_amount_present"),
        (F.col("unexpected_inventory_gap_count") >= 250, "critical", "large_unexpected_inventory_gap_volume"),
        (F.col("unexpected_inventory_gap_count") >= 100, "high", "high_unexpected_inventory_gap_volume"),
        (F.col("total_gap_amount_source") >= 100000, "high", "high_gap_amount"),
        (F.col("unexpected_inventory_gap_count") >= 25, "medium", "moderate_unexpected_inventory_gap_volume"),
        (F.col("gap_row_count") >= 50, "medium", "moderate_total_gap_volume")]
    j = join_null_safe(a, few, key)
    return j.select("*", quality.classify([(c, p) for c, p, _ in steps], "low").alias("backlog_priority"),
                    quality.classify([(c, r) for c, _, r in steps], "small_gap_backlog").alias("backlog_reason"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join where NULL key parts match each other."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(r, on, "left").drop(*[f"_r_{k}" for k in keys])


# --------------------------------------------------------------------------- sales orders
@model("sales_order_lines_with_unit")
def order_lines(w: Warehouse) -> DataFrame:
    """Order lines with strategy, unit of their segment and material flags."""
    base = current(w, "sales_orders", ["tenantId", "orderId"], [F.desc("lastModifiedDateTime")])
    l = base.select(F.col("tenantId").alias("tenant_id"), F.col("orderId").alias("order_id"), dates.any_date("date").alias("order_date"),
                    F.posexplode(jsonx.json_array(jsonx.parsed(F.coalesce("orderLines", "lines")), "$")).alias("pos", "l"))
    amount = F.coalesce(*[jsonx.json_number("l", p, "decimal(18,4)") for p in ("$.amount", "$.extendedPrice", "$.lineTotalBeforeDiscount")],
                        F.lit(0).cast("decimal(18,4)"))
    rank = F.coalesce(*[jsonx.json_number("l", p, "bigint") for p in ("$.sortOrder", "$.lineNbr", "$.lineId")], F.col("pos").cast("bigint") + 1)
    l = l.select(
        "tenant_id", "order_id", F.coalesce("order_date", dates.any_date(jsonx.json_scalar("l", "$.orderDate"))).alias("business_date"),
        jsonx.json_scalar("l", "$.lineType").alias("line_type"), jsonx.first_scalar("l", "$.inventory.id", "$.inventoryId").alias("inventory_id"),
        jsonx.first_scalar("l", "$.accountId", "$.salesAccountId").alias("sales_account_id"),
        jsonx.first_scalar("l", "$.salesPersonId", "$.salesPerson.salespersonID", "$.salesPerson.id").alias("sales_person_id"),
        F.coalesce(jsonx.json_scalar("l", "$.subaccount['2']"), F.lit("0")).alias("segment_2"),
        amount.alias("line_amount"), rank.alias("line_rank")).withColumn("business_date", F.coalesce("business_date", F.lit("1900-01-01").cast("date")))
    strategy = w.table("seed_line_strategy").select(F.col("inventory_id").alias("s_item"), F.col("line_type").alias("s_type"), F.col("sales_account_id").alias("s_account"),
                                                    F.col("line_business_unit_strategy").alias("strategy"))
    l = lookups.wildcard_lookup(l, strategy, {"s_item": "inventory_id"}, {"s_type": "line_type", "s_account": "sales_account_id"}, ["strategy"])
    material = F.col("line_amount") != 0
    l = l.withColumn("strategy", F.when(~material, "ignore_zero_value_line").otherwise(F.coalesce("strategy", F.lit("source_subaccount"))))
    l = resolve.resolve_by_window(l, windows(w), ["tenant_id"], "segment_2", "business_date", "valid_from", "valid_to", "unit_segment",
                                  ["business_unit_id", "business_unit_name"])
    return l.select("*", readable_key("tenant_id", "order_id").alias("order_key"), material.alias("is_material"),
                    (F.col("strategy") == "allocate_to_material_goods_bu").alias("is_ancillary"))


@model("sales_order_header_unit")
def order_header_unit(w: Warehouse) -> DataFrame:
    """Unit of each order: unanimous over its material lines, else NULL with a representative.

    An order without material lines takes the tenant's default of its day, if there is one.
    """
    l = w.model("sales_order_lines_with_unit")
    h = resolve.header_value(l, "order_key", "business_unit_id", "line_amount", "line_rank", F.col("is_material"), F.col("is_ancillary"))
    heads = l.groupBy("order_key", "tenant_id").agg(F.min("business_date").alias("business_date")).withColumn("_seg", F.lit(None).cast("string"))
    default = resolve.resolve_by_window(heads, windows(w), ["tenant_id"], "_seg", "business_date", "valid_from", "valid_to", "unit_segment",
                                        ["business_unit_id"]).select("order_key", F.col("business_unit_id").alias("_default"))
    none, known = F.col("material_lines") == 0, F.col("_default").isNotNull()
    return h.join(default, "order_key", "left").withColumns({
        "agreed_value": F.when(none, F.col("_default")).otherwise(F.col("agreed_value")),
        "representative": F.when(none, F.col("_default")).otherwise(F.col("representative")),
        "selection_method": F.when(none & known, "tenant_default_match").when(none, "no_match").otherwise(F.col("selection_method")),
    }).drop("_default")


@model("fact_sales_order_business_unit")
def order_by_unit(w: Warehouse) -> DataFrame:
    """Order x unit measures of mixed orders."""
    l = w.model("sales_order_lines_with_unit")
    per = l.groupBy("tenant_id", "order_id", "order_key", "business_unit_id", "business_unit_name").agg(
        F.count(F.lit(1)).alias("line_count"), F.count_if("is_material").alias("material_line_count"), F.count_if(~F.col("is_material")).alias("zero_value_line_count"),
        F.count_if("is_ancillary").alias("ancillary_line_count"), F.count_if((F.col("strategy") == "source_subaccount") & F.col("is_material")).alias("core_material_line_count"),
        F.sum("line_amount").cast("double").alias("line_amount"))
    head = w.model("sales_order_header_unit").select("order_key", F.col("value_count").alias("effective_line_business_unit_count"),
                                                     F.col("selection_method").alias("header_business_unit_selection_method"))
    return per.join(head, "order_key", "left")


@model("sales_order_sales_person")
def order_sales_person(w: Warehouse) -> DataFrame:
    """Sales person of an order by amount: material lines first, else all lines."""
    l = w.model("sales_order_lines_with_unit").filter(F.col("sales_person_id").isNotNull())
    roll = l.groupBy("tenant_id", "order_id", "sales_person_id", "is_material").agg(
        F.sum("line_amount").alias("a"), F.count(F.lit(1)).alias("n"), F.min("line_rank").alias("f"))
    return latest_by(roll, ["tenant_id", "order_id"], [F.desc("is_material"), F.desc("a"), F.desc("n"), F.asc("f"), F.asc("sales_person_id")]).select(
        "tenant_id", "order_id", "sales_person_id", F.col("is_material").alias("from_material_lines"))


# -------------------------------------------------------------------------------- access
@model("RLS_sales_person")
def access_bridge(w: Warehouse) -> DataFrame:
    """Who may see which sales person: manual rows before the directory's active addresses."""
    manual = w.table("seed_rls_sales_person").filter("user_principal_name IS NOT NULL AND tenant_id IS NOT NULL AND sales_person_id IS NOT NULL").select(
        F.lower(F.trim("user_principal_name")).alias("user_principal_name"), "tenant_id", "sales_person_id",
        F.coalesce("access_scope", F.lit("sales_person")).alias("access_scope"), F.coalesce("is_active", F.lit(True)).alias("is_active"),
        F.lit("manual_seed").alias("mapping_source"), F.lit(1).alias("_pr"))
    people = w.table("dim_sales_person")
    auto = people.filter(text.blank_to_null("email").isNotNull() & F.col("is_active").eqNullSafe(True)).select(
        F.lower(F.trim("email")).alias("user_principal_name"), "tenant_id", "sales_person_id", F.lit("sales_person").alias("access_scope"),
        F.lit(True).alias("is_active"), F.lit("sales_person_directory_email").alias("mapping_source"), F.lit(2).alias("_pr"))
    key = ["user_principal_name", "tenant_id", "sales_person_id"]
    m = latest_by(manual.unionByName(auto), key, [F.asc("_pr")]).drop("_pr")
    names = people.select("tenant_id", "sales_person_id", "sales_person_name", F.col("is_active").alias("_person_active"))
    co = w.model("dim_company").select("tenant_id", "company_key", "entity_code", "entity_name")
    return m.join(names, ["tenant_id", "sales_person_id"], "left").join(co, "tenant_id", "left").select(
        surrogate_key(*key).alias("rls_sales_person_key"), *key, "company_key", "entity_code", "entity_name", "sales_person_name", "access_scope", "is_active",
        F.coalesce("_person_active", F.lit(False)).alias("has_active_sales_person_match"), "mapping_source")


# ----------------------------------------------------------------------------- inventory
# Movement type, bronze table and its line array (spelled as in the source).
MOVEMENTS = [
    ("ADJUSTMENT", "inventory_adjustments", "adjusmentLines"), ("ISSUE", "inventory_issues", "issueLines"),
    ("RECEIPT", "inventory_receipts", "receiptLines"), ("TRANSFER", "inventory_transfers", "transferLines"),
]
LINE_NUMBER_PATHS = ["$.lineNumber", "$.lineNbr", "$.sortOrder"]
UNIT_PATHS = ["$.uoM", "$.uom", "$.unitOfMeasure"]


def embedded(field: str, part: str) -> Column:
    """Part of an object on a line: nested, as a dotted key, or inside JSON text."""
    return F.coalesce(jsonx.json_scalar("l", f"$.{field}.{part}"), jsonx.json_scalar("l", f"$['{field}.{part}']"),
                      jsonx.json_scalar(jsonx.double_encoded("l", f"$.{field}"), f"$.{part}"))


def movement_lines(w: Warehouse, kind: str, table: str, array: str) -> DataFrame:
    """Lines of one kind of inventory document in the common shape."""
    h = live(w.table(table)).withColumn("l", F.explode(jsonx.json_array(jsonx.parsed(array), "$")))
    transfer = kind == "TRANSFER"
    none = F.lit(None).cast("string")
    number = lambda p: jsonx.json_number("l", p, "decimal(18,4)")
    item = F.coalesce(embedded("inventoryItem", "number"), jsonx.json_scalar("l", "$.inventoryId")) if transfer else F.coalesce(
        embedded("inventory", "id"), jsonx.json_scalar("l", "$.inventoryId"))
    cost = [F.lit(None).cast("decimal(18,4)")] * 2 if transfer else [number("$.unitCost"), number("$.amount")]
    return h.select(
        F.col("tenantId").alias("tenant_id"), F.lit(kind).alias("movement_type"), F.col("referenceNumber").alias("reference_number"),
        dates.any_date("date").alias("movement_date"), jsonx.first_scalar("l", *LINE_NUMBER_PATHS).alias("line_number"), item.alias("inventory_id"),
        embedded("inventoryItem" if transfer else "inventory", "description").alias("inventory_description"),
        (jsonx.json_scalar(jsonx.parsed("warehouse"), "$.id") if transfer else embedded("warehouse", "id")).alias("warehouse_id"),
        (jsonx.json_scalar(jsonx.parsed("toWarehouse"), "$.id") if transfer else none).alias("destination_warehouse_id"),
        embedded("location", "id").alias("location_id"), embedded("location", "name").alias("location_name"),
        (embedded("toLocation", "id") if transfer else none).alias("to_location_id"), (embedded("toLocation", "name") if transfer else none).alias("to_location_name"),
        jsonx.json_scalar("l", "$.description").alias("line_description"), jsonx.first_scalar("l", *UNIT_PATHS).alias("unit_of_measure"),
        jsonx.json_scalar("l", "$.lotSerialNumber").alias("lot_serial_number"), number("$.quantity").alias("quantity"),
        cost[0].alias("unit_cost"), cost[1].alias("amount"), (jsonx.json_text("l", "$.allocations") if transfer else none).alias("allocations_raw"),
        (F.size(jsonx.json_array("l", "$.allocations")) if transfer else F.lit(None)).cast("bigint").alias("allocation_count"),
        (embedded("reasonCode", "id") if transfer else none).alias("reason_code_id"))


@model("fact_inventory_movement_line")
def movements(w: Warehouse) -> DataFrame:
    """Adjustments, issues, receipts and transfers as one fact, with the tenant's unit."""
    rows = quality.union_all([movement_lines(w, *m) for m in MOVEMENTS])
    key = ["tenant_id", "movement_type", "reference_number", "line_number", "inventory_id"]
    rows = latest_by(rows, key, [F.desc_nulls_last("amount"), F.desc_nulls_last("quantity")]).withColumn("_seg", F.lit("0"))
    out = resolve.resolve_by_window(rows, windows(w), ["tenant_id"], "_seg", "movement_date", "valid_from", "valid_to", "unit_segment",
                                    ["business_unit_id", "business_unit_name", "unit_segment"])
    method = F.when(F.col("business_unit_id").isNull(), "unresolved").when(F.col("unit_segment") == "0", "segment_zero_match").otherwise("tenant_default_match")
    return out.select(*[c for c in out.columns if c not in ("_seg", "unit_segment")], method.alias("business_unit_resolution_method"))


for _kind, _, _ in MOVEMENTS:
    MODELS[f"fact_inventory_{_kind.lower()}_line"] = lambda w, k=_kind: w.model("fact_inventory_movement_line").filter(F.col("movement_type") == k)


# ------------------------------------------------------------------ facts at market rates
def at_market_rate(w: Warehouse, facts: DataFrame, currency: str, day: str, amounts: list[str]) -> DataFrame:
    """Amounts of a document fact in group currency at the rate of its day; NULL without a rate."""
    d = w.model("dim_currency_market_rate_daily")
    info = d.select(F.col("currency").alias(currency), F.col("calendar_date").alias(day), F.col("exchange_rate").cast("double").alias("market_exchange_rate"),
                    F.col("rate_date").alias("market_rate_date"), "rate_source", "has_market_rate", "is_rate_filled_forward")
    j = facts.join(info, [currency, day], "left")
    return j.select(
        "*", *[F.try_multiply(F.col(a), F.col("market_exchange_rate")).alias(f"{a}_market") for a in amounts],
        F.coalesce("has_market_rate", F.lit(False)).alias("has_market_rate_to_group"),
        F.coalesce("is_rate_filled_forward", F.lit(False)).alias("is_market_rate_filled_forward")).drop("has_market_rate", "is_rate_filled_forward")


# Document facts and their amounts in document currency.
MARKET_FACTS = {
    "fact_customer_invoice": ("document_date", ["amount_in_currency", "balance_in_currency"]),
    "fact_customer_credit_note": ("document_date", ["amount_in_currency", "balance_in_currency"]),
    "fact_customer_payment": ("application_date", ["amount_in_currency"]),
    "fact_supplier_invoice": ("document_date", ["amount_in_currency", "balance_in_currency"]),
    "fact_supplier_payment": ("application_date", ["amount_in_currency"]),
    "fact_sales_order_line": ("order_date", ["line_amount"]),
    "fact_purchase_order_line": ("order_date", ["ext_cost"]),
}


RATED_DOCUMENTS = ["fact_customer_invoice", "fact_supplier_invoice", "fact_customer_payment", "fact_customer_credit_note", "fact_supplier_payment"]


def market_fact(name: str, day: str, amounts: list[str]):
    def build(w: Warehouse) -> DataFrame:
        facts = w.table(f"silver.{name}")
        return at_market_rate(w, facts, "currency_id", day, [a for a in amounts if a in facts.columns]).select(
            surrogate_key("tenant_id").alias("company_key"), dates.date_key(day).alias("date_key"), "*")
    return build


for _name, (_day, _amounts) in MARKET_FACTS.items():
    MODELS[_name] = market_fact(_name, _day, _amounts)


@model("fact_shipment_detail_line")
def shipment_lines(w: Warehouse) -> DataFrame:
    """Shipment lines with the location of the unit, else of the tenant."""
    loc = w.table("dim_location")
    strict = loc.groupBy("tenant_id", "business_unit_id", "location_id").agg(F.min("location_key").alias("_strict"))
    loose = loc.groupBy("tenant_id", "location_id").agg(F.min("location_tenant_key").alias("_loose"))
    f = w.table("silver.fact_shipment_line")
    j = f.join(strict, ["tenant_id", "business_unit_id", "location_id"], "left").join(loose, ["tenant_id", "location_id"], "left")
    return j.withColumn("location_key", F.coalesce("_strict", "_loose")).drop("_strict", "_loose")
