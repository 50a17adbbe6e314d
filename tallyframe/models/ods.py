"""Operational store: native relations (level 0) and the group vocabulary (level 1).

Names carry the level: ``native.fact_invoice_line`` is level 0, ``fact_invoice_line``
level 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.functions import dates
from tallyframe.functions.keys import readable_key
from tallyframe.models.base import Warehouse
from tallyframe.operators import aggregates as agg, quality, sets
from tallyframe.operators.documents import report_number
from tallyframe.operators.latest import latest_by

SOURCE_SYSTEM = "accounting_api"
MODELS = {}


def model(name: str):
    def wrap(fn):
        MODELS[name] = fn
        return fn
    return wrap


def newest(w: Warehouse, table: str, key: str) -> DataFrame:
    """Latest row per tenant and natural key."""
    return latest_by(w.table(table), ["tenant_id", key], [F.desc("synced_at")])


# ------------------------------------------------------------------- level 0 dimensions
# Dimension, staging table and natural key.
NATIVE_DIMENSIONS = [
    ("account", "accounts", "account_id"), ("branding_theme", "branding_themes", "branding_theme_id"),
    ("currency", "currencies", "currency_code"), ("item", "items", "item_id"), ("organisation", "organisations", "organisation_id"),
    ("tax_rate", "tax_rates", "tax_type"), ("tracking_category", "tracking_categories", "tracking_category_id"),
    ("tracking_option", "tracking_options", "tracking_option_id"), ("user", "users", "user_id"),
]


def native_dimension(name: str, table: str, key: str):
    def build(w: Warehouse) -> DataFrame:
        d = newest(w, table, key)
        return d.select(readable_key("tenant_id", key).alias(f"{name}_key"), "tenant_id",
                        F.col("record_id").alias(f"{name}_internal_id"),
                        *[c for c in d.columns if c not in ("tenant_id", "record_id")])
    return build


for _name, _table, _key in NATIVE_DIMENSIONS:
    MODELS[f"native.dim_{_name}"] = native_dimension(_name, _table, _key)

# Address and phone types spread to columns of a contact.
ADDRESS_COLUMNS = {
    "STREET": ["address_line_1", "address_line_2", "address_line_3", "address_line_4", "city", "region", "postal_code", "country", "attention_to"],
    "POBOX": ["address_line_1", "city", "postal_code", "country"],
}


def widen(df: DataFrame, type_column: str, wanted: list[tuple[str, str, str]]) -> DataFrame:
    """One row per contact with (type, source column) pairs as columns."""
    return df.groupBy("tenant_id", "contact_id").agg(*[
        F.max(F.when(F.col(type_column) == kind, F.col(c))).alias(out) for kind, c, out in wanted])


@model("native.dim_contact")
def native_contact(w: Warehouse) -> DataFrame:
    c = newest(w, "contacts", "contact_id")
    addresses = widen(w.table("contact_addresses"), "address_type", [
        (kind, col, f"{kind.lower()}_{col}") for kind, cols in ADDRESS_COLUMNS.items() for col in cols])
    phones = widen(w.table("contact_phones"), "phone_type", [
        ("DEFAULT", "phone_number", "phone_number"), ("DEFAULT", "area_code", "phone_area_code"),
        ("DEFAULT", "country_code", "phone_country_code"), ("MOBILE", "phone_number", "mobile_number")])
    key = ["tenant_id", "contact_id"]
    wide = c.join(addresses, key, "left").join(phones, key, "left")
    return wide.withColumnRenamed("record_id", "contact_internal_id").withColumn("contact_key", readable_key(*key))


# ------------------------------------------------------------------------ level 0 facts
@dataclass(frozen=True)
class LineFact:
    """How lines and headers of a document kind become a line fact."""

    lines: str
    header: str
    owner: str  # document id
    line: str  # line id within the document
    date: str
    number: str
    kind: str | None  # column holding the document type
    fixed_kind: str | None = None
    extra: dict[str, str] = field(default_factory=dict)  # further level 1 columns: name -> native column


LINE_FACTS = {
    "invoice_line": LineFact("invoice_lines", "invoices", "invoice_id", "line_item_id", "invoice_date", "invoice_number", "invoice_type",
                             extra={"due_date": "due_date_local"}),
    "credit_note_line": LineFact("credit_note_lines", "credit_notes", "credit_note_id", "line_item_id", "credit_note_date",
                                 "credit_note_number", "credit_note_type"),
    "bank_transaction_line": LineFact("bank_transaction_lines", "bank_transactions", "bank_transaction_id", "line_item_id",
                                      "transaction_date", "reference", "transaction_type",
                                      extra={"bank_account_id": "bank_account_id", "is_reconciled": "is_reconciled"}),
    "overpayment_line": LineFact("overpayment_lines", "overpayments", "overpayment_id", "line_item_id", "overpayment_date", "reference",
                                 "overpayment_type"),
    "purchase_order_line": LineFact("purchase_order_lines", "purchase_orders", "purchase_order_id", "line_item_id", "order_date",
                                    "purchase_order_number", "purchase_order_type"),
    "quote_line": LineFact("quote_lines", "quotes", "quote_id", "line_item_id", "quote_date", "quote_number", None, "QUOTE",
                           extra={"expiry_date": "expiry_date_local"}),
}


def native_lines(w: Warehouse, f: LineFact) -> DataFrame:
    """Lines with the context of their newest header; only line measures are additive."""
    lines = w.table(f.lines)
    header = newest(w, f.header, f.owner)
    context = [c for c in header.columns if c in ("tenant_id", f.owner) or (c not in lines.columns and c != "record_id")]
    synced = [F.col("synced_at").alias("_header_synced")] if "synced_at" in lines.columns else []
    joined = lines.drop("record_id").join(header.select(*context, *synced), ["tenant_id", f.owner], "left")
    if synced:
        joined = joined.withColumn("synced_at", F.col("_header_synced")).drop("_header_synced")
    # a document arrives as one JSON text, which bounds its lines
    order = Window.partitionBy("tenant_id", f.owner).orderBy(f.line)
    return joined.withColumn("line_number", F.row_number().over(order))


def native_line_model(name: str, f: LineFact):
    def build(w: Warehouse) -> DataFrame:
        return native_lines(w, f).withColumn(f"{name}_key", readable_key("tenant_id", f.line))
    return build


for _name, _fact in LINE_FACTS.items():
    MODELS[f"native.fact_{_name}"] = native_line_model(_name, _fact)


@model("native.fact_manual_journal_line")
def native_manual_journal(w: Warehouse) -> DataFrame:
    f = LineFact("manual_journal_lines", "manual_journals", "manual_journal_id", "line_position", "journal_date", "manual_journal_id", None)
    rows = native_lines(w, f).withColumn("line_number", F.col("line_position"))
    return rows.withColumn("manual_journal_line_key", readable_key("tenant_id", "manual_journal_id", "line_position"))


@model("native.fact_payment")
def native_payment(w: Warehouse) -> DataFrame:
    return newest(w, "payments", "payment_id").drop("record_id").withColumn("payment_key", readable_key("tenant_id", "payment_id"))


@model("native.fact_bank_transfer")
def native_transfer(w: Warehouse) -> DataFrame:
    return newest(w, "bank_transfers", "bank_transfer_id").drop("record_id").withColumn(
        "bank_transfer_key", readable_key("tenant_id", "bank_transfer_id"))


def with_tracking_keys(w: Warehouse, lines: DataFrame) -> DataFrame:
    """Resolve both tracking slots by category and option name; names repeat, so the lookup is folded first."""
    slot_key = ["tenant_id", "tracking_category_id", "option_name"]
    options = latest_by(w.model("native.dim_tracking_option"), slot_key, [F.asc("tracking_option_id")]).select(*slot_key, "tracking_option_key")
    for n in (1, 2):
        side = options.select(F.col("tenant_id"), F.col("tracking_category_id").alias(f"tracking_category_{n}_id"),
                              F.col("option_name").alias(f"tracking_option_{n}_name"), F.col("tracking_option_key").alias(f"tracking_option_key_{n}"))
        lines = lines.join(side, ["tenant_id", f"tracking_category_{n}_id", f"tracking_option_{n}_name"], "left")
    return lines


@model("native.fact_general_ledger")
def native_ledger(w: Warehouse) -> DataFrame:
    f = LineFact("journal_lines", "journals", "journal_id", "journal_line_id", "journal_date", "journal_number", "source_type")
    rows = with_tracking_keys(w, native_lines(w, f).drop("line_number"))
    return rows.select(
        readable_key("tenant_id", "journal_id", "journal_line_id").alias("general_ledger_line_key"),
        *[c for c in rows.columns if c != "journal_date"], F.to_date("journal_date").alias("journal_date"),
        dates.date_key(F.to_date("journal_date")).alias("date_key"))


@model("native.fact_report_row")
def native_report_row(w: Warehouse) -> DataFrame:
    key = ["tenant_id", "record_id"]
    snap = latest_by(w.table("report_snapshots"), key, [F.desc("synced_at")]).drop("report")
    rows = w.table("report_rows").drop("synced_at").join(snap, key, "left")
    place = ["report_index", "section_index", "row_index", "cell_index"]
    return rows.withColumn("cell_value_numeric", F.col("cell_value").try_cast("double")).withColumn(
        "report_row_key", readable_key(*key, *place))


# -------------------------------------------------------------------- level 1 dimensions
# Group vocabulary of native names.
RENAMES = {
    "contact": {"contact_id": "source_contact_id", "contact_name": "party_name", "tax_number": "corporate_id", "default_currency": "currency_id",
                "updated_at": "last_modified_at"},
    "item": {"item_id": "source_item_id", "item_code": "inventory_number", "description": "item_description", "is_tracked_as_inventory": "is_stock_item",
             "sales_unit_price": "default_price", "sales_tax_type": "vat_code", "updated_at": "last_modified_at"},
    "organisation": {"organisation_id": "source_organisation_id", "tax_number": "corporate_id", "base_currency": "currency_id"},
    "currency": {"currency_code": "currency_id", "currency_description": "description"},
    "branding_theme": {}, "tax_rate": {}, "tracking_category": {}, "tracking_option": {}, "user": {},
}


def harmonized_dimension(name: str, renames: dict[str, str]):
    def build(w: Warehouse) -> DataFrame:
        return w.model(f"native.dim_{name}").withColumnsRenamed(renames).withColumn("source_system", F.lit(SOURCE_SYSTEM))
    return build


for _name, _map in RENAMES.items():
    MODELS[f"dim_{_name}"] = harmonized_dimension(_name, _map)

# Statement side and first reporting line per native account class, and
# the group columns that await a curated mapping.
ACCOUNT_CLASSES = {
    "ASSET": ("BS", "Assets"), "LIABILITY": ("BS", "Equity and liabilities"), "EQUITY": ("BS", "Equity and liabilities"),
    "REVENUE": ("P&L", "Revenue"), "EXPENSE": ("P&L", "Operating expenses"),
}
PENDING_COLUMNS = {
    "fsli_2": "string", "fsli_3": "string", "account_code_1": "bigint", "account_code_2": "bigint", "account_code_3": "bigint",
    "is_ebitda": "boolean", "is_net_income": "boolean", "cf_1": "string", "cf_2": "string", "cf_3": "string", "is_nwc": "boolean",
    "is_capex": "boolean", "intercompany_flag": "string", "chart_of_accounts_source": "string",
}


def by_class(position: int) -> Column:
    pairs = [F.lit(x) for k, v in ACCOUNT_CLASSES.items() for x in (k, v[position])]
    return F.create_map(*pairs)[F.col("account_class")]


@model("dim_account")
def account(w: Warehouse) -> DataFrame:
    a = w.model("native.dim_account").withColumnsRenamed({"account_id": "source_account_id", "account_code": "account_cd"})
    known = F.col("account_class").isin(list(ACCOUNT_CLASSES))
    return a.select(
        "*", F.col("account_cd").try_cast("bigint").alias("account_cd_numeric"), by_class(0).alias("bs_pl"), by_class(1).alias("fsli_1"),
        *[F.lit(None).cast(t).alias(c) for c, t in PENDING_COLUMNS.items()], F.lit(False).alias("has_hierarchy"),
        F.when(known, "native_account_class").otherwise("unmapped").alias("account_mapping_method"),
        F.lit(SOURCE_SYSTEM).alias("source_system"))


# ------------------------------------------------------------------------- level 1 facts
def net_of_tax(amount: Column, tax: Column, basis: Column) -> Column:
    """Tax-exclusive amount whatever the basis of the source."""
    return F.when(basis == "Inclusive", amount - F.coalesce(tax, F.lit(0))).otherwise(amount)


def unique_lookup(df: DataFrame, key: str, order: str, take: str) -> DataFrame:
    """One row per tenant and key of a dimension whose key is not guaranteed unique."""
    return latest_by(df.filter(F.col(key).isNotNull()), ["tenant_id", key], [F.asc(order)]).select("tenant_id", key, take)


def harmonized_lines(name: str, f: LineFact):
    def build(w: Warehouse) -> DataFrame:
        n = with_tracking_keys(w, w.model(f"native.fact_{name}"))
        have = set(n.columns)
        if "item_code" in have:
            n = n.join(unique_lookup(w.model("native.dim_item"), "item_code", "item_id", "item_key"), ["tenant_id", "item_code"], "left")
        if "account_id" not in have and "account_code" in have:
            n = n.join(unique_lookup(w.model("native.dim_account"), "account_code", "account_id", "account_id"), ["tenant_id", "account_code"], "left")
        have = set(n.columns)
        day = F.to_date(f.date)
        rate = F.coalesce("currency_rate", F.lit(1.0))
        net = net_of_tax(F.col("line_amount"), F.col("tax_amount"), F.col("line_amount_types"))
        cols = [
            f"{name}_key", "tenant_id", "line_item_id", f.owner, "line_number", F.col(f.number).alias("reference_number"),
            (F.col(f.kind) if f.kind else F.lit(f.fixed_kind)).alias("document_type"), "status", day.alias("document_date"),
            dates.date_key(day).alias("date_key"), *[F.col(c).alias(a) for a, c in f.extra.items()],
            readable_key("tenant_id", "contact_id").alias("contact_key"), readable_key("tenant_id", "currency_code").alias("currency_key"),
            "tracking_option_key_1", "tracking_option_key_2", F.col("currency_code").alias("currency_id"), "currency_rate",
            F.col("description").alias("line_description"), "quantity", F.col("unit_amount").alias("unit_price"),
            net.alias("amount_in_currency"), F.col("tax_amount").alias("tax_amount_in_currency"), (net * rate).alias("amount"),
            (F.col("tax_amount") * rate).alias("tax_amount"), "line_amount_types",
        ]
        if "account_id" in have:
            cols += [readable_key("tenant_id", "account_id").alias("account_key"), "account_id"]
        if "discount_rate" in have:
            cols.append(F.col("discount_rate").alias("discount"))
        if "discount_amount" in have:
            cols += [F.col("discount_amount").alias("discount_amount_in_currency"), (F.col("discount_amount") * rate).alias("discount_amount")]
        carried = ["account_code", "item_code", "item_key", "tax_type", "contact_id", "contact_name", "synced_at"]
        cols += [c for c in carried if c in have]
        cols += [f"tracking_{w_}_{s}_name" for s in (1, 2) for w_ in ("category", "option")]
        return n.select(*cols, F.lit(SOURCE_SYSTEM).alias("source_system"))
    return build


for _name, _fact in LINE_FACTS.items():
    MODELS[f"fact_{_name}"] = harmonized_lines(_name, _fact)


@model("fact_manual_journal_line")
def manual_journal(w: Warehouse) -> DataFrame:
    n = with_tracking_keys(w, w.model("native.fact_manual_journal_line"))
    day = F.to_date("journal_date")
    gross = F.col("line_amount") + F.when(F.col("line_amount_types") == "Exclusive", F.coalesce("tax_amount", F.lit(0.0))).otherwise(F.lit(0.0))
    return n.select(
        "manual_journal_line_key", "tenant_id", "manual_journal_id", "line_number", F.col("manual_journal_id").alias("reference_number"),
        F.lit("MANUALJOURNAL").alias("document_type"), "status", "narration", day.alias("document_date"), dates.date_key(day).alias("date_key"),
        readable_key("tenant_id", "account_id").alias("account_key"), "tracking_option_key_1", "tracking_option_key_2",
        F.col("description").alias("line_description"), gross.alias("amount"), "line_amount", "tax_amount", "line_amount_types", "is_blank",
        "account_id", "account_code", "tax_type", "synced_at", F.lit(SOURCE_SYSTEM).alias("source_system"))


@model("fact_payment")
def payment(w: Warehouse) -> DataFrame:
    n = w.model("native.fact_payment")
    day = F.to_date("payment_date")
    return n.select(
        "payment_key", "tenant_id", "payment_id", F.col("payment_type").alias("document_type"), "status", F.col("reference").alias("reference_number"),
        day.alias("document_date"), dates.date_key(day).alias("date_key"), "is_reconciled", readable_key("tenant_id", "account_id").alias("account_key"),
        readable_key("tenant_id", "contact_id").alias("contact_key"), "invoice_id", "invoice_number", F.col("invoice_type").alias("applied_document_type"),
        "batch_payment_id", F.col("amount").alias("amount_in_currency"), (F.col("amount") * F.coalesce("currency_rate", F.lit(1.0))).alias("amount"),
        "bank_amount", "currency_rate", "account_id", "account_code", "contact_id", "contact_name", "synced_at", F.lit(SOURCE_SYSTEM).alias("source_system"))


@model("fact_bank_transfer")
def transfer(w: Warehouse) -> DataFrame:
    n = w.model("native.fact_bank_transfer")
    day = F.to_date("transfer_date")
    sides = [f"{side}_bank_account_{part}" for side in ("from", "to") for part in ("id", "code", "name")]
    return n.select(
        "bank_transfer_key", "tenant_id", "bank_transfer_id", F.col("reference").alias("reference_number"), "status", day.alias("document_date"),
        dates.date_key(day).alias("date_key"), *[readable_key("tenant_id", f"{s}_bank_account_id").alias(f"{s}_account_key") for s in ("from", "to")],
        "from_bank_transaction_id", "to_bank_transaction_id", "from_is_reconciled", "to_is_reconciled", F.col("amount").alias("amount_in_currency"),
        (F.col("amount") * F.coalesce("currency_rate", F.lit(1.0))).alias("amount"), "currency_rate", *sides, "has_attachments", "synced_at",
        F.lit(SOURCE_SYSTEM).alias("source_system"))


@model("fact_general_ledger")
def ledger(w: Warehouse) -> DataFrame:
    n = w.model("native.fact_general_ledger").withColumnsRenamed({
        "journal_number": "reference_number", "source_type": "document_type", "source_id": "document_id", "journal_date": "document_date",
        "description": "line_description", "net_amount": "amount"})
    return n.withColumn("account_key", readable_key("tenant_id", "account_id")).withColumn("source_system", F.lit(SOURCE_SYSTEM))


@model("fact_report_row")
def report_row(w: Warehouse) -> DataFrame:
    return w.model("native.fact_report_row").withColumn("source_system", F.lit(SOURCE_SYSTEM))


# ------------------------------------------------------------- reconciliations, assertions
# Ids that name a real account in a report cell.
ACCOUNT_ID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-"


def exact(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("decimal(20,4)")


def ledger_days(w: Warehouse) -> DataFrame:
    """The ledger folded to account and day, before it meets the few rows of a tenant."""
    return w.model("fact_general_ledger").groupBy("tenant_id", "account_id", "document_date").agg(F.sum(exact("amount")).alias("a"))


def latest_report(w: Warehouse, report: str, by: str, take: list[str]) -> DataFrame:
    """Newest snapshot of a report per tenant, from the small snapshot table."""
    snaps = w.table("report_snapshots").filter(F.col("report") == report)
    return latest_by(snaps, ["tenant_id"], [F.desc(by), F.desc("synced_at"), F.desc("record_id")]).select("tenant_id", "record_id", *take)


def report_accounts(w: Warehouse, snapshot: DataFrame) -> DataFrame:
    """Cells of the snapshots that belong to an account."""
    rows = w.model("fact_report_row").join(snapshot.select("tenant_id", "record_id"), ["tenant_id", "record_id"], "left_semi")
    return rows.filter((F.col("attribute_id") == "account") & F.col("attribute_value").rlike(ACCOUNT_ID_PATTERN)).withColumn(
        "account_id", F.col("attribute_value")).withColumn("number", report_number("cell_value"))


@model("recon_trial_balance")
def trial_balance(w: Warehouse) -> DataFrame:
    snap = latest_report(w, "report_trial_balance", "report_date", ["report_date"])
    org = w.model("dim_organisation").select("tenant_id", "financial_year_end_month", "financial_year_end_day")
    fy = snap.join(org, "tenant_id", "left").withColumn("fiscal_year_start", dates.fiscal_year_start(
        "report_date", F.col("financial_year_end_month").cast("int"), F.col("financial_year_end_day").cast("int")))
    zero = F.lit(0).cast("decimal(18,2)")
    def column_sum(header):
        return F.sum(F.when(F.col("column_header") == header, F.coalesce("number", zero)).otherwise(zero))
    theirs = report_accounts(w, snap).groupBy("tenant_id", "account_id").agg(
        F.min("row_label").alias("account_label"), (column_sum("YTD Debit") - column_sum("YTD Credit")).alias("reported_net"))
    window = fy.select("tenant_id", "fiscal_year_start", "report_date")
    ours = ledger_days(w).join(
        window, "tenant_id").filter(F.col("document_date").between(F.col("fiscal_year_start"), F.col("report_date"))).groupBy(
        "tenant_id", "account_id").agg(F.sum("a").alias("our_net"))
    rec = quality.reconcile(theirs, ours, ["tenant_id", "account_id"], "reported_net", "our_net")
    return rec.join(window, "tenant_id", "left").select(
        "tenant_id", "account_id", "account_label", "report_date", "fiscal_year_start", F.coalesce("reported_net", zero).cast("double").alias("reported_net"),
        F.coalesce("our_net", zero).cast("double").alias("our_net"), F.col("diff").cast("double").alias("diff"))


@model("recon_profit_and_loss")
def profit_and_loss(w: Warehouse) -> DataFrame:
    snap = latest_report(w, "report_profit_and_loss", "report_to", ["report_from", "report_to"])
    theirs = report_accounts(w, snap).filter("column_header <> ''").groupBy("tenant_id", "account_id").agg(
        F.min("row_label").alias("account_label"), F.sum(F.coalesce("number", F.lit(0).cast("decimal(18,2)"))).alias("reported"))
    acct = w.model("dim_account").filter("bs_pl = 'P&L'").select("tenant_id", F.col("source_account_id").alias("account_id"), "account_class")
    period = snap.select("tenant_id", "report_from", "report_to")
    ours = ledger_days(w).join(period, "tenant_id").filter(
        F.col("document_date").between(F.col("report_from"), F.col("report_to"))).groupBy("tenant_id", "account_id").agg(F.sum("a").alias("ours"))
    ours = ours.join(acct.select("tenant_id", "account_id"), ["tenant_id", "account_id"], "left_semi")
    j = theirs.join(ours, ["tenant_id", "account_id"], "full_outer").join(acct, ["tenant_id", "account_id"], "left").join(period, "tenant_id", "left")
    signed = F.when(F.col("account_class") == "REVENUE", -F.col("reported")).otherwise(F.col("reported"))
    zero = F.lit(0).cast("decimal(18,2)")
    return j.select(
        "tenant_id", "account_id", "account_label", "account_class", "report_from", "report_to", F.col("reported").cast("double").alias("reported"),
        F.col("ours").cast("double").alias("ours"), signed.cast("double").alias("reported_signed"),
        F.round(F.coalesce("ours", zero) - F.coalesce(signed, zero), 2).cast("double").alias("diff"))


# Per fact the statuses left out, the types whose sign turns, the types
# compared and their ledger names.
@dataclass(frozen=True)
class DocumentSide:
    fact: str
    excluded: tuple[str, ...]
    flipped: tuple[str, ...]
    types: dict[str, str] | None = None
    fixed_type: str | None = None


DOCUMENT_SIDES = [
    DocumentSide("fact_invoice_line", ("DELETED", "VOIDED"), ("ACCREC",)),
    DocumentSide("fact_credit_note_line", ("DELETED", "VOIDED"), ("ACCPAYCREDIT",)),
    DocumentSide("fact_bank_transaction_line", ("DELETED",), ("RECEIVE",), {"SPEND": "CASHPAID", "RECEIVE": "CASHREC"}),
    DocumentSide("fact_manual_journal_line", ("DELETED", "VOIDED"), (), fixed_type="MANJOURNAL"),
    DocumentSide("fact_payment", ("DELETED",), ("ACCPAYPAYMENT", "ARCREDITPAYMENT"),
                 {t: t for t in ("ACCPAYPAYMENT", "ACCRECPAYMENT", "APCREDITPAYMENT", "ARCREDITPAYMENT")}),
    DocumentSide("fact_overpayment_line", ("VOIDED",), ("RECEIVE-OVERPAYMENT",),
                 {"SPEND-OVERPAYMENT": "APOVERPAYMENT", "RECEIVE-OVERPAYMENT": "AROVERPAYMENT"}),
]
LEDGER_DOCUMENT_TYPES = [
    "ACCPAY", "ACCREC", "ACCPAYCREDIT", "ACCRECCREDIT", "CASHPAID", "CASHREC", "MANJOURNAL", "ACCPAYPAYMENT", "ACCRECPAYMENT",
    "APCREDITPAYMENT", "ARCREDITPAYMENT", "APOVERPAYMENT", "AROVERPAYMENT", "TRANSFER",
]


def document_side(w: Warehouse, s: DocumentSide) -> DataFrame:
    d = w.model(s.fact).filter(~F.col("status").isin(list(s.excluded)))
    kind = F.col("document_type")
    if s.types:
        d = d.filter(kind.isin(list(s.types)))
    named = F.lit(s.fixed_type) if s.fixed_type else (
        F.create_map(*[F.lit(x) for kv in s.types.items() for x in kv])[kind] if s.types else kind)
    flip = kind.isin(list(s.flipped)) if s.flipped else F.lit(False)
    return d.groupBy("tenant_id", "account_id", named.alias("document_type")).agg(
        agg.signed_sum(exact("amount"), flip).alias("doc_amount"))


@model("recon_document_facts")
def document_facts(w: Warehouse) -> DataFrame:
    moved = sets.unpivot_pairs(w.model("fact_bank_transfer"), ["tenant_id"], {
        "from": (F.col("from_bank_account_id"), -exact("amount")), "to": (F.col("to_bank_account_id"), exact("amount"))},
        "side", "account_id", "a").groupBy("tenant_id", "account_id").agg(F.sum("a").alias("doc_amount")).withColumn("document_type", F.lit("TRANSFER"))
    key = ["tenant_id", "account_id", "document_type"]
    docs = reduce(DataFrame.unionByName, [document_side(w, s) for s in DOCUMENT_SIDES] + [moved]).groupBy(*key).agg(
        F.sum("doc_amount").alias("doc_amount"))
    gl = w.model("fact_general_ledger").filter(F.col("document_type").isin(LEDGER_DOCUMENT_TYPES)).groupBy(*key).agg(
        F.sum(exact("amount")).alias("gl_amount"))
    rec = quality.reconcile(gl, docs, key, "gl_amount", "doc_amount")
    return rec.select(*key, *[F.round(c, 2).cast("double").alias(c) for c in ("doc_amount", "gl_amount", "diff")])


def tie_out_model(fact: str, header: str, owner: str):
    def build(w: Warehouse) -> DataFrame:
        lines = w.model(fact).select("tenant_id", owner, exact("amount_in_currency").alias("net"))
        heads = newest(w, header, owner).select("tenant_id", owner, exact("sub_total").alias("sub_total"))
        return quality.tie_out(lines, heads, ["tenant_id", owner], "net", "sub_total")
    return build


# Most unbalanced or mismatched documents that still pass.
ASSERTION_THRESHOLD = 5
for _name in ("invoice_line", "credit_note_line", "bank_transaction_line", "overpayment_line", "purchase_order_line"):
    MODELS[f"assert_fact_{_name}_reconciles"] = tie_out_model(f"fact_{_name}", LINE_FACTS[_name].header, LINE_FACTS[_name].owner)


@model("assert_fact_quote_line_reconciles")
def quotes_tie(w: Warehouse) -> DataFrame:
    return quality.fails_above(tie_out_model("fact_quote_line", "quotes", "quote_id")(w), ASSERTION_THRESHOLD, "mismatched_quotes")


def balance_model(fact: str, journal: str):
    def build(w: Warehouse) -> DataFrame:
        rows = w.model(fact).select(journal, exact("amount").alias("a"))
        return quality.fails_above(quality.unbalanced(rows, [journal], "a"), ASSERTION_THRESHOLD, "unbalanced_journals")
    return build


MODELS["assert_fact_general_ledger_balances"] = balance_model("fact_general_ledger", "journal_id")
MODELS["assert_fact_manual_journal_line_balances"] = balance_model("fact_manual_journal_line", "manual_journal_id")


def constraint_report(w: Warehouse, name: str, keys: list[str], required: list[str]) -> DataFrame:
    """Non-NULL and unique-key checks every stored model must pass."""
    df = w.model(name)
    return quality.non_null(df, required, name).unionByName(quality.unique_key(df, keys, name))
