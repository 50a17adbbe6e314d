"""Document kinds of the source API, as configuration for the generic flattening.

Fields are listed by type. A column named ``sub_total`` is read from ``SubTotal`` and
``contact_id`` from ``ContactID``; ``column=Path`` names another place.
"""

from __future__ import annotations

from tallyframe.operators.documents import ChildSpec, DocumentSpec, Field

TYPES = {
    "text": "string", "whole": "bigint", "number": "double", "flag": "boolean", "active": "active",
    "moment": "epoch_timestamp", "day": "iso_date",
}


def json_name(column: str) -> str:
    return "".join("ID" if w == "id" else w.capitalize() for w in column.split("_"))


def fields(**by_type: str) -> list[Field]:
    """Field list from blank separated columns per type."""
    out = []
    for kind, names in by_type.items():
        for item in names.split():
            column, _, path = item.partition("=")
            out.append((column, path or json_name(column), TYPES[kind]))
    return out


def counts(names: str) -> dict[str, str]:
    return dict(item.split("=") for item in names.split())


# Two tracking slots of a line, named by their position in the array.
TRACKING = fields(text=" ".join(
    f"tracking_{what}_{slot}_{part}=Tracking[{slot - 1}].{path}"
    for slot in (1, 2)
    for what, part, path in (("category", "id", "TrackingCategoryID"), ("category", "name", "Name"),
                             ("option", "id", "TrackingOptionID"), ("option", "name", "Option"))))
JOURNAL_TRACKING = [(c, p.replace("Tracking[", "TrackingCategories["), t) for c, p, t in TRACKING if "option_1_id" not in c and "option_2_id" not in c]


def lines(owner: str, text: str, number: str, tracking: list[Field] = TRACKING, array: str = "LineItems", **more) -> ChildSpec:
    """Line items below a document, keyed by their own id unless told otherwise."""
    key = more.pop("key", ["line_item_id"])
    extra = more.pop("extra", [])
    ident = "line_item_id " if key == ["line_item_id"] else ""
    return ChildSpec(array, fields(text=ident + text, number=number) + extra + tracking, parent=fields(text=owner), key=key, **more)


CONTACT = "contact_id=Contact.ContactID contact_name=Contact.Name"
MONEY = "currency_rate sub_total total_tax total"

# Fields of each document kind.
DOCUMENTS: dict[str, DocumentSpec] = {
    "accounts": DocumentSpec("AccountID", fields(
        text="account_id account_code=Code account_name=Name account_type=Type account_class=Class status tax_type "
             "bank_account_type account_description=Description reporting_code reporting_name reporting_code_name",
        active="is_active=Status", flag="show_in_expense_claims enable_payments_to_account add_to_watchlist has_attachments",
        moment="updated_at=UpdatedDateUTC reporting_code_updated_at=ReportingCodeUpdatedUTC")),
    "bank_transactions": DocumentSpec("BankTransactionID", fields(
        text="bank_transaction_id bank_account_id=BankAccount.AccountID bank_account_code=BankAccount.Code "
             f"bank_account_name=BankAccount.Name {CONTACT} transaction_type=Type status line_amount_types reference url=URL currency_code",
        moment="transaction_date=Date updated_at=UpdatedDateUTC", day="transaction_date_local=DateString",
        number=MONEY, flag="is_reconciled has_attachments"),
        {"lines": lines("bank_transaction_id", "account_id account_code description tax_type", "quantity unit_amount line_amount tax_amount")},
        counts("line_item_count=LineItems")),
    "bank_transfers": DocumentSpec("BankTransferID", fields(
        text="bank_transfer_id from_bank_account_id=FromBankAccount.AccountID from_bank_account_code=FromBankAccount.Code "
             "from_bank_account_name=FromBankAccount.Name to_bank_account_id=ToBankAccount.AccountID to_bank_account_code=ToBankAccount.Code "
             "to_bank_account_name=ToBankAccount.Name from_bank_transaction_id to_bank_transaction_id reference status",
        flag="from_is_reconciled to_is_reconciled has_attachments", number="amount currency_rate",
        moment="transfer_date=Date created_at=CreatedDateUTC updated_at=UpdatedDateUTC")),
    "branding_themes": DocumentSpec("BrandingThemeID", fields(
        text="branding_theme_id theme_name=Name theme_type=Type logo_url", whole="sort_order", moment="created_at=CreatedDateUTC"),
        {"payment_services": ChildSpec("PaymentServices", fields(
            text="payment_service_id payment_service_name payment_service_type payment_service_url"),
            parent=fields(text="branding_theme_id"), key=["payment_service_id"])},
        counts("payment_service_count=PaymentServices")),
    "contacts": DocumentSpec("ContactID", fields(
        text="contact_id contact_number account_number contact_name=Name first_name last_name email_address website status=ContactStatus "
             "default_currency tax_number ar_tax_type=AccountsReceivableTaxType ap_tax_type=AccountsPayableTaxType "
             "branding_theme_id=BrandingTheme.BrandingThemeID",
        active="is_active=ContactStatus", flag="is_customer is_supplier has_attachments has_validation_errors",
        number="default_discount_pct=Discount ar_outstanding=Balances.AccountsReceivable.Outstanding "
               "ar_overdue=Balances.AccountsReceivable.Overdue ap_outstanding=Balances.AccountsPayable.Outstanding "
               "ap_overdue=Balances.AccountsPayable.Overdue",
        moment="updated_at=UpdatedDateUTC"), {
            "addresses": ChildSpec("Addresses", fields(
                text="address_type attention_to address_line_1=AddressLine1 address_line_2=AddressLine2 address_line_3=AddressLine3 "
                     "address_line_4=AddressLine4 city region postal_code country"),
                parent=fields(text="contact_id"), key=["address_type"]),
            "phones": ChildSpec("Phones", fields(
                text="phone_type country_code=PhoneCountryCode area_code=PhoneAreaCode phone_number"),
                parent=fields(text="contact_id"), key=["phone_type"], skip_blank="PhoneNumber"),
            "group_memberships": ChildSpec("ContactGroups", fields(text="contact_group_id group_name=Name group_status=Status"),
                                           parent=fields(text="contact_id"), key=["contact_group_id"]),
        }, counts("address_count=Addresses phone_count=Phones group_count=ContactGroups")),
    "credit_notes": DocumentSpec("CreditNoteID", fields(
        text=f"credit_note_id credit_note_number {CONTACT} credit_note_type=Type status line_amount_types reference currency_code",
        moment="credit_note_date=Date due_date fully_paid_on_date updated_at=UpdatedDateUTC", day="credit_note_date_local=DateString",
        number=f"{MONEY} remaining_credit", flag="sent_to_contact has_attachments has_errors"), {
            "lines": lines("credit_note_id", "account_id account_code description tax_type",
                           "quantity unit_amount line_amount tax_amount discount_rate discount_amount"),
            "allocations": ChildSpec("Allocations", fields(
                text="allocation_id invoice_id=Invoice.InvoiceID invoice_number=Invoice.InvoiceNumber", number="allocated_amount=Amount",
                flag="is_deleted", moment="allocation_date=Date"), parent=fields(text="credit_note_id"), key=["allocation_id"]),
        }, counts("line_item_count=LineItems allocation_count=Allocations payment_count=Payments")),
    "currencies": DocumentSpec("Code", fields(text="currency_code=Code currency_description=Description")),
    "invoices": DocumentSpec("InvoiceID", fields(
        text=f"invoice_id invoice_number {CONTACT} branding_theme_id invoice_type=Type status line_amount_types reference currency_code",
        moment="invoice_date=Date due_date fully_paid_on_date updated_at=UpdatedDateUTC",
        day="invoice_date_local=DateString due_date_local=DueDateString", number=f"{MONEY} amount_due amount_paid amount_credited",
        flag="sent_to_contact is_discounted has_attachments has_errors"), {
            "lines": lines("invoice_id", "account_id account_code item_code description tax_type",
                           "quantity unit_amount line_amount tax_amount discount_rate discount_amount"),
            "payments": ChildSpec("Payments", fields(text="payment_id reference", number="amount currency_rate", moment="payment_date=Date"),
                                  parent=fields(text="invoice_id"), key=["payment_id"]),
        }, counts("line_item_count=LineItems payment_count=Payments credit_note_count=CreditNotes")),
    "items": DocumentSpec("ItemID", fields(
        text="item_id item_code=Code item_name=Name description purchase_description sales_account_code=SalesDetails.AccountCode "
             "sales_tax_type=SalesDetails.TaxType cogs_account_code=PurchaseDetails.COGSAccountCode purchase_tax_type=PurchaseDetails.TaxType",
        flag="is_sold is_purchased is_tracked_as_inventory",
        number="quantity_on_hand total_cost_pool sales_unit_price=SalesDetails.UnitPrice purchase_unit_price=PurchaseDetails.UnitPrice",
        moment="updated_at=UpdatedDateUTC")),
    "journals": DocumentSpec("JournalID", fields(
        text="journal_id source_id source_type reference", whole="journal_number", moment="journal_date created_at=CreatedDateUTC"),
        {"lines": lines("journal_id", "journal_line_id account_id account_code account_name account_type description",
                        "gross_amount net_amount tax_amount", JOURNAL_TRACKING, "JournalLines", key=["journal_line_id"])},
        counts("journal_line_count=JournalLines")),
    "manual_journals": DocumentSpec("ManualJournalID", fields(
        text="manual_journal_id narration status line_amount_types", moment="journal_date=Date updated_at=UpdatedDateUTC",
        number="debit_total credit_total", flag="show_on_cash_basis_reports has_attachments"),
        {"lines": lines("manual_journal_id", "account_id account_code description tax_type", "line_amount tax_amount", TRACKING,
                        "JournalLines", key=["line_position"], extra=fields(flag="is_blank"), position="line_position", blank_flag="IsBlank")},
        counts("journal_line_count=JournalLines")),
    "organisations": DocumentSpec("OrganisationID", fields(
        text="organisation_id organisation_name=Name legal_name organisation_type status=OrganisationStatus base_currency country_code "
             "tax_number registration_number", flag="is_demo_company", whole="financial_year_end_day financial_year_end_month",
        moment="created_at=CreatedDateUTC")),
    "overpayments": DocumentSpec("OverpaymentID", fields(
        text=f"overpayment_id overpayment_type=Type status line_amount_types reference {CONTACT} currency_code",
        moment="overpayment_date=Date updated_at=UpdatedDateUTC", number=f"{MONEY} remaining_credit", flag="has_attachments"),
        {"lines": lines("overpayment_id", "account_id account_code description tax_type", "quantity unit_amount line_amount tax_amount")},
        counts("line_item_count=LineItems allocation_count=Allocations payment_count=Payments")),
    "payments": DocumentSpec("PaymentID", fields(
        text="payment_id payment_type status reference account_id=Account.AccountID account_code=Account.Code invoice_id=Invoice.InvoiceID "
             "invoice_number=Invoice.InvoiceNumber invoice_type=Invoice.Type contact_id=Invoice.Contact.ContactID "
             "contact_name=Invoice.Contact.Name batch_payment_id=BatchPaymentID|BatchPayment.BatchPaymentID",
        moment="payment_date=Date updated_at=UpdatedDateUTC", number="amount bank_amount currency_rate",
        flag="is_reconciled has_account has_validation_errors")),
    "purchase_orders": DocumentSpec("PurchaseOrderID", fields(
        text=f"purchase_order_id purchase_order_number purchase_order_type=Type {CONTACT} branding_theme_id status reference line_amount_types "
             "attention_to telephone delivery_address delivery_instructions currency_code",
        moment="order_date=Date updated_at=UpdatedDateUTC", day="order_date_local=DateString", number=MONEY,
        flag="is_discounted has_attachments has_errors"),
        {"lines": lines("purchase_order_id", "item_code account_code description tax_type",
                        "quantity unit_amount line_amount tax_amount discount_rate")},
        counts("line_item_count=LineItems")),
    "quotes": DocumentSpec("QuoteID", fields(
        text=f"quote_id quote_number {CONTACT} contact_email=Contact.EmailAddress branding_theme_id status reference line_amount_types terms currency_code",
        moment="quote_date=Date expiry_date updated_at=UpdatedDateUTC", day="quote_date_local=DateString expiry_date_local=ExpiryDateString",
        number=f"{MONEY} total_discount"),
        {"lines": lines("quote_id", "description", "quantity unit_amount line_amount tax_amount discount_amount")},
        counts("line_item_count=LineItems")),
    "tax_rates": DocumentSpec("TaxType", fields(
        text="tax_type tax_name=Name status report_tax_type tax_component_name=TaxComponents[0].Name", active="is_active=Status",
        number="display_tax_rate effective_rate tax_component_rate=TaxComponents[0].Rate",
        flag="can_apply_to_assets can_apply_to_equity can_apply_to_expenses can_apply_to_liabilities can_apply_to_revenue "
             "tax_component_is_compound=TaxComponents[0].IsCompound tax_component_is_non_recoverable=TaxComponents[0].IsNonRecoverable")),
    "tracking_categories": DocumentSpec("TrackingCategoryID", fields(
        text="tracking_category_id category_name=Name status", active="is_active=Status"),
        {"options": ChildSpec("Options", fields(text="tracking_option_id option_name=Name status", flag="is_active is_archived is_deleted"),
                              parent=fields(text="tracking_category_id category_name=Name"), key=["tracking_option_id"])},
        counts("option_count=Options")),
    "users": DocumentSpec("UserID", fields(
        text="user_id global_user_id first_name last_name email_address organisation_role", flag="is_subscriber", moment="updated_at=UpdatedDateUTC")),
}

# Staging tables of child relations whose name is not "<document>_<child>".
CHILD_TABLES = {
    ("branding_themes", "payment_services"): "branding_theme_payment_services", ("contacts", "addresses"): "contact_addresses",
    ("contacts", "phones"): "contact_phones", ("contacts", "group_memberships"): "contact_group_memberships",
    ("tracking_categories", "options"): "tracking_options",
}


def child_table(endpoint: str, child: str) -> str:
    return CHILD_TABLES.get((endpoint, child), f"{endpoint.removesuffix('s')}_{child}")
