"""Endpoint configuration: where the records sit in a page and what identifies one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources.seeds import seed

# Endpoint, array key of the page, id field of a record.
ENDPOINTS = [
    ("accounts", "Accounts", "AccountID"),
    ("bank_transactions", "BankTransactions", "BankTransactionID"),
    ("bank_transfers", "BankTransfers", "BankTransferID"),
    ("batch_payments", "BatchPayments", "BatchPaymentID"),
    ("branding_themes", "BrandingThemes", "BrandingThemeID"),
    ("budgets", "Budgets", "BudgetID"),
    ("contact_groups", "ContactGroups", "ContactGroupID"),
    ("contacts", "Contacts", "ContactID"),
    ("credit_notes", "CreditNotes", "CreditNoteID"),
    ("currencies", "Currencies", "Code"),
    ("expense_claims", "ExpenseClaims", "ExpenseClaimID"),
    ("invoices", "Invoices", "InvoiceID"),
    ("items", "Items", "ItemID"),
    ("journals", "Journals", "JournalID"),
    ("linked_transactions", "LinkedTransactions", "LinkedTransactionID"),
    ("manual_journals", "ManualJournals", "ManualJournalID"),
    ("organisations", "Organisations", "OrganisationID"),
    ("overpayments", "Overpayments", "OverpaymentID"),
    ("payment_services", "PaymentServices", "PaymentServiceID"),
    ("payments", "Payments", "PaymentID"),
    ("prepayments", "Prepayments", "PrepaymentID"),
    ("purchase_orders", "PurchaseOrders", "PurchaseOrderID"),
    ("quotes", "Quotes", "QuoteID"),
    ("receipts", "Receipts", "ReceiptID"),
    ("repeating_invoices", "RepeatingInvoices", "RepeatingInvoiceID"),
    ("report_balance_sheet", "Reports", "ReportID"),
    ("report_bank_summary", "Reports", "ReportID"),
    ("report_budget_summary", "Reports", "ReportID"),
    ("report_executive_summary", "Reports", "ReportID"),
    ("report_profit_and_loss", "Reports", "ReportID"),
    ("report_trial_balance", "Reports", "ReportID"),
    ("tax_rates", "TaxRates", "TaxType"),
    ("tracking_categories", "TrackingCategories", "TrackingCategoryID"),
    ("users", "Users", "UserID"),
]


def endpoint_config(spark: SparkSession) -> DataFrame:
    return seed(spark, ENDPOINTS, "endpoint string, array_key string, id_field string")
