"""Daily payment extracts: point-of-sale and batch.

Both read the payments of a day window, a small part of the payment table. The window
is kept as a stage, so that its size is known: while small it is broadcast to the
ledger and request scans, which then need no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import as_text, day_window, optional_filter
from tallyhouse.operators import (
    exclude, left_join_many, left_join_sparse, restrict_to_keys, unmatched, wide_key_distinct,
)
from tallyhouse.sinks.stages import StageArea
from tallyhouse.streaming.highwater import Extract, day_aligned, resolve_window

col = F.col


def daily_pos(
    tables: Mapping[str, DataFrame], *, now: datetime, tenant: str, current_mark: datetime | None = None,
    new_mark: datetime | None = None, payment_id: int | None = None, member: str | None = None,
    case_insensitive: bool = True, exclusion_report: str | None = None, stages: StageArea | None = None,
) -> Extract:
    """Payments of the window that never went to the batch processor.

    ``current_mark`` is the first day, yesterday by default; ``new_mark`` the day after the
    last, one day later by default, and the mark to start the next run from. ``tenant``
    chooses the exclusion list; ``exclusion_report`` names one directly, for any other tenant. ``payment_id`` and ``member`` narrow the extract down.
    """
    low, high = resolve_window(current_mark, new_mark, now)
    stages = stages or StageArea(tables["TxPayment"].sparkSession)
    report = exclusion_report or fixed.EXCLUSION_REPORTS["pos", tenant.lower()]
    window = stages.keep(_payments(tables, low, high, payment_id, member, report), "pos_window")
    ids = window.select("payment_id")
    requests = tables["PaymentProcessRequest"].selectExpr("TxPaymentID as requested_payment")
    requests = restrict_to_keys(requests, "requested_payment", ids)
    payments = unmatched(window, requests, "payment_id", "requested_payment")
    # Equal electronic rows of a payment are counted before the join.
    electronic = restrict_to_keys(_electronic(tables), "eft_payment", ids)
    electronic = electronic.groupBy(*electronic.columns).agg(F.count("*").cast("decimal(19,0)").alias("eft_times"))
    ledger = stages.keep(restrict_to_keys(_payment_ledger(tables), "ledger_payment", ids), "pos_ledger")
    units = _units(tables).withColumnRenamed("unit_merchant", "merchant")
    paid = payments.join(electronic, F.expr("payment_id = eft_payment"), "left").join(units, "unit_id", "left")
    joined = left_join_many(stages.keep(paid, "pos_paid"), ledger, "payment_id", "ledger_payment")
    keys = [name for name in joined.columns if name not in ("eft_payment", "eft_merchant", "eft_times", "ledger_payment")]
    # Summing an amount that is also a key gives it once per repeated row.
    amount = F.expr("sum(ledger_amount * coalesce(eft_times, 1)) as transaction_amount")
    summed = joined.groupBy(*keys).agg(amount)
    summed = stages.keep(summed, "pos_summed")
    invoices = _invoices(tables, summed)
    detail = left_join_sparse(_codes(tables, summed), invoices, "invoice_id", "known_invoice", ["payment_id"])
    # Requests are absent by construction, so the code is always blank.
    output = {
        "RoleId": "role_id", "TxPaymentID": "payment_id", "TxInvoiceID": "invoice_id",
        "BusinessUnit": "unit_name", "GLCodePrefix": "gl_prefix", "Code": "unit_code",
        "MOSOPayTransactionCode": "''", "MOSOPay-Reference": "reference",
        "BatchID": "''", "Category": _text(fixed.CATEGORY_POS), "ReferenceID": "''",
        "MerchantCode": "merchant", "ResponseCode": "response", "ResponseMessage": "response_text",
        **_common_output(case_insensitive),
    }
    # Rows are told apart by what is shown, before it is worded, and by these (E9).
    wide = _told_apart(output, detail, "party_id", "transaction_id")
    chosen = {name: output[name] for name in fixed.names(fixed.POS_COLUMNS)}
    return Extract(wide_key_distinct(detail, wide, chosen), low, high)


def daily_batch(
    tables: Mapping[str, DataFrame], *, now: datetime, tenant: str, current_mark: datetime | None = None,
    new_mark: datetime | None = None, transaction_code: int | str | None = None, payment_id: int | None = None,
    member: str | None = None, case_insensitive: bool = True, exclusion_report: str | None = None,
    stages: StageArea | None = None,
) -> Extract:
    """Payments of the window that were sent to the batch processor and answered.

    Parameters as in :func:`daily_pos`; ``transaction_code`` is the id of one request.
    """
    low, high = resolve_window(current_mark, new_mark, now)
    stages = stages or StageArea(tables["TxPayment"].sparkSession)
    code = None if transaction_code is None else int(transaction_code)
    report = exclusion_report or fixed.EXCLUSION_REPORTS["batch", tenant.lower()]
    payments = _payments(tables, low, high, payment_id, member, report)
    payments = stages.keep(payments, "batch_payments")
    requests = tables["PaymentProcessRequest"].filter(optional_filter(col("PaymentProcessRequestId"), code)).selectExpr(
        "TxPaymentID as payment_id", "PaymentProcessRequestId as request_id", "PaymentProcessBatchId as batch_id",
    )
    sent = stages.keep(requests.join(payments, "payment_id"), "batch_sent")
    ledger = restrict_to_keys(_payment_ledger(tables), "ledger_payment", payments.select("payment_id"))
    # Equal ledger rows of a payment are added up before the join.
    ledger_keys = ["ledger_payment", "ledger_text", "ledger_amount", "credit", "invoice_id"]
    ledger = stages.keep(ledger.groupBy(*ledger_keys).agg(F.sum("ledger_amount").alias("added")), "batch_ledger")
    keys = [
        "payment_id", "request_id", "batch_id", "paid_at", "card_type", "tender_id", "role_key", "role_id",
        "party_id", "declined",
    ]
    summed = (
        left_join_many(sent, ledger, "payment_id", "ledger_payment")
        .groupBy(*keys, *ledger_keys[1:])
        .agg(F.sum("added").alias("transaction_amount"))
    )
    summed = stages.keep(summed, "batch_summed")
    responses = tables["PaymentProcessResponse"].selectExpr(
        "PaymentProcessRequestId as answered", "ReferenceId as response_reference", "ResponseCode as response",
        "ResponseMessage as response_text",
    )
    responses = restrict_to_keys(responses, "answered", sent.select("request_id").distinct()).distinct()
    electronic = restrict_to_keys(_electronic(tables), "eft_payment", sent.select("payment_id").distinct()).select(
        "eft_payment", "token", "mask", "expires", "eft_merchant"
    ).distinct()
    detail = (
        summed.join(_invoices(tables, summed), F.expr("invoice_id = known_invoice"))
        .join(responses, F.expr("request_id = answered"))
        .join(electronic, F.expr("payment_id = eft_payment"), "left")
        .join(_units(tables), F.expr("invoice_unit = unit_id"), "left")
    )
    output = {
        "RoleId": "role_id", "TxPaymentID": "payment_id", "TxInvoiceID": "known_invoice",
        "BusinessUnit": "unit_name", "GLCodePrefix": "gl_prefix", "Code": "unit_code",
        "MOSOPayTransactionCode": "request_id", "BatchID": "batch_id",
        "Category": _text(fixed.CATEGORY_BATCH), "ReferenceId": "response_reference",
        "MerchantCode": "eft_merchant", "ResponseCode": "response", "ResponseMessage": "response_text",
        **_common_output(case_insensitive),
    }
    detail = _codes(tables, detail)
    wide = _told_apart(output, detail, "party_id", "ledger_text")
    chosen = {name: output[name] for name in fixed.names(fixed.BATCH_COLUMNS)}
    return Extract(wide_key_distinct(detail, wide, chosen), low, high)


def _window(tables: Mapping[str, DataFrame], low: datetime, high: datetime, payment_id: int | None) -> DataFrame:
    in_window = day_window(col("TargetDate"), *day_aligned(low, high))
    return tables["TxPayment"].filter(in_window & optional_filter(col("TxPaymentID"), payment_id))


def _payments(
    tables: Mapping[str, DataFrame], low: datetime, high: datetime, payment_id: int | None, member: str | None,
    exclusion_report: str,
) -> DataFrame:
    """Payments of the window by members with a known id, without the excluded tender types."""
    roles = tables["PartyRole"].filter(optional_filter(as_text(col("RoleID")), member)).selectExpr(
        "PartyRoleID as role_key", "PartyID as party_id", "RoleID as role_id",
    )
    kept = exclude(
        _window(tables, low, high, payment_id), tables["Staging_ReportExclusionStaging"], exclusion_report,
        {"TenderTypeID": "TenderTypeID"},
    )
    return kept.selectExpr(
        "TxPaymentID as payment_id", "PartyRoleId as role_key", "LinkId as link_id", "LinkTypeID as link_type",
        "Reference as reference", "TargetDate as paid_at", "Amount as payment_amount", "TenderTypeID as tender_id",
        "TargetBusinessUnitId as unit_id", "CreditCardTypeId as card_type", "IsDeclined as declined",
    ).join(roles, "role_key")


def _payment_ledger(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["TxTransaction"].filter(col("TxTypeID") == fixed.TX_TYPE_PAYMENT).selectExpr(
        "ItemId as ledger_payment", "Description as ledger_text", "Amount as ledger_amount",
        "IsAccountingCredit as credit", "TxInvoiceId as invoice_id", "TxTransactionID as transaction_id",
        "WorkUnitId as work_unit",
    )


def _electronic(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["TxPaymentEft"].selectExpr(
        "TxPaymentId as eft_payment", "Token as token", "Mask as mask", "ExpirationDate as expires",
        "MerchantCode as eft_merchant", "ResponseCode as response", "ResponseMessage as response_text",
    )


def _units(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["BusinessUnit"].selectExpr(
        "BusinessUnitId as unit_id", "Name as unit_name", "Code as unit_code", "GLCodePrefix as gl_prefix",
        "POSMerchantAccountCode as unit_merchant",
    )


def _invoices(tables: Mapping[str, DataFrame], rows: DataFrame) -> DataFrame:
    invoices = tables["TxInvoice"].selectExpr(
        "TxInvoiceID as known_invoice", "TargetDate as invoiced_at", "TargetBusinessUnitId as invoice_unit",
    )
    return restrict_to_keys(invoices, "known_invoice", rows.select("invoice_id").distinct())


def _codes(tables: Mapping[str, DataFrame], rows: DataFrame) -> DataFrame:
    """Attach the names of card type, tender and cash account, and the unit's merchant ids."""
    cards = tables["CreditCardType"].selectExpr(
        "CreditCardTypeID as card_type", "Description as card_name", "Abbreviation as card_short",
    )
    accounts = tables["GeneralLedgerCode"].selectExpr(
        "GeneralLedgerCodeId as account_id", "Description as cash_account",
    )
    tenders = tables["TenderType"].selectExpr(
        "TenderTypeID as tender_id", "Name as tender", "GeneralLedgerCodeId as tender_account",
    )
    merchants = tables["Ref_TSI_MIDs_Reference"].withColumnRenamed("OrgID", "merchant_prefix")
    return (
        rows.join(cards, "card_type", "left")
        .join(tenders, "tender_id", "left")
        .join(accounts, F.expr("tender_account = account_id"), "left")
        .join(merchants, F.expr("gl_prefix = merchant_prefix"), "left")
    )


def _told_apart(output: Mapping[str, str], detail: DataFrame, *more: str) -> list[str]:
    """The columns of ``detail`` that the output is worded from, and further ones."""
    words = set(re.findall(r"`([^`]+)`|(\w+)", " ".join(output.values())))
    used = {quoted or plain for quoted, plain in words}
    return [name for name in detail.columns if name in used or name in more]


def _text(value: str) -> str:
    """A text literal in SQL."""
    return f"'{value}'"


def _common_output(case_insensitive: bool) -> dict[str, str]:
    """Output columns that both extracts form alike, as SQL."""
    credit, debit = map(_text, fixed.CREDIT_TEXT)
    like = "ilike" if case_insensitive else "like"
    return {
        "TransCode": _text(fixed.TRANS_CODE), "PaymentDate": "paid_at", "InvoiceDate": "invoiced_at",
        "TenderType": "tender", "CC Description": "card_name", "CC Abreviation": "card_short",
        "Token": "token", "Mask": "mask", "ExpirationDate": "expires",
        "Debit/Credit Indicator": f"if(credit = 1, {credit}, {debit})",
        "TransactionAmount": "transaction_amount", "CashGLAcct": "cash_account",
        **{name: f"cast(`{name}` as string)" for name in fixed.MERCHANT_ID_COLUMNS},
        "Chargeback_ind": f"if(declined = 1 and response {like} {_text(fixed.APPROVED_RESPONSE)}, 1, 0)",
    }
