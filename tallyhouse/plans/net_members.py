"""Net member count: live agreements with who sold, referred and advised them.

Lookups are grouped by key. Everything known per agreement is joined first, on the
agreement id and so on one partitioning; the result is kept as a stage. Lookups by
invoice, user, party and referrer follow. Each source is cut to one row per key
before its join, so no join repeats or loses a row.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import like_any, moment
from tallyhouse.operators import (
    enrich, exclude, first_per_key, latest_values, left_join_sparse, restrict_to_keys, typed_insert,
)
from tallyhouse.operators.keyed import latest_aggregates
from tallyhouse.sinks.counts import RunCounts
from tallyhouse.sinks.stages import StageArea

col = F.col

# What tells the report's rows apart.
_ROW = ["agreement_id", "bundle_id"]


def member_count_schema() -> StructType:
    """Declared columns and types of the report."""
    return StructType.fromDDL(fixed.MEMBER_COUNT_DDL)


def net_member_count(
    tables: Mapping[str, DataFrame], *, now: datetime, exclusion_report: str = fixed.MEMBER_COUNT_EXCLUSION,
    case_insensitive: bool = True, fix_advisor_role: bool = False, stages: StageArea | None = None,
    counts: RunCounts | None = None,
) -> DataFrame:
    """One row per live agreement and key bundle, in the declared columns and types.

    The advisor's work role is looked up by the salesperson, and so is filled only where
    the salesperson advises some agreement too; ``fix_advisor_role`` looks it up by the
    advisor. Where several source rows fit, the one with the highest id is used. ``counts`` learns how many rows
    each exclusion left, and how many agreements have no known seller or PIN user.
    """
    stages = stages or StageArea(tables["MemberAgreement"].sparkSession)
    staff = stages.keep(staff_roles(tables), "staff")
    base = stages.keep(agreements_counted(tables, now, exclusion_report, case_insensitive, counts), "base")
    # Every lookup below starts from the agreements that count.
    counted = base.select("agreement_id").distinct()
    items = stages.keep(key_items(tables, counted), "items")
    invoiced = stages.keep(invoice_of_agreement(tables, counted), "invoiced")
    agreements = (
        base.join(invoiced, "agreement_id", "left")
        .join(first_bill_dates(tables, items, invoiced), "agreement_id", "left")
        .join(monthly_dues(tables, items), "agreement_id", "left")
        .join(advisors(tables, counted, staff), "agreement_id", "left")
    )
    agreements = stages.keep(agreements, "agreements")

    users = staff_users(tables, staff)
    roles = stages.keep(work_roles(tables), "work_roles")
    rows = _with_sellers(tables, agreements)
    for who, user in (("sales", "seller_user"), ("pin", "pin_user")):
        found = {f"{who}_{c}": c for c in ("party", "role_id", "first_name", "last_name", "payroll", "username")}
        rows = enrich(rows, users, user, "user_id", found, spread_by=_ROW, counts=counts, step=f"{who} user")
    rows = enrich(rows, roles, "sales_party", "party", {"sales_work_role": "work_role"}, spread_by=_ROW)
    rows = _with_members(tables, rows)
    rows = left_join_sparse(rows, referrers(tables, agreements, roles, stages), "referred_by", "key", _ROW)
    if fix_advisor_role:
        rows = enrich(rows, roles, "advisor_party", "party", {"advisor_work_role": "work_role"}, spread_by=_ROW)
    else:
        advising = restrict_to_keys(roles, "party", agreements.select("advisor_party").distinct())
        rows = enrich(rows, advising, "sales_party", "party", {"advisor_work_role": "work_role"}, spread_by=_ROW)
    return typed_insert(rows.selectExpr(*_output()), member_count_schema())


def agreements_counted(
    tables: Mapping[str, DataFrame], now: datetime, exclusion_report: str, case_insensitive: bool, counts: RunCounts | None = None,
) -> DataFrame:
    """Agreements that are not expired, of the counted kinds, not trial bundles, not excluded."""
    exclusions = tables["Staging_ReportExclusionStaging"]
    plans = tables["Agreement"].filter(
        col("AgreementClassificationID").isin(*fixed.COUNTED_CLASSIFICATIONS)
    ).selectExpr("AgreementID as plan_id", "Name as plan_name")
    bundles = tables["Bundle"].filter(~like_any(col("Name"), fixed.NON_MEMBER_BUNDLES, case_insensitive)).selectExpr(
        "BundleID as bundle_id", "Code as bundle_code", "Name as bundle_name",
    )
    units = tables["BusinessUnit"].selectExpr("BusinessUnitId as known_unit", "Name as unit_name")
    statuses = tables["StatusMap"].filter(col("StatusMapType") == fixed.STATUS_AGREEMENT).selectExpr(
        "StatusId as status", "Name as status_name",
    )
    # Plans and bundles must be known, so excluding them there is the same and smaller.
    plans = exclude(plans, exclusions, exclusion_report, {"AgreementID": "plan_id"}, counts)
    bundles = exclude(bundles, exclusions, exclusion_report, {"BundleID": "bundle_id"}, counts)
    held = (
        tables["MemberAgreementItem"].filter(col("IsKeyItem") == 1)
        .selectExpr("MemberAgreementId as agreement_id", "BundleId as bundle_id")
        .join(bundles, "bundle_id")
        .distinct()
    )
    live = (
        tables["MemberAgreement"].filter(col("Status") != fixed.AGREEMENT_STATUS_EXPIRED)
        .selectExpr(
            "MemberAgreementId as agreement_id", "PartyRoleId as agreement_role", "AgreementId as plan_id",
            "BusinessUnitId as unit_id", "Status as status", "StartDate as started_at", "EndDate as ends_at",
            "ObligationDate as obliged_until",
        )
        .join(plans, "plan_id")
        .join(statuses, "status", "left")
        .join(units, F.expr("unit_id = known_unit"), "left")
    )
    live = exclude(live, exclusions, exclusion_report, {"BusinessUnitID": "known_unit"}, counts)
    return live.join(held, "agreement_id").join(cancellation_dates(tables, now), "agreement_id", "left")


def cancellation_dates(tables: Mapping[str, DataFrame], now: datetime) -> DataFrame:
    """Date of each agreement's latest finished and latest coming cancellation, in one pass."""
    agreements = tables["Cancellation"].filter(col("EntityIdType") == fixed.CANCEL_ENTITY_AGREEMENT)
    coming = (col("Date") >= moment(now)) & ~col("StateId").isin(fixed.CANCEL_STATE_DONE, *fixed.CANCEL_STATES_VOID)
    kinds = agreements.withColumn("coming", coming)
    return kinds.groupBy(col("EntityId").alias("agreement_id")).agg(
        *latest_aggregates({"cancelled_at": "Date"}, "CancellationID", f"StateId = {fixed.CANCEL_STATE_DONE}"),
        *latest_aggregates({"cancels_at": "Date"}, "CancellationID", "coming"),
    )


def key_items(tables: Mapping[str, DataFrame], counted: DataFrame) -> DataFrame:
    """Key items of the counted agreements."""
    items = tables["MemberAgreementItem"].filter(col("IsKeyItem") == 1).selectExpr(
        "MemberAgreementItemId as item_id", "MemberAgreementId as agreement_id",
    )
    return restrict_to_keys(items, "agreement_id", counted)


def invoice_of_agreement(tables: Mapping[str, DataFrame], counted: DataFrame) -> DataFrame:
    """Invoice of each counted agreement's latest invoiced billing request."""
    requests = tables["MemberAgreementInvoiceRequest"].filter(col("Status") == fixed.REQUEST_INVOICED)
    return latest_values(
        restrict_to_keys(requests, "MemberAgreementId", counted),
        [col("MemberAgreementId").alias("agreement_id")], {"invoice_id": "TxInvoiceId"},
        "MemberAgreementInvoiceRequestId",
    )


def first_bill_dates(tables: Mapping[str, DataFrame], items: DataFrame, invoiced: DataFrame) -> DataFrame:
    """Earliest bill date of an agreement's key items on an invoice other than its own.

    Requests not invoiced yet, and agreements without an invoice, give none. The request items
    are cut to the key items before they meet the requests.
    """
    billed = tables["MemberAgreementInvoiceRequestItem"].selectExpr(
        "MemberAgreementItemId as item_id", "MemberAgreementInvoiceRequestId as request_id",
    )
    process = F.coalesce(col("ProcessType"), F.lit(0))
    requests = (
        tables["MemberAgreementInvoiceRequest"]
        .filter((process != fixed.PROCESS_TYPE_SKIPPED) & col("TxInvoiceId").isNotNull())
        .selectExpr(
            "MemberAgreementInvoiceRequestId as request_id", "TxInvoiceId as billed_invoice",
            "BillDate as billed_at",
        )
    )
    per_invoice = (
        billed.join(items, "item_id").join(requests, "request_id")
        .groupBy("agreement_id", "billed_invoice").agg(F.min("billed_at").alias("billed_at"))
    )
    return (
        per_invoice.join(invoiced, "agreement_id").filter(col("billed_invoice") != col("invoice_id"))
        .groupBy("agreement_id").agg(F.min("billed_at").alias("first_billed_at"))
    )


def monthly_dues(tables: Mapping[str, DataFrame], items: DataFrame) -> DataFrame:
    """Price with the lowest sequence among an agreement's key items; no sequence comes first.

    A key item without prices counts as one with neither sequence nor price.
    """
    prices = tables["MemberAgreementItemPerpetual"].selectExpr(
        "MemberAgreementItemId as item_id", "Sequence as sequence", "Price as price",
    )
    # An item's own first price decides, so no item carries more than one into the join.
    prices = restrict_to_keys(prices, "item_id", items.select("item_id").distinct())
    prices = first_per_key(prices, ["item_id"], ["sequence asc nulls first", "price asc nulls first"])
    order = ["sequence asc nulls first", "item_id desc", "price asc nulls first"]
    first = first_per_key(items.join(prices, "item_id", "left"), ["agreement_id"], order)
    return first.selectExpr("agreement_id", "price as dues")


def staff_roles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Party roles of employees, with their names."""
    people = tables["ReportingEmployeeCharacteristics"].selectExpr(
        "PartyId as party", "`First Name` as first_name", "`Last Name` as last_name", "`Payroll ID` as payroll",
    )
    roles = tables["PartyRole"].selectExpr(
        "PartyID as party", "PartyRoleID as role_key", "RoleID as role_id",
    )
    return people.join(roles, "party")


# The highest role counts; people repeated under it are told apart by their columns.
_STAFF_ORDER = [
    "role_key desc",
    *[f"{name} asc nulls first" for name in ("first_name", "last_name", "payroll", "role_id")],
]


def staff_users(tables: Mapping[str, DataFrame], staff: DataFrame) -> DataFrame:
    """Employee behind each user account; the highest role counts."""
    accounts = tables["UserAccount"].selectExpr(
        "UserAccountId as user_id", "PartyID as party", "Username as username",
    )
    return accounts.join(first_per_key(staff, ["party"], _STAFF_ORDER), "party")


def advisors(tables: Mapping[str, DataFrame], counted: DataFrame, staff: DataFrame) -> DataFrame:
    """Employee who is an agreement's first sales adviser; the highest role counts."""
    advising = tables["MemberAgreementSalesAdviser"].filter(col("Sequence") == 1).selectExpr(
        "MemberAgreementId as agreement_id", "PartyRoleId as role_key",
    )
    advising = restrict_to_keys(advising, "agreement_id", counted)
    first = first_per_key(advising.join(staff, "role_key"), ["agreement_id"], _STAFF_ORDER)
    return first.selectExpr(
        "agreement_id",
        *[f"{name} as advisor_{name}" for name in ("party", "role_id", "first_name", "last_name", "payroll")],
    )


def work_roles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Work role of the highest source level per party, whichever unit it is for.

    Equal levels are told apart by the highest role id.
    """
    names = tables["WorkRole"].selectExpr("WorkRoleID as known_role", "Name as work_role")
    held = tables["EmployeeWorkRole"].filter(col("PartyId").isNotNull()).selectExpr(
        "PartyId as party", "WorkRoleID as held_role", "WorkRoleSourceLevel as level",
    )
    order = ["level desc nulls last", "held_role desc", "work_role asc nulls first"]
    return first_per_key(held.join(names, F.expr("held_role = known_role")), ["party"], order).select(
        "party", "work_role"
    )


def _with_sellers(tables: Mapping[str, DataFrame], rows: DataFrame) -> DataFrame:
    """Users who sold and who authenticated the sale, by the work unit of the invoice."""
    invoices = tables["TxInvoice"].selectExpr("TxInvoiceID as key", "WorkUnitId as work_unit")
    units = tables["WorkUnit"].selectExpr(
        "WorkUnitID as key", "UserId as seller_user", "AuthenticatedUserId as pin_user",
    )
    rows = left_join_sparse(rows, invoices, "invoice_id", "key", _ROW)
    return left_join_sparse(rows, units, "work_unit", "key", _ROW)


def _member_roles(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["PartyRole"].selectExpr(
        "PartyRoleID as key", "PartyRoleID as role_key", "PartyID as party_id", "RoleID as role_id",
        "ReferredByPartyRoleID as referred_by",
    )


def _with_members(tables: Mapping[str, DataFrame], rows: DataFrame) -> DataFrame:
    """Member of the agreement, with their name and who referred them."""
    names = tables["PartyPropertiesReportingView"].selectExpr(
        "PartyID as key", "`First Name` as first_name", "`Last Name` as last_name",
    )
    rows = left_join_sparse(rows, _member_roles(tables), "agreement_role", "key", _ROW)
    return left_join_sparse(rows, names, "party_id", "key", _ROW)


def referrers(
    tables: Mapping[str, DataFrame], agreements: DataFrame, roles: DataFrame, stages: StageArea
) -> DataFrame:
    """Who referred the members of these agreements: an employee, else a member; one row per referrer."""
    members = restrict_to_keys(_member_roles(tables), "key", agreements.select("agreement_role").distinct())
    found = tables["PartyRole"].selectExpr("PartyRoleID as key", "PartyID as referrer_party")
    found = stages.keep(restrict_to_keys(found, "key", members.select("referred_by").distinct()), "referrers")
    parties = found.select("referrer_party").distinct()
    staff = _one_name_per_party(tables["ReportingEmployeeCharacteristics"], parties, "staff", ["Payroll ID"])
    member = _one_name_per_party(tables["ReportingMemberCharacteristics"], parties, "member", [])
    named = (
        found.join(staff, F.expr("referrer_party = staff_party"), "left")
        .join(member, F.expr("referrer_party = member_party"), "left")
        .selectExpr(
            "key", "referrer_party", "coalesce(staff_first, member_first) as referrer_first",
            "coalesce(staff_last, member_last) as referrer_last", "staff_payroll as referrer_payroll",
        )
    )
    return enrich(named, roles, "referrer_party", "party", {"referrer_work_role": "work_role"}, spread_by=["key"])


def _one_name_per_party(people: DataFrame, parties: DataFrame, kind: str, more: list[str]) -> DataFrame:
    people = restrict_to_keys(people, "PartyID", parties)
    columns = ["First Name", "Last Name", *more]
    first = first_per_key(people, ["PartyID"], [f"`{name}` asc nulls first" for name in columns])
    short = {"First Name": "first", "Last Name": "last", "Payroll ID": "payroll"}
    return first.selectExpr(
        f"PartyID as {kind}_party", *[f"`{name}` as {kind}_{short[name]}" for name in columns]
    )


def _output() -> list[str]:
    """Output columns by name; their order and types come from the declared schema."""
    columns = {
        "MemberAgreementId": "agreement_id", "AgreementStatus": "status_name", "PartyRoleId": "role_key",
        "PartyID": "party_id", "RoleId": "role_id", "FirstName": "first_name", "LastName": "last_name",
        "BUName": "unit_name", "StartDate": "started_at", "EndDate": "ends_at", "ObligationDate": "obliged_until",
        "CancelDate": "cancelled_at", "FutureCancelDate": "cancels_at", "BusinessUnitId": "unit_id",
        "AgreementId": "plan_id", "Agreement": "plan_name", "BundleId": "bundle_id", "BundleItemCode": "bundle_code",
        "BundleName": "bundle_name", "REFERRAL_PARTYROLEID1": "referred_by", "REFERRAL_PARTYID1": "referrer_party",
        "REFERRAL_FIRSTNAME1": "referrer_first", "REFERRAL_LASTNAME1": "referrer_last",
        "REFERRAL_PAYROLLID": "referrer_payroll", "REFERRAL_WORKROLE": "referrer_work_role",
        "SALES_WORKROLE": "sales_work_role", "ADVISOR_WORKROLE": "advisor_work_role",
        "AGREEMENT_MONTHLYDUES": "dues", "FIRSTINVOICEDATE": "first_billed_at", "SALES_USERNAME": "sales_username",
    }
    for who in ("SALES", "ADVISOR", "PIN"):
        for name, ours in (("ROLEID", "role_id"), ("FIRSTNAME", "first_name"), ("LASTNAME", "last_name"),
                           ("PAYROLLID", "payroll")):
            columns[f"{who}_{name}"] = f"{who.lower()}_{ours}"
    return [f"{ours} as {name}" for name, ours in columns.items()]
