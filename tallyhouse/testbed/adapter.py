"""Billing tables derived from the generated test tables.

One SELECT per table, in SQL that Spark and DuckDB both read, so that a report and its
check run on the same rows. Every source row is used; CASE expressions plant the awkward
cases: unknown flags and dates, repeated requests and statuses, one member with a third
of all invoices, payments posted before the charge, exclusions that are deleted or
malformed, and so on.

Notation: ``{orders}`` is a test table, ``{ts}'...'`` a zone-less time, ``[a b]`` a quoted
name. Parties: customers have even ids, suppliers odd ones. Roles: customers end in 1
(modulo 4), suppliers in 2 and a second role in 3.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.fixed_values import EXCLUSION_REPORTS, MEMBER_COUNT_EXCLUSION
from tallyhouse.sinks.stages import StageArea
from tallyhouse.sources.schemas import canonical
from tallyhouse.sources.tables import TableSet

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# A third of the orders belong to customer 0.
_BUYER = "case when o_custkey % 3 = 0 then 0 else o_custkey end"

_LINE = """
    select l_orderkey, l_linenumber, min(l_partkey) as item_id, min(l_shipdate) as shipped_at,
           cast(sum(cast(l_extendedprice as decimal(19,4))) as decimal(19,4)) as amount,
           case when (l_orderkey * 7 + l_linenumber) % 53 = 0 then null
                when (l_orderkey + l_linenumber) % 29 = 0 then 1 else 0 end as credit
    from {lineitem} group by l_orderkey, l_linenumber
"""

_ORDER_PAYMENT = """
    select o_orderkey, o_orderkey % 10 as digit,
           case when o_orderkey % 43 = 0 then null else o_orderkey end as invoice_id,
           case when o_orderkey % 37 = 0 then null else 1 end as line_no,
           case when o_orderkey % 11 = 0 then 1 else 30 end as place,
           cast(sum(case when credit = 1 then -amount else amount end) as decimal(19,4)) as owed,
           max(shipped_at) + (o_orderkey % 60) * interval '1' day as paid_at
    from line join {orders} on l_orderkey = o_orderkey
    where o_orderstatus = 'F' group by o_orderkey
"""

_EFT = """
    select {payment} as TxPaymentId, 'T' || cast(o_orderkey as string) as Token,
           'x' || cast(o_orderkey % 10000 as string) as Mask, cast(1 + o_orderkey % 12 as string) || '/20' as ExpirationDate,
           'MC' || cast(o_orderkey % 25 as string) as MerchantCode,
           case o_orderkey % 5 when 0 then 'A01' when 1 then 'a02' when 2 then 'D05' when 3 then null else 'A11' end as ResponseCode,
           case when o_orderkey % 5 = 3 then null else 'answer ' || cast(o_orderkey % 5 as string) end as ResponseMessage
    from {orders} where {when}
"""

_EMAIL = """
    select {k} as EmailContactMechanismID, c_custkey * 2 as PartyID, 'm' || cast({k} as string) || '@mail' as EmailAddress,
           case when c_custkey % 9 = {j} then 1 else 0 end as InValid,
           {ts}'1999-06-01 00:00:00' + (c_custkey % 400) * interval '1' day as ValidFrom,
           case when c_custkey % 4 = {j} then {ts}'2000-03-01 00:00:00' + (c_custkey % 900) * interval '1' day end as ValidThru,
           1 + (c_custkey + {j}) % 5 % 2 as EmailContactMechanismTypeID
    from {customer}
"""

_PHONE = """
    select c_custkey * 8 + {j} as PhoneContactMechanismID, c_custkey * 2 as PartyID,
           case when c_custkey % 31 = {j} then null else 'p' || cast(c_custkey * 8 + {j} as string) end as PhoneNumber,
           case when c_custkey % 10 = {j} then 1 else 0 end as InValid,
           {ts}'1999-06-01 00:00:00' + ((c_custkey + {j}) % 500) * interval '1' day as ValidFrom,
           case when c_custkey % 3 = {j} % 3 then {ts}'2000-05-01 00:00:00' + (c_custkey % 800) * interval '1' day end as ValidThru,
           1 + (c_custkey * 3 + {j}) % 3 as PhoneContactMechanismTypeID
    from {customer} where c_custkey % 5 >= {j}
"""

_POSTAL = """
    select c_custkey * 4 + {j} as PostalContactMechanismID, c_custkey * 2 as PartyID,
           cast(c_custkey as string) || ' Main St' as AddressData1, case when c_custkey % 2 = {j} then 'Apt ' || cast({j} as string) end as AddressData2,
           cast(null as string) as AddressData3, 'City ' || cast(c_custkey % 12 as string) as CityCounty, 'US' as CountryCode,
           c_custkey % 6 as StateProvince, cast(10000 + c_custkey % 900 as string) as PostalCode,
           case when c_custkey % 8 = {j} then 1 else 0 end as InValid,
           {ts}'1999-01-01 00:00:00' + (c_custkey % 700) * interval '1' day as ValidFrom,
           case when c_custkey % 6 = {j} then {ts}'2000-02-01 00:00:00' + (c_custkey % 900) * interval '1' day end as ValidThru,
           1 + (c_custkey + {j}) % 7 % 2 as PostalContactMechanismTypeID
    from {customer} where c_custkey % 3 >= {j}
"""


def _repeat(template: str, count: int, **more: str) -> str:
    """The template once for each j below count."""
    copies = []
    for j in range(count):
        text = template.replace("{j}", str(j))
        for key, value in more.items():
            text = text.replace("{" + key + "}", value.replace("{j}", str(j)))
        copies.append(text)
    return " union all ".join(copies)


def _exclusions() -> str:
    rows = [
        (EXCLUSION_REPORTS["pos", "tsi"], 0, "TenderTypeID", "2"), (EXCLUSION_REPORTS["pos", "tsi"], 0, "TenderTypeID", "2"),
        (EXCLUSION_REPORTS["pos", "tsi"], 1, "TenderTypeID", "3"), (EXCLUSION_REPORTS["pos", "tsi"], 0, "TenderTypeID", "cash"),
        (EXCLUSION_REPORTS["pos", "tsi"], 0, "BundleID", "4"), (EXCLUSION_REPORTS["pos", "bfx"], 0, "TenderTypeID", "5"),
        (EXCLUSION_REPORTS["batch", "tsi"], 0, "TenderTypeID", "4"), (EXCLUSION_REPORTS["batch", "bfx"], 0, "TenderTypeID", "1"),
        (EXCLUSION_REPORTS["batch", "bfx"], 1, "TenderTypeID", "6"),
        (MEMBER_COUNT_EXCLUSION, 0, "BundleID", "15"), (MEMBER_COUNT_EXCLUSION, 0, "BundleID", "x1"),
        (MEMBER_COUNT_EXCLUSION, 0, "AgreementID", "9"), (MEMBER_COUNT_EXCLUSION, 1, "AgreementID", "11"),
        (MEMBER_COUNT_EXCLUSION, 0, "BusinessUnitID", "3"),
    ]
    values = ", ".join(f"({i}, '{r}', {d}, '{c}', '{v}')" for i, (r, d, c, v) in enumerate(rows, 1))
    return f"select * from (values {values}) as t(ExclusionID, ReportName, Deleted, Criteria, Value)"


ADAPTER = {
    # ledger
    "TxTransaction": f"""
        with line as ({_LINE}), order_payment as ({_ORDER_PAYMENT})
        select l_orderkey * 32 + l_linenumber * 4 as TxTransactionID, l_orderkey as TxInvoiceId, l_linenumber as GroupId,
               item_id as ItemId, 1 as TxTypeID, amount as Amount, credit as IsAccountingCredit,
               case when (l_orderkey + l_linenumber) % 211 = 0 then null else shipped_at end as TargetDate,
               'Charge' as Description, l_orderkey * 2 as WorkUnitId
        from line
        union all
        select l_orderkey * 32 + l_linenumber * 4 + case when l_linenumber % 3 = 0 then -1 else 1 end, l_orderkey, l_linenumber,
               o_orderkey * 2 + 1, 4,
               cast(case when credit = 1 then -amount else amount end - case when (l_orderkey + l_linenumber) % 3 = 0 then 10 else 0 end as decimal(19,4)),
               1, shipped_at + (l_orderkey % 90) * interval '1' day, 'Payment', l_orderkey * 2
        from line join {{orders}} on l_orderkey = o_orderkey where o_orderstatus = 'P'
        union all
        select o_orderkey * 32 + place, invoice_id, line_no, o_orderkey * 2 + 1, 4,
               cast(owed - case when o_orderkey % 4 = 0 then 25 else 0 end as decimal(19,4)), 1, paid_at, 'Payment', o_orderkey * 2
        from order_payment
        union all
        select o_orderkey * 32 + 31, invoice_id, line_no, o_orderkey * 2 + 1, 4,
               cast(owed - case when o_orderkey % 4 = 0 then 25 else 0 end as decimal(19,4)), 1, paid_at, 'Payment', o_orderkey * 2
        from order_payment where digit = 3""",
    "TxInvoice": f"""
        select o_orderkey as TxInvoiceID, ({_BUYER}) * 4 + 1 as PartyRoleId, o_orderkey % 26 as TargetBusinessUnitId,
               case when o_orderkey % 101 = 0 then null else o_orderdate end as TargetDate,
               o_orderdate + interval '30' day as PaymentDueDate, ({_BUYER}) * 3 as ClientAccountId,
               o_orderkey % 3 as TxInvoiceStatusId, o_orderkey % 4 as BillingStatus,
               case when o_orderkey % 13 = 0 then null else o_orderkey * 2 end as WorkUnitId
        from {{orders}}""",
    "TxPayment": f"""
        select o_orderkey * 2 + 1 as TxPaymentID, o_orderkey * 2 + 1 as TxPaymentGroupId, ({_BUYER}) * 4 + 1 as PartyRoleId,
               o_orderkey as LinkId, 1 as LinkTypeID,
               case when o_orderkey % 17 = 0 then null else 'R' || cast(o_orderkey as string) end as Reference,
               o_orderdate + case when o_orderkey % 8 = 0 then 86399 else 0 end * interval '1' second as TargetDate,
               cast(o_totalprice as decimal(19,4)) as Amount,
               case when o_orderkey % 83 = 0 then null else 1 + o_orderkey % 6 end as TenderTypeID,
               case when o_orderkey % 89 = 0 then 99 else o_orderkey % 25 end as TargetBusinessUnitId,
               case when o_orderkey % 4 = 3 then null else 1 + o_orderkey % 3 end as CreditCardTypeId,
               case when o_orderkey % 7 = 0 then 1 else 0 end as IsDeclined
        from {{orders}} where o_orderstatus in ('F', 'P')
        union all
        select o_orderkey * 2, o_orderkey * 2 + 1, o_custkey * 4 + 1, o_orderkey, 2, 'X' || cast(o_orderkey as string),
               o_orderdate + interval '1' day, cast(o_totalprice as decimal(19,4)), 1 + o_orderkey % 5, o_orderkey % 25,
               1 + (o_orderkey + 1) % 3, 0
        from {{orders}} where o_orderstatus in ('F', 'P') and o_orderkey % 6 = 0""",
    "TxPaymentEft": _repeat(_EFT, 1, payment="o_orderkey * 2 + 1", when="o_orderkey % 3 <> 2")
    + " union all " + _repeat(_EFT, 1, payment="o_orderkey * 2 + 1", when="o_orderkey % 40 = 0")
    + " union all " + _repeat(_EFT, 1, payment="o_orderkey * 2", when="o_orderkey % 6 = 0"),
    "PaymentProcessRequest": """
        select o_orderkey * 3 as PaymentProcessRequestId, o_orderkey * 2 + 1 as TxPaymentID, o_orderkey % 50 as PaymentProcessBatchId
        from {orders} where o_orderstatus = 'F'
        union all
        select o_orderkey * 3 + 1, o_orderkey * 2 + 1, 50 + o_orderkey % 50 from {orders}
        where o_orderstatus = 'F' and o_orderkey % 15 = 0""",
    "PaymentProcessResponse": """
        select o_orderkey * 3 as PaymentProcessRequestId, 'REF' || cast(o_orderkey as string) as ReferenceId,
               case o_orderkey % 4 when 0 then 'A01' when 1 then 'a02' when 2 then 'D05' else null end as ResponseCode,
               'batch answer' as ResponseMessage
        from {orders} where o_orderstatus = 'F' and o_orderkey % 21 <> 0
        union all
        select o_orderkey * 3, 'AGAIN' || cast(o_orderkey as string), 'A77', 'second answer'
        from {orders} where o_orderstatus = 'F' and o_orderkey % 10 = 0
        union all
        select o_orderkey * 3 + 1, 'RETRY' || cast(o_orderkey as string), 'D01', 'answer to the second request'
        from {orders} where o_orderstatus = 'F' and o_orderkey % 15 = 0""",
    # people and accounts
    "PartyRole": """
        select c_custkey * 4 + 1 as PartyRoleID, c_custkey * 2 as PartyID,
               case when c_custkey % 97 = 5 then null else 'M' || cast(c_custkey as string) end as RoleID, 1 as PartyRoleTypeID,
               case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then (c_custkey % 10) * 4 + 2 else (c_custkey - 1) * 4 + 1 end as ReferredByPartyRoleID
        from {customer}
        union all
        select s_suppkey * 4 + 2, s_suppkey * 2 + 1, 'E' || cast(s_suppkey as string), case when s_suppkey % 2 = 0 then 7 else 2 end, cast(null as bigint)
        from {supplier}
        union all
        select s_suppkey * 4 + 3, s_suppkey * 2 + 1, 'F' || cast(s_suppkey as string), case when s_suppkey % 2 = 0 then 7 else 2 end, cast(null as bigint)
        from {supplier} where s_suppkey % 5 = 0""",
    "PartyRoleStatus": """
        select c_custkey * 4 + 1 as PartyRoleId, c_custkey % 5 as Status from {customer} where c_custkey % 11 <> 4
        union all
        select c_custkey * 4 + 1, case when c_custkey % 25 = 0 then c_custkey % 5 else (c_custkey + 1) % 5 end from {customer} where c_custkey % 5 = 0""",
    "ClientAccount": """
        select c_custkey * 3 as ClientAccountId, case when c_custkey % 10 = 3 then 1 else 0 end as IsExternal from {customer}""",
    "ClientAccountParty": """
        select c_custkey * 3 as ClientAccountId,
               case when c_custkey % 4 = 1 then (c_custkey % 5) * 4 + 1 else c_custkey * 2 end as PartyId, 1 as PrimaryParty
        from {customer}
        union all
        select c_custkey * 3, (c_custkey % 5) * 4 + 1, case when c_custkey % 35 = 0 then 1 else 0 end from {customer} where c_custkey % 7 = 0""",
    "PartyPropertiesReporting": """
        select c_custkey * 2 as PartyId, case when c_custkey % 41 = 0 then null else 'First' || cast(c_custkey % 300 as string) end as [3],
               c_name as [5], cast(null as string) as [31]
        from {customer}
        union all
        select s_suppkey * 2 + 1, 'Rep' || cast(s_suppkey as string), s_name, case when s_suppkey % 8 = 6 then null else 'Org ' || s_name end from {supplier}""",
    "PartyPropertiesReportingView": """
        select c_custkey * 2 as PartyID, 'First' || cast(c_custkey as string) as [First Name], c_name as [Last Name]
        from {customer} where c_custkey % 43 <> 7""",
    "ReportingEmployeeCharacteristics": """
        select s_suppkey * 2 + 1 as PartyId, case when s_suppkey % 9 = 4 then null else 'Staff' || cast(s_suppkey as string) end as [First Name],
               s_name as [Last Name], 'PAY' || cast(s_suppkey as string) as [Payroll ID]
        from {supplier} where s_suppkey % 11 <> 3""",
    "ReportingMemberCharacteristics": """
        select c_custkey * 2 as PartyID, 'Mem' || cast(c_custkey as string) as [First Name], c_name as [Last Name] from {customer}
        union all
        select s_suppkey * 2 + 1, 'AlsoMember', s_name from {supplier} where s_suppkey % 2 = 0""",
    "EmployeeWorkRole": """
        select s_suppkey * 2 + 1 as PartyId, 1 as WorkRoleSourceId, 1 as WorkRoleSourceLevel, 1 + s_suppkey % 6 as WorkRoleID
        from {supplier} where s_suppkey % 13 <> 1
        union all
        select s_suppkey * 2 + 1, s_suppkey % 5, case when s_suppkey % 7 = 0 then 3 else 2 end, 1 + (s_suppkey + 1) % 5 from {supplier} where s_suppkey % 2 = 0
        union all
        select s_suppkey * 2 + 1, s_suppkey % 25, 3, 1 + (s_suppkey + 2) % 5 from {supplier} where s_suppkey % 3 = 0""",
    "WorkRole": "select * from (values (1, 'Manager'), (2, 'Sales'), (3, 'Trainer'), (4, 'Front Desk'), (5, 'Regional')) as t(WorkRoleID, Name)",
    "WorkUnit": """
        select o_orderkey * 2 as WorkUnitID, case when o_orderkey % 4 = 0 then 500 else 100 + o_custkey % 12 end as UserId,
               case when o_orderkey % 19 = 0 then null else 100 + o_orderkey % 10 end as AuthenticatedUserId
        from {orders} where o_orderkey % 9 <> 5""",
    "UserAccount": """
        select 100 + s_suppkey as UserAccountId, s_suppkey * 2 + 1 as PartyID, 'user' || cast(s_suppkey as string) as Username from {supplier}""",
    "CheckIn": """
        select event_id as CheckInID, user_id * 2 as PartyId, case when event_id % 30 = 29 then 99 else event_id % 25 end as BusinessUnitId,
               ts as CheckInDateTime
        from {events}""",
    "EmailContactMechanism": _repeat(_EMAIL, 2, k="(c_custkey * 2 + {j})"),
    "PhoneContactMechanism": _repeat(_PHONE, 5),
    "PostalContactMechanism": _repeat(_POSTAL, 3),
    # agreements
    "MemberAgreement": """
        select c_custkey * 2 as MemberAgreementId, c_custkey * 4 + 1 as PartyRoleId, case when c_custkey % 3 = 0 then 7 else c_custkey end as AgreementId,
               case when c_custkey % 90 = 17 then 99 else c_custkey % 25 end as BusinessUnitId,
               case when c_custkey % 61 = 0 then null else c_custkey % 7 end as Status,
               {ts}'1996-01-01 00:00:00' + (c_custkey % 1500) * interval '1' day as StartDate,
               case when c_custkey % 3 = 1 then {ts}'1997-01-01 00:00:00' + (c_custkey % 1500) * interval '1' day end as EndDate,
               {ts}'1996-07-01 00:00:00' + (c_custkey % 1500) * interval '1' day as ObligationDate
        from {customer}
        union all
        select c_custkey * 2 + 1, c_custkey * 4 + 1, c_custkey + 1, c_custkey % 25, (c_custkey + 3) % 7,
               {ts}'1998-01-01 00:00:00' + (c_custkey % 900) * interval '1' day, null, null
        from {customer} where c_custkey % 2 = 0""",
    "MemberAgreementGroupRole": """
        select MemberAgreementId, (MemberAgreementId - MemberAgreementId % 3) as MemberAgreementGroupId,
               case when MemberAgreementId % 59 = 0 then 9
                    when MemberAgreementId % 3 = 0 then case when MemberAgreementId % 4 = 3 then 3 else 1 end
                    when MemberAgreementId % 3 = 1 then 2 else case when MemberAgreementId % 5 = 0 then 3 else 4 end end as RoleType
        from (select c_custkey * 2 as MemberAgreementId from {customer} union all
              select c_custkey * 2 + 1 from {customer} where c_custkey % 2 = 0) as a
        where MemberAgreementId % 23 <> 4""",
    "MemberAgreementItem": """
        select id * 3 as MemberAgreementItemId, id as MemberAgreementId, id % 190 as BundleId, 1 as IsKeyItem
        from (select c_custkey * 2 as id from {customer} union all select c_custkey * 2 + 1 from {customer} where c_custkey % 2 = 0) as a
        union all
        select c_custkey * 6 + 1, c_custkey * 2, case when c_custkey % 14 = 0 then (c_custkey * 2) % 190 else c_custkey % 190 end, 1
        from {customer} where c_custkey % 7 = 0
        union all
        select c_custkey * 6 + 2, c_custkey * 2, c_custkey % 190, 0 from {customer} where c_custkey % 5 = 0""",
    "MemberAgreementItemPerpetual": """
        select c_custkey * 6 as MemberAgreementItemId, case when c_custkey % 11 = 0 then null else 1 + c_custkey % 2 end as Sequence,
               cast(19.995 + c_custkey % 50 as decimal(19,4)) as Price
        from {customer} where c_custkey % 10 <> 9
        union all
        select c_custkey * 6, 2, cast(29.1249 + c_custkey % 40 as decimal(19,4)) from {customer} where c_custkey % 4 = 0
        union all
        select c_custkey * 6 + 1, 1, cast(9.5 as decimal(19,4)) from {customer} where c_custkey % 7 = 0""",
    "MemberAgreementInvoiceRequest": f"""
        select o_orderkey * 2 as MemberAgreementInvoiceRequestId, ({_BUYER}) * 2 as MemberAgreementId,
               case when o_orderkey % 23 = 0 then null else o_orderkey end as TxInvoiceId, o_orderkey % 3 as Status,
               o_orderdate as BillDate, case when o_orderkey % 4 = 0 then null else o_orderkey % 3 end as ProcessType
        from {{orders}} where o_orderkey % 16 <> 11
        union all
        select o_orderkey * 2 + 1, case when o_orderkey % 21 = 0 then o_custkey * 2 + 1 else ({_BUYER}) * 2 end, o_orderkey, 2,
               o_orderdate + interval '3' day, 0
        from {{orders}} where o_orderkey % 7 = 0""",
    "MemberAgreementInvoiceRequestItem": f"""
        select ({_BUYER}) * 6 as MemberAgreementItemId, o_orderkey * 2 as MemberAgreementInvoiceRequestId from {{orders}}
        union all
        select o_custkey * 6, o_orderkey * 2 + 1 from {{orders}} where o_orderkey % 7 = 0
        union all
        select o_custkey * 6 + 2, o_orderkey * 2 from {{orders}} where o_orderkey % 10 = 0""",
    "MemberAgreementSalesAdviser": """
        select c_custkey * 2 as MemberAgreementId, (c_custkey % 8) * 4 + 2 as PartyRoleId, 1 as Sequence from {customer} where c_custkey % 6 <> 5
        union all
        select c_custkey * 2, (c_custkey % 9) * 4 + 2, 2 from {customer} where c_custkey % 2 = 0
        union all
        select c_custkey * 2, (c_custkey % 5) * 4 + 2, 1 from {customer} where c_custkey % 11 = 0""",
    "Agreement": """
        select p_partkey as AgreementID, 'Plan ' || p_name as Name, case when p_partkey % 29 = 3 then null when p_partkey % 5 = 3 then 2 when p_partkey % 5 = 4 then 3 else 1 end as AgreementTypeID,
               case when p_partkey % 4 = 2 then 2 when p_partkey % 4 = 0 then 1 else 3 end as AgreementClassificationID
        from {part}""",
    "Bundle": """
        select p_partkey as BundleID, 'B' || cast(p_partkey as string) as Code,
               case when p_partkey % 19 = 8 then null when p_partkey % 9 = 2 then 'TRIAL ' || p_name when p_partkey % 13 = 5 then 'Guest pass'
                    when p_partkey % 17 = 6 then 'one day Tryout' else p_name end as Name
        from {part}""",
    "Cancellation": """
        select c_custkey * 8 as CancellationID, c_custkey * 2 as EntityId, 1 as EntityIdType, 4 as StateId,
               {ts}'1998-01-01 00:00:00' + (c_custkey % 800) * interval '1' day as [Date]
        from {customer} where c_custkey % 2 = 0
        union all
        select c_custkey * 8 + 1, c_custkey * 2, 1, case c_custkey % 5 when 0 then 6 when 1 then 8 when 2 then 1 when 3 then null else 2 end,
               {ts}'1999-01-01 00:00:00' + (c_custkey % 1200) * interval '1' day
        from {customer} where c_custkey % 3 = 0
        union all
        select c_custkey * 8 + 2, c_custkey * 2, 1, 4, case when c_custkey % 12 = 0 then null else {ts}'1999-06-01 00:00:00' end
        from {customer} where c_custkey % 6 = 0
        union all
        select c_custkey * 8 + 3, c_custkey * 2 + 1, 2, 4, {ts}'1999-07-01 00:00:00' from {customer} where c_custkey % 4 = 0""",
    "StatusMap": """
        select * from (values (5, 0, 'Draft'), (5, 1, 'Pending'), (5, 2, 'Active'), (5, 3, 'Frozen'), (5, 4, 'Cancelled'), (5, 6, 'Expired'),
                              (1, 0, 'Lead'), (1, 1, 'Current'), (1, 2, 'Former'), (1, 3, 'Current'), (7, 2, 'Other'))
        as t(StatusMapType, StatusId, Name)""",
    # places, items and codes
    "BusinessUnit": """
        select n_nationkey as BusinessUnitId, n_name as Name, 'C' || cast(n_nationkey as string) as Code,
               case when n_nationkey = 24 then null else 'GL' || cast(n_nationkey as string) end as GLCodePrefix,
               n_regionkey as DivisionId, 'POSM' || cast(n_nationkey as string) as POSMerchantAccountCode
        from {nation}""",
    "Division": "select r_regionkey as DivisionID, r_name as Name from {region}",
    "Item": """
        select p_partkey as ItemID, 'I' || cast(p_partkey as string) as ItemRecordID,
               case when p_partkey % 6 = 0 then p_name || chr(13) || chr(10) || 'second line' when p_partkey % 6 = 1 then chr(9) || p_name else p_name end as Description,
               1 + p_partkey % 7 as GLCodeDeferred, case when p_partkey % 5 = 0 then null else 1 + p_partkey % 5 end as GLCodePOS, 1 + p_partkey % 3 as GLCodeRecurring
        from {part} where p_partkey % 37 <> 2""",
    "rpt_ItemBasic": """
        select p_partkey as ItemID, case when p_partkey % 4 = 0 then null else 'RP' || cast(p_partkey % 9 as string) end as POSGLCode,
               case when p_partkey % 7 = 0 then null else 'RR' || cast(p_partkey % 9 as string) end as RecurringGLCode,
               p_type as Category, p_brand as SubCategory
        from {part} where p_partkey % 31 <> 4""",
    "GeneralLedgerCode": """
        select * from (values (1, '4000', 'Dues'), (2, '4100', 'Retail'), (3, '4200', 'Training'), (4, '1000', 'Cash'), (5, '1010', 'Card'), (6, '1020', 'Check'))
        as t(GeneralLedgerCodeId, Code, Description)""",
    "TenderType": """
        select * from (values (1, 'Cash', 4), (2, 'Visa', 5), (3, 'Amex', 5), (4, 'Check', 6), (5, 'Gift', 9), (6, 'EFT', cast(null as int)))
        as t(TenderTypeID, Name, GeneralLedgerCodeId)""",
    "CreditCardType": "select * from (values (1, 'Visa', 'VS'), (2, 'Mastercard', 'MC')) as t(CreditCardTypeID, Description, Abbreviation)",
    "StateProvince": "select * from (values (0, 'New York'), (1, 'New Jersey'), (2, 'Ontario'), (3, 'Maine')) as t(StateProvinceID, Name)",
    "Staging_ReportExclusionStaging": _exclusions(),
    "Ref_TSI_MIDs_Reference": """
        select 'GL' || cast(n_nationkey as string) as OrgID, cast(1000 + n_nationkey as string) as [VS/MC MOTO], cast(2000 + n_nationkey as string) as [VS/MC RETAIL],
               cast(3000 + n_nationkey as string) as [AMEX MOTO], cast(4000 + n_nationkey as string) as [AMEX RETAIL],
               cast(5000 + n_nationkey as string) as [NEW MOTO SE#], cast(6000 + n_nationkey as string) as [NEW RETAIL SE#]
        from {nation} where n_nationkey % 5 <> 4""",
    # endpoints
    "Endpoint": """
        select s_suppkey as EndpointID, case when s_suppkey % 33 = 32 then 99 else s_nationkey end as BusinessUnitID, s_name as EndpointName,
               s_suppkey % 3 as EndpointKind
        from {supplier}""",
    "EndpointSecurity": """
        select s_suppkey as EndpointID, 1 + s_suppkey % 5 as WorkRoleID from {supplier}
        union all
        select s_suppkey, 1 + (s_suppkey + 2) % 6 from {supplier} where s_suppkey % 2 = 0""",
    "EndpointAccessType": "select case when l_suppkey % 10 = 7 then null else l_suppkey end as EndpointId, l_linenumber as AccessType from {lineitem}",
}

# Tables large enough to keep as files, as they would be in a real source.
_KEPT = frozenset(name for name, sql in ADAPTER.items()
                  if any("{" + big + "}" in sql for big in ("lineitem", "orders", "customer", "events")))

# The ledger in one pass over the lines for Spark, with the rows of its SELECT: lines are dealt out by order once, each order's
# totals are taken where its lines are, and every line says by ``kind`` which entries it makes. 0 is the charge, 1 a payment of
# the line, and an order's first line makes its payments, 2 and 3. Nothing is summed up before it is dealt out: lines
# hardly repeat, so that a hash table of them would only fill the memory.
_LEDGER = f"""
    with dealt as (
        select /*+ REPARTITION(l_orderkey) */ l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice from {{lineitem}}),
    line as ({_LINE.replace("{lineitem}", "dealt")}),
    placed as (
        select *, row_number() over (partition by l_orderkey order by l_linenumber) = 1 as leads,
               sum(case when credit = 1 then -amount else amount end) over (partition by l_orderkey) as owed_once,
               max(shipped_at) over (partition by l_orderkey) as last_shipped
        from line),
    states as (
        select o_orderkey, count_if(o_orderstatus = 'P') as part_paid, count_if(o_orderstatus = 'F') as paid
        from (select /*+ REPARTITION(o_orderkey) */ o_orderkey, o_orderstatus from {{orders}}) group by o_orderkey),
    entry as (
        select *, cast(owed_once * cast(paid as decimal(9,0)) as decimal(19,4)) as owed,
               last_shipped + (l_orderkey % 60) * interval '1' day as paid_at,
               explode(concat(array(0), array_repeat(1, cast(coalesce(part_paid, 0) as int)),
                              case when leads and paid > 0 and l_orderkey % 10 = 3 then array(2, 3) when leads and paid > 0 then array(2)
                                   else array() end)) as kind
        from placed left join states on l_orderkey = o_orderkey)
    select l_orderkey * 32 + case kind when 0 then l_linenumber * 4 when 1 then l_linenumber * 4 + case when l_linenumber % 3 = 0 then -1 else 1 end
               when 2 then case when l_orderkey % 11 = 0 then 1 else 30 end else 31 end as TxTransactionID,
           case when kind >= 2 and l_orderkey % 43 = 0 then null else l_orderkey end as TxInvoiceId,
           case when kind < 2 then l_linenumber when l_orderkey % 37 = 0 then null else 1 end as GroupId,
           case when kind = 0 then item_id else l_orderkey * 2 + 1 end as ItemId, if(kind = 0, 1, 4) as TxTypeID,
           case kind when 0 then amount
               when 1 then cast(case when credit = 1 then -amount else amount end - case when (l_orderkey + l_linenumber) % 3 = 0 then 10 else 0 end as decimal(19,4))
               else cast(owed - case when l_orderkey % 4 = 0 then 25 else 0 end as decimal(19,4)) end as Amount,
           if(kind = 0, credit, 1) as IsAccountingCredit,
           case kind when 0 then case when (l_orderkey + l_linenumber) % 211 = 0 then null else shipped_at end
               when 1 then shipped_at + (l_orderkey % 90) * interval '1' day else paid_at end as TargetDate,
           if(kind = 0, 'Charge', 'Payment') as Description, l_orderkey * 2 as WorkUnitId
    from entry
"""

_QUOTED = re.compile(r"\[([^\]]+)\]")


def spark_select(name: str) -> str:
    return _QUOTED.sub(r"`\1`", {**ADAPTER, "TxTransaction": _LEDGER}[name]).replace("{ts}", "timestamp_ntz ")


def duckdb_select(name: str) -> str:
    text = _QUOTED.sub(r'"\1"', ADAPTER[name]).replace("{ts}", "timestamp ")
    for source in SOURCES:
        text = text.replace("{" + source + "}", source)
    return text


def duckdb_with(names: list[str]) -> str:
    """The named tables as common table expressions."""
    return "with " + ",\n".join(f"{name} as materialized ({duckdb_select(name)})" for name in names)


_PREPARED: dict[tuple[str, str], TableSet] = {}


def billing_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    """Billing tables over one folder of test tables, each built on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PREPARED:
        area = StageArea(spark)
        sources = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in SOURCES}

        def build(name: str) -> DataFrame:
            frame = spark.sql(spark_select(canonical(name)), **sources)
            return area.keep(frame, name) if name in _KEPT else frame

        _PREPARED[key] = TableSet(build)
    return _PREPARED[key]
