"""Net member count on hand-built rows."""

from datetime import datetime
from decimal import Decimal

from tallyhouse.plans.net_members import member_count_schema, net_member_count

NOW = datetime(2024, 6, 1)


def staff(n):
    return {
        "EmployeeCharacteristics": {"PartyId": n, "First Name": f"F{n}", "Last Name": f"L{n}", "Payroll ID": f"P{n}"},
        "PartyRole": {"PartyRoleID": n * 10, "PartyID": n, "RoleID": f"E{n}"},
        "UserAccount": {"UserAccountId": n + 100, "PartyID": n, "Username": f"u{n}"},
    }


def build(billing, **more):
    people = [staff(n) for n in (1, 2, 3)]
    tables = {
        "MemberAgreement": [{"MemberAgreementId": i, "PartyRoleId": 500, "AgreementId": 4, "BusinessUnitId": 2, "Status": 1}
                            for i in (1, 2)],
        "Agreement": [{"AgreementID": 4, "Name": "Gold", "AgreementClassificationID": 1},
                      {"AgreementID": 5, "Name": "Day", "AgreementClassificationID": 2}],
        "MemberAgreementItem": [{"MemberAgreementItemId": i * 10, "MemberAgreementId": i, "BundleId": 8, "IsKeyItem": 1}
                                for i in (1, 2)],
        "Bundle": [{"BundleID": 8, "Code": "B8", "Name": "Full"}, {"BundleID": 9, "Code": "B9", "Name": "One TRIAL"}],
        "BusinessUnit": [{"BusinessUnitId": 2, "Name": "Unit"}],
        "PartyRole": [p["PartyRole"] for p in people] + [
            {"PartyRoleID": 500, "PartyID": 50, "RoleID": "M5", "ReferredByPartyRoleID": 30}],
        "ReportingEmployeeCharacteristics": [p["EmployeeCharacteristics"] for p in people],
        "UserAccount": [p["UserAccount"] for p in people],
        "TxInvoice": [{"TxInvoiceID": 70, "WorkUnitId": 700}],
        "WorkUnit": [{"WorkUnitID": 700, "UserId": 101, "AuthenticatedUserId": 102}],
        "MemberAgreementInvoiceRequest": [
            {"MemberAgreementInvoiceRequestId": 1, "MemberAgreementId": 1, "TxInvoiceId": 70, "Status": 2}],
        "MemberAgreementSalesAdviser": [{"MemberAgreementId": 1, "PartyRoleId": 20, "Sequence": 1},
                                        {"MemberAgreementId": 1, "PartyRoleId": 999, "Sequence": 1},
                                        {"MemberAgreementId": 1, "PartyRoleId": 30, "Sequence": 2}],
        "WorkRole": [{"WorkRoleID": i, "Name": f"role {i}"} for i in (1, 2, 3)],
        "EmployeeWorkRole": [{"PartyId": p, "WorkRoleSourceLevel": lv, "WorkRoleID": r}
                             for p, lv, r in ((1, 1, 1), (1, 3, 2), (1, None, 3), (2, 2, 3), (3, 2, 1), (3, 2, 3))],
    }
    tables.update(more)
    return billing(**tables)


def by_agreement(frame):
    return {r.MemberAgreementId: r for r in frame.collect()}


def test_people_behind_an_agreement(billing):
    frame = net_member_count(build(billing), now=NOW)
    assert frame.schema == member_count_schema()
    rows = by_agreement(frame)
    one, two = rows[1], rows[2]
    assert (one.SALES_USERNAME, one.SALES_ROLEID, one.SALES_PAYROLLID, one.SALES_WORKROLE) == ("u1", "E1", "P1", "role 2")
    assert (one.PIN_FIRSTNAME, one.PIN_RoleID) == ("F2", "E2")
    # An adviser who is not an employee does not count, nor does a later sequence.
    assert (one.ADVISOR_FIRSTNAME, one.ADVISOR_ROLEID) == ("F2", "E2")
    # Equal levels: the highest role id.
    assert (one.REFERRAL_PARTYID1, one.REFERRAL_FIRSTNAME1, one.REFERRAL_WORKROLE) == (3, "F3", "role 3")
    # The salesperson advises nobody, so the adviser's role stays unknown ...
    assert one.ADVISOR_WORKROLE is None
    assert (two.SALES_USERNAME, two.PIN_RoleID, two.ADVISOR_ROLEID, two.FIRSTINVOICEDATE) == (None, None, None, None)
    # ... unless it is looked up by the adviser.
    fixed = by_agreement(net_member_count(build(billing), now=NOW, fix_advisor_role=True))
    assert fixed[1].ADVISOR_WORKROLE == "role 3"


def test_what_is_counted(billing):
    def agreement(key, **more):
        return {"MemberAgreementId": key, "PartyRoleId": 500, "AgreementId": 4, "BusinessUnitId": 2, "Status": 1, **more}

    def item(key, agreement_id, bundle, is_key=1):
        return {"MemberAgreementItemId": key, "MemberAgreementId": agreement_id, "BundleId": bundle, "IsKeyItem": is_key}

    listed = [("BundleID", "11", 0), ("BundleID", "12", 1), ("BusinessUnitID", "3", 0), ("AgreementID", "6", 0), ("BundleID", "x", 0)]
    tables = build(
        billing,
        MemberAgreement=[agreement(1), agreement(2, Status=6), agreement(3, Status=None), agreement(4, AgreementId=5),
                         agreement(5, BusinessUnitId=3), agreement(6, AgreementId=6), agreement(7, BusinessUnitId=None),
                         agreement(8), agreement(9), agreement(10)],
        Agreement=[{"AgreementID": 4, "AgreementClassificationID": 1}, {"AgreementID": 5, "AgreementClassificationID": 2},
                   {"AgreementID": 6, "AgreementClassificationID": 3}],
        MemberAgreementItem=[item(i * 10, i, 8) for i in range(1, 9)]
        + [item(11, 1, 8), item(12, 1, 12), item(13, 1, 11), item(14, 1, 9), item(15, 1, 13), item(81, 8, 12, 0), item(90, 9, 9)],
        Bundle=[{"BundleID": 8, "Name": "Full"}, {"BundleID": 9, "Name": "One TRIAL"}, {"BundleID": 11, "Name": "Listed"},
                {"BundleID": 12, "Name": "Deleted entry"}, {"BundleID": 13, "Name": None}],
        BusinessUnit=[{"BusinessUnitId": i, "Name": "Unit"} for i in (2, 3)],
        Staging_ReportExclusionStaging=[
            {"ExclusionID": i, "ReportName": "NewMemberCount", "Deleted": d, "Criteria": c, "Value": v}
            for i, (c, v, d) in enumerate(listed)])
    rows = net_member_count(tables, now=NOW).collect()
    assert sorted((r.MemberAgreementId, r.BundleId) for r in rows) == [(1, 8), (1, 12), (7, 8), (8, 8)]
    # Case matters only where asked for.
    rows = net_member_count(tables, now=NOW, case_insensitive=False).collect()
    assert sorted((r.MemberAgreementId, r.BundleId) for r in rows if r.BundleId == 9) == [(1, 9), (9, 9)]


def test_dates_and_dues(billing):
    def cancel(key, state, at):
        return {"CancellationID": key, "EntityId": 1, "EntityIdType": 1, "StateId": state, "Date": at}

    def request(key, invoice, day, process=None, agreement=1, status=1):
        return {"MemberAgreementInvoiceRequestId": key, "MemberAgreementId": agreement, "TxInvoiceId": invoice,
                "Status": status, "BillDate": datetime(2024, 1, day), "ProcessType": process}

    tables = build(
        billing,
        Cancellation=[cancel(1, 4, datetime(2024, 1, 1)), cancel(2, 4, datetime(2023, 1, 1)), cancel(3, 1, datetime(2024, 7, 1)),
                      cancel(4, 2, NOW), cancel(5, 6, datetime(2024, 9, 1)), cancel(6, None, datetime(2024, 9, 1))],
        MemberAgreementInvoiceRequest=[request(1, 70, 1, status=2), request(2, 71, 5), request(3, 72, 3, process=1),
                                       request(4, None, 2), request(5, 73, 4, process=0)],
        MemberAgreementInvoiceRequestItem=[{"MemberAgreementItemId": 10, "MemberAgreementInvoiceRequestId": i} for i in range(1, 6)],
        MemberAgreementItemPerpetual=[{"MemberAgreementItemId": 10, "Sequence": 2, "Price": "9"},
                                      {"MemberAgreementItemId": 10, "Sequence": 1, "Price": "19.995"},
                                      {"MemberAgreementItemId": 20, "Sequence": 1, "Price": "5"},
                                      {"MemberAgreementItemId": 20, "Sequence": None, "Price": "7"}])
    rows = by_agreement(net_member_count(tables, now=NOW))
    assert (rows[1].CancelDate, rows[1].FutureCancelDate) == (datetime(2023, 1, 1), NOW)
    assert rows[1].FIRSTINVOICEDATE == datetime(2024, 1, 4)
    assert (rows[1].AGREEMENT_MONTHLYDUES, rows[2].AGREEMENT_MONTHLYDUES) == (Decimal("20.00"), Decimal("7.00"))
