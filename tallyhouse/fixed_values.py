"""Literals that a result must carry, or must match, exactly.

Nothing here is logic. Change a value only if the source system changes it.
"""

# Exclusion-list report names, one per (extract, tenant). Note the singular
# "Transaction" of the batch extract.
EXCLUSION_REPORTS = {
    ("pos", "tsi"): "TSI_Daily_Transactions_POS_Trintech",
    ("pos", "bfx"): "BFX_Daily_Transactions_POS_Trintech",
    ("batch", "tsi"): "TSI_Daily_Transaction_Batch_Trintech",
    ("batch", "bfx"): "BFX_Daily_Transaction_Batch_Trintech",
}
MEMBER_COUNT_EXCLUSION = "NewMemberCount"

# Transaction types.
TX_TYPE_PAYMENT = 4

# Party role types.
ROLE_TYPE_ORGANISATION = 7

# Status map families.
STATUS_ROLE = 1
STATUS_AGREEMENT = 5

# Cancellation entity types and states.
CANCEL_ENTITY_AGREEMENT = 1
CANCEL_STATE_DONE = 4
CANCEL_STATES_VOID = (6, 8)

# Agreement types, classifications and statuses.
AGREEMENT_TYPE_NAMES = {1: "MemberShip", 2: "Service"}
AGREEMENT_TYPE_OTHER = "Invalid"
AGREEMENT_TYPE_MEMBERSHIP = 1
COUNTED_CLASSIFICATIONS = (1, 3)
AGREEMENT_STATUS_EXPIRED = 6

# Agreement group role types.
GROUP_ROLE_NAMES = {1: "Primary", 2: "Add-on", 3: "ReWrite Primary", 4: "ReWrite Add-on"}
GROUP_ROLE_OTHER = "INVALID"
GROUP_ROLES_PRIMARY = (1, 3)
GROUP_ROLES_ADDON = (2, 4)

# Contact kinds.
EMAIL_KIND = 1
PHONE_KINDS = {"home": 1, "work": 2, "mobile": 3}
POSTAL_KIND = 1

# Request states and kinds.
REQUEST_INVOICED = 2
PROCESS_TYPE_SKIPPED = 1

# Bundle names that are not members.
NON_MEMBER_BUNDLES = ("%trial%", "%tryout%", "%guest%")

# Receivable sources.
SOURCE_EXTERNAL = "CN"
SOURCE_INTERNAL = "MoSo"

# Upper ends (inclusive, in days) of the aging buckets and their column names;
# the last name takes everything older.
AGING_EDGES = (30, 60, 90, 120)
AGING_NAMES = ("AgingCurrent", "AR_31_to_60", "AR_61_to_90", "AR_91_to_120", "AR_121_and_Up")

# Daily extracts.
TRANS_CODE = "Payment"
CATEGORY_POS = "POS"
CATEGORY_BATCH = "Batch"
CREDIT_TEXT = ("TRUE", "FALSE")
APPROVED_RESPONSE = "A%"
MERCHANT_ID_COLUMNS = (
    "VS/MC MOTO", "VS/MC RETAIL", "AMEX MOTO", "AMEX RETAIL", "NEW MOTO SE#", "NEW RETAIL SE#",
)

# Output columns, in output order.
AR_COLUMNS = """
Division, Location, LocationGL, MemberID, FirstName, LastName, OrganizationName, Email, MobilePhone,
WorkPhone, HomePhone, Address1, Address2, Address3, City, StateProvince, PostalCode, ClientAccountId,
InvoiceNumber, InvoiceDate, DueDate, InvoiceLineItem, InvoiceMemberAgreementID, InvAgrCancelDate,
StartDate, AgreementType, InvoiceAgreementStatus,
CreditCardDescription, CreditCardAbbreviation, CreditCardMask, ResponseCode, ResponseMessage,
ARSource, ARDays, AgingCurrent, AR_31_to_60, AR_61_to_90, AR_91_to_120, AR_121_and_Up, TotalDue,
ItemCode, ItemDescription, POSGL, rpt_POSGLCode, DeferredGL, RecurringGL, rpt_RecurringGL, Category,
SubCategory, CheckInDateTime, CheckInID, LastCheckinID, CheckinLocation,
MostRecentMemberAgreement, MostRecentAgreementStatus, MostRecentAgreementName, MostRecentStartDate,
CancelDate, Primary/Add-on Agreement, PrimaryAgreement, PrimaryAgreementMemberID, PrimaryAgreementName,
CorporateName, ReportDate, ReportRunDate
"""

# Output columns of the net member count with their declared types (text
# lengths are not enforced).
MEMBER_COUNT_DDL = """
MemberAgreementId bigint, AgreementStatus string, PartyRoleId bigint, PartyID bigint, RoleId string,
FirstName string, LastName string, BUName string, StartDate timestamp_ntz, EndDate timestamp_ntz,
ObligationDate timestamp_ntz, CancelDate timestamp_ntz, FutureCancelDate timestamp_ntz,
BusinessUnitId bigint, AgreementId bigint, Agreement string, BundleId bigint, BundleItemCode string,
BundleName string, SALES_USERNAME string, SALES_ROLEID string, SALES_FIRSTNAME string,
SALES_LASTNAME string, SALES_PAYROLLID string, SALES_WORKROLE string, REFERRAL_PARTYROLEID1 bigint,
REFERRAL_PARTYID1 bigint, REFERRAL_FIRSTNAME1 string, REFERRAL_LASTNAME1 string,
REFERRAL_PAYROLLID string, REFERRAL_WORKROLE string, ADVISOR_FIRSTNAME string,
ADVISOR_LASTNAME string, ADVISOR_PAYROLLID string, ADVISOR_ROLEID string, ADVISOR_WORKROLE string,
PIN_FIRSTNAME string, PIN_LASTNAME string, PIN_PAYROLLID string, PIN_RoleID string,
AGREEMENT_MONTHLYDUES decimal(12,2), FIRSTINVOICEDATE timestamp_ntz
"""

POS_COLUMNS = """
RoleId, TxPaymentID, TxInvoiceID, BusinessUnit, GLCodePrefix, Code, MOSOPayTransactionCode,
MOSOPay-Reference, BatchID, Category, ReferenceID, TransCode, PaymentDate, InvoiceDate, TenderType,
CC Description, CC Abreviation, Token, Mask, ExpirationDate, MerchantCode, ResponseCode,
ResponseMessage, Debit/Credit Indicator, TransactionAmount, CashGLAcct, VS/MC MOTO, VS/MC RETAIL,
AMEX MOTO, AMEX RETAIL, NEW MOTO SE#, NEW RETAIL SE#, Chargeback_ind
"""

BATCH_COLUMNS = """
RoleId, TxPaymentID, TxInvoiceID, BusinessUnit, GLCodePrefix, Code, MOSOPayTransactionCode, BatchID,
Category, TransCode, ReferenceId, PaymentDate, InvoiceDate, TenderType, CC Description,
CC Abreviation, Token, Mask, ExpirationDate, MerchantCode, ResponseCode, ResponseMessage,
Debit/Credit Indicator, TransactionAmount, CashGLAcct, VS/MC MOTO, VS/MC RETAIL, AMEX MOTO,
AMEX RETAIL, NEW MOTO SE#, NEW RETAIL SE#, Chargeback_ind
"""


def names(listing: str) -> list[str]:
    """Split one of the column listings above."""
    return [part.strip() for part in listing.split(",")]
