"""Declared schemas of the input roles and the targets (no inference).

Input roles follow the legacy column names; types as read off the legacy
queries (keys bigint, codes int, times TIMESTAMP_NTZ wall clock).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INPUT_SCHEMAS = {
    "master": (
        "entryid bigint, programid int, clientkey bigint, providercreationtime timestamp_ntz, "
        "providerkey string, firstname string, lastname string, address1 string, "
        "address2 string, address3 string, address4 string, city string, state string, "
        "country string, zip string, email string, telephone string, ssn string, "
        "dob timestamp_ntz, password string, accountstatus int, created timestamp_ntz, "
        "availablebalance bigint, ledgerbalance bigint, sex string, activateddate timestamp_ntz, "
        "fraudrating int, CreateDate timestamp_ntz, LastUpdateDate timestamp_ntz, "
        "LastUpdateUser string, customReferralID string, EmailVerified int, celltel string, "
        "provideraccountID bigint, RetailStatusID int, OriginalCardIssuanceID bigint, "
        "ActiveCardID bigint, LastFeePlanChangeID bigint, AccountTypeId int, "
        "PreferredLanguage string"),
    "cards": (
        "cardid bigint, cardholderid bigint, expmonth int, expyear int, externalcardid bigint, "
        "LastUpdateDate timestamp_ntz, CreateDate timestamp_ntz, created timestamp_ntz, "
        "IssueDate timestamp_ntz, nameoncard string, cardstatus int, IssuanceState int, "
        "MaterialID int"),
    "balances": (
        "UserAccountID bigint, UserLedgerBalance bigint, UserAvailableBalance bigint, "
        "TransactionID bigint, TransactionTime timestamp_ntz, CreateDate timestamp_ntz, "
        "LastUpdateDate timestamp_ntz"),
    "goals": "EntryID bigint, PayRewardsToEntryID bigint",
    "deposit_ids": (
        "Entryid bigint, ShortDepositID string, FullDepositID string, "
        "EncryptedDepositID string, createdate timestamp_ntz"),
    "deposit_usage": "dfiaccountno string",
    "applications": (
        "applicationid bigint, clientkey bigint, status int, submitted timestamp_ntz, "
        "year int, month int, day int"),
    "fee_plans": "FeePlanChangeID bigint, FeePlanID int",
    "states": "id int, value string",
    "pin_sets": "cardid bigint, asofdate timestamp_ntz",
    "status_history": "cardid bigint, blockreasonid int, changeddate timestamp_ntz",
    "materials": "MaterialID int, PlasticTypeID int",
    "plastic_types": "PlasticTypeID int",
    "pans": "externalcardid bigint, PAN string",
    "legacy_mapping": "Account_ID bigint, Cardholder_ID bigint",
    "card_requests": (
        "CardRequestID bigint, EntryID bigint, DeliveryTypeID int, CreateDate timestamp_ntz, "
        "LastUpdateDate timestamp_ntz"),
    "request_histories": "id bigint",
    "events": (
        "id bigint, Event string, Email string, DealerCode string, EventDate timestamp_ntz, "
        "Status string, Response string, Reason string, Attempt int, Cert_Err int, TLS int"),
    "event_categories": "event_id bigint, category_id bigint",
    "categories": "id bigint, Category string",
}

TARGET_SCHEMAS = {
    "Cardholders": "Id bigint, Created timestamp_ntz, Modified timestamp_ntz, IsBlocked int, "
                   "Ssn_Number string, Name_First string, Name_Last string, DateOfBirth timestamp_ntz",
    "Accounts": "Id bigint, Created timestamp_ntz, Modified timestamp_ntz, Status int, "
                "ActivationDate timestamp_ntz, DepositNumber string, Type_Id int, "
                "AccountBalance_Id bigint, ApplicationId bigint, IsFraud int, "
                "StatusChangeReason int, LimitPackage int",
    "AccountBalances": "Id bigint, Created timestamp_ntz, Modified timestamp_ntz, "
                       "AvailableBalance decimal(18,2), LedgerBalance decimal(18,2), "
                       "EffectiveDate timestamp_ntz",
    "AccountCardholders": "Account_id bigint, Cardholder_id bigint",
    "Addresses": "Created timestamp_ntz, Modified timestamp_ntz, Type int, Address1 string, "
                 "Address2 string, Address3 string, City string, State int, PostalCode string, "
                 "Country int, Program_Id int, CardHolder_Id bigint",
    "Emails": "Created timestamp_ntz, Modified timestamp_ntz, Address string, Type int, "
              "CardHolder_Id bigint",
    "Phones": "Created timestamp_ntz, Modified timestamp_ntz, Type int, Digits string, "
              "CardHolder_Id bigint",
    "Cards": "Id bigint, Created timestamp_ntz, Modified timestamp_ntz, IssueDate timestamp_ntz, "
             "IsPinSet int, NameOnCard string, CardExpiration_Month int, CardExpiration_Year int, "
             "Status int, IssueReason int, CardStock_Id int, Account_Id bigint, "
             "CardHolder_Id bigint, StatusReason int, CardNumber_Id bigint, "
             "WhenEligibleForFreeReplacementCard timestamp_ntz, CardCreationHistory_Id bigint",
    "CardNumbers": "Id bigint, Modified timestamp_ntz, Created timestamp_ntz, Number string",
    "CardCreationHistories": "Id bigint, Address1 string, Address2 string, Address3 string, "
                             "City string, State int, PostalCode string, Country int, "
                             "DeliverType string, Created timestamp_ntz, Modified timestamp_ntz",
    "DDID_Lookup": "entryid bigint, ShortDepositId string, FullDepositID string, "
                   "EncryptedDepositID string, CreateDate timestamp_ntz",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def read_role(spark: SparkSession, path: str, role: str, fmt: str = "parquet") -> DataFrame:
    """Read an input role with its declared schema (no inference pass)."""
    return spark.read.schema(struct(INPUT_SCHEMAS[role])).format(fmt).load(path)


# Declared keys of the roles that the jobs rely on being unique.
DECLARED_KEYS = {"master": "entryid", "cards": "cardid", "fee_plans": "FeePlanChangeID",
                 "states": "id", "card_requests": "CardRequestID"}


# Keys of the targets, and the references between them: (child, column, parent, key).
TARGET_KEYS = {"Cardholders": "Id", "Accounts": "Id", "AccountBalances": "Id", "Cards": "Id", "CardNumbers": "Id",
               "CardCreationHistories": "Id", "DDID_Lookup": "entryid"}
TARGET_REFERENCES = [
    ("Accounts", "AccountBalance_Id", "AccountBalances", "Id"), ("AccountBalances", "Id", "Accounts", "Id"),
    ("AccountCardholders", "Account_id", "Accounts", "Id"), ("AccountCardholders", "Cardholder_id", "Cardholders", "Id"),
    ("Addresses", "CardHolder_Id", "Cardholders", "Id"), ("Emails", "CardHolder_Id", "Cardholders", "Id"),
    ("Phones", "CardHolder_Id", "Cardholders", "Id"), ("Cards", "Account_Id", "Accounts", "Id"),
    ("Cards", "CardHolder_Id", "Cardholders", "Id"), ("Cards", "CardNumber_Id", "CardNumbers", "Id"),
]


def conform(df: DataFrame, ddl: str, *, allow_missing: bool = False, on_bad: str = "fail") -> DataFrame:
    """Select and cast ``df`` to a declared schema by column name.

    Missing columns are an error unless ``allow_missing`` (then NULL). A
    value that does not fit its type fails the job with the column's name;
    ``on_bad="null"`` makes it NULL (``misfits`` lists such rows).
    """
    if on_bad not in ("fail", "null"):
        raise ValueError(on_bad)
    cols = []
    for f, src in _declared(df, ddl):
        if src is None:
            if not allow_missing:
                raise ValueError(f"missing column {f.name}")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(src).try_cast(f.dataType)
        if on_bad == "fail" and df.schema[src].dataType != f.dataType:
            bad = F.col(src).isNotNull() & value.isNull()
            text = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), F.col(src).cast("string"))
            value = F.when(bad, F.raise_error(text).cast(f.dataType)).otherwise(value)
        cols.append(value.alias(f.name))
    return df.select(*cols)


def misfits(df: DataFrame, ddl: str) -> DataFrame:
    """Rows with a value that does not fit its declared type, with ``reason``
    (the names of those columns)."""
    names = [F.when(F.col(src).isNotNull() & F.col(src).try_cast(f.dataType).isNull(), F.lit(f.name))
             for f, src in _declared(df, ddl) if src is not None]
    found = df.withColumn("reason", F.concat_ws(",", *names))
    return found.where(F.col("reason") != "")


def _declared(df: DataFrame, ddl: str):
    present = {c.lower(): c for c in df.columns}
    return [(f, present.get(f.name.lower())) for f in struct(ddl).fields]
