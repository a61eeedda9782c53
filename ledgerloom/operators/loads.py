"""Target loads: legacy rows -> rows of the new schema.

Each function returns the rows to write; widths are enforced with
``left_n`` (explicit width conversions truncate), times go to UTC, and
codes go through the tables in ``functions.code_maps``.

J24 load_cardholders, J25 load_accounts, J26 load_balances,
J27 load_account_cardholders, J28 load_addresses, J29 load_emails /
load_phones, J30 load_cards, J31 load_card_numbers, J32 load_card_requests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import code_maps as cm
from ledgerloom.functions.exprs import (add_years, blank_to_null, cents_to_units, left_n,
                                        nonblank, ntz, to_utc, ymd_timestamp)
from ledgerloom.functions.ranking import first_per_group

CARDHOLDER_COLUMNS = ["Id", "Created", "Modified", "IsBlocked", "Ssn_Number", "Name_First",
                      "Name_Last", "DateOfBirth"]


def _mark(mark) -> F.Column:
    return ntz(cm.EMPTY_MARK if mark is None else mark)


def _since(rows: DataFrame, column: str, mark, key: str, late: DataFrame | bool | None) -> DataFrame:
    """Rows newer than the mark, and those whose ``key`` is in ``late`` (one
    column of keys, each once; True: all keys are) however old they are."""
    newer = F.col(column) > _mark(mark)
    if late is None:
        return rows.where(newer)
    if late is True:
        return rows.where(newer | F.col(key).isNotNull())
    flagged = late.select(F.col(late.columns[0]).alias("_late")).distinct()
    return rows.join(flagged, F.col(key) == F.col("_late"), "left").where(newer | F.col("_late").isNotNull()).drop("_late")


def _rank1(ranked: DataFrame) -> DataFrame:
    return ranked.where(F.col("ContactRank") == 1)


def load_cardholders(ranked: DataFrame, applications: DataFrame,
                     existing: DataFrame | None = None) -> DataFrame:
    """One card holder per person (rank-1 account) not yet loaded.

    Birth date from the newest approved application of the client (year,
    month, day parts; a bad date falls back to the master's ``dob``).
    """
    rows = _rank1(ranked)
    if existing is not None:
        present = existing.select(F.col("Ssn_Number").alias("ssn")).distinct()
        rows = rows.join(present, "ssn", "left_anti")
    approved = applications.where(F.col("status") == cm.APPROVED_APPLICATION)
    newest = first_per_group(approved.select("clientkey", "submitted", "applicationid",
                                             "year", "month", "day"),
                             ["clientkey"], [("submitted", True), ("applicationid", True)])
    newest = newest.select(F.col("clientkey").alias("_app_client"),
                           ymd_timestamp("year", "month", "day").alias("_app_dob"))
    rows = rows.join(newest, rows["clientkey"] == newest["_app_client"], "left")
    return rows.select(
        F.col("providerkey").cast("bigint").alias("Id"),
        to_utc("created").alias("Created"),
        to_utc("LastUpdateDate").alias("Modified"),
        F.lit(0).alias("IsBlocked"),
        left_n("ssn", 16).alias("Ssn_Number"),
        left_n("firstname", 32).alias("Name_First"),
        left_n("lastname", 32).alias("Name_Last"),
        F.coalesce(F.col("_app_dob"), F.col("dob")).alias("DateOfBirth"))


def load_accounts(ranked: DataFrame, fee_plans: DataFrame, lookup: DataFrame,
                  applications: DataFrame, *, mark=None, late: DataFrame | bool | None = None) -> DataFrame:
    """Accounts changed after ``mark`` in the new schema, and the ``late``
    ones (ids that the target lacks).

    The newest application id per client is a max, so it is one partial
    aggregate; fee plan and deposit id are many-to-one lookups.
    """
    rows = _since(ranked, "LastUpdateDate", mark, "entryid", late)
    plans = fee_plans.select(F.col("FeePlanChangeID").alias("_fpc"), F.col("FeePlanID"))
    deposit = lookup.select(F.col("entryid").alias("_dd"), F.col("FullDepositID").alias("_full"))
    apps = (applications.groupBy(F.col("clientkey").alias("_app_client"))
            .agg(F.max("applicationid").alias("_app_id")))
    # the deposit first: rows that met the late keys lie by the account already
    j = (rows.join(deposit, F.col("entryid") == deposit["_dd"], "left")
         .join(plans, F.col("LastFeePlanChangeID") == plans["_fpc"], "left")
         .join(apps, F.col("clientkey") == apps["_app_client"], "left"))
    status = {"account_status": F.col("accountstatus")}
    return j.select(
        F.col("entryid").alias("Id"),
        to_utc("CreateDate").alias("Created"),
        to_utc("LastUpdateDate").alias("Modified"),
        cm.build(cm.ACCOUNT_STATUS, cm.ACCOUNT_STATUS_DEFAULT, status).alias("Status"),
        to_utc("activateddate").alias("ActivationDate"),
        left_n(F.col("_full").cast("string"), 16).alias("DepositNumber"),
        cm.build(cm.FEE_PLAN_TYPE, cm.FEE_PLAN_TYPE_DEFAULT,
                 {"fee_plan": F.col("FeePlanID")}).alias("Type_Id"),
        F.col("entryid").alias("AccountBalance_Id"),
        F.col("_app_id").alias("ApplicationId"),
        F.lit(0).alias("IsFraud"),
        cm.build(cm.ACCOUNT_STATUS_REASON, cm.ACCOUNT_STATUS_REASON_DEFAULT,
                 status).alias("StatusChangeReason"),
        F.lit(1).alias("LimitPackage"))


BALANCE_COLUMNS = ["Id", "Created", "Modified", "AvailableBalance", "LedgerBalance", "EffectiveDate"]


def load_balances(accounts: DataFrame, ranked: DataFrame, balances: DataFrame,
                  existing: DataFrame | None = None, *, mark=None, as_of,
                  literal: bool = False, late: DataFrame | bool | None = None) -> DataFrame:
    """Balance rows to load (of ``late`` accounts whatever their time).

    Real balances newer than ``mark`` (cents -> decimal(18,2)), plus one
    0.00 row stamped ``as_of`` for each loaded account without any balance
    record, inserted only if that account has no balance row yet.
    ``literal=True`` with no mark loads no real balances (the legacy text
    reset the wrong variable).
    """
    acct = accounts.select(F.col("Id")).join(
        ranked.select(F.col("entryid").alias("Id"), "provideraccountID"), "Id")
    bal = balances.where(F.col("TransactionID").isNotNull()).select(
        F.col("UserAccountID").alias("provideraccountID"), "CreateDate", "LastUpdateDate",
        "UserAvailableBalance", "UserLedgerBalance", "TransactionTime")
    if literal and mark is None:
        real = acct.join(bal, "provideraccountID").where(F.lit(False))
    else:
        real = _since(acct.join(bal, "provideraccountID"), "TransactionTime", mark, "Id", late)
    real = real.select(
        "Id", to_utc("CreateDate").alias("Created"), to_utc("LastUpdateDate").alias("Modified"),
        cents_to_units("UserAvailableBalance").alias("AvailableBalance"),
        cents_to_units("UserLedgerBalance").alias("LedgerBalance"),
        to_utc("TransactionTime").alias("EffectiveDate"))
    stamp = ntz(str(as_of))
    zero = F.lit(0).cast("decimal(18,2)")
    none = acct.join(bal.select("provideraccountID").distinct(), "provideraccountID", "left_anti")
    if existing is not None and not literal:
        none = none.join(existing.select("Id").distinct(), "Id", "left_anti")
    none = none.select("Id", stamp.alias("Created"), stamp.alias("Modified"),
                       zero.alias("AvailableBalance"), zero.alias("LedgerBalance"),
                       stamp.alias("EffectiveDate"))
    return real.unionByName(none)


def load_account_cardholders(accounts: DataFrame, qualifying: DataFrame,
                             cardholders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(account, card holder) pairs not yet mapped, distinct."""
    acct = accounts.select(F.col("Id").alias("entryid"))
    if existing is not None:
        acct = acct.join(existing.select(F.col("Account_Id").alias("entryid")).distinct(),
                         "entryid", "left_anti")
    people = qualifying.select("entryid", "ssn")
    ch = cardholders.select(F.col("Id").alias("Cardholder_id"), F.col("Ssn_Number").alias("ssn"))
    return (acct.join(people, "entryid").join(ch, "ssn")
            .select(F.col("entryid").alias("Account_id"), "Cardholder_id").distinct())


def _contact_rows(cardholders: DataFrame, ranked: DataFrame, mark, late: DataFrame | bool | None = None) -> DataFrame:
    """Card holders with their rank-1 account, where that changed after
    ``mark`` or the card holder's id is in ``late``."""
    ch = cardholders.select(F.col("Id").alias("CardHolder_Id"), F.col("Ssn_Number").alias("ssn"))
    if late is None:  # the mark before the join
        return ch.join(_since(_rank1(ranked), "LastUpdateDate", mark, "entryid", None), "ssn")
    return _since(ch.join(_rank1(ranked), "ssn"), "LastUpdateDate", mark, "CardHolder_Id", late)


def changed_cardholders(cardholders: DataFrame, ranked: DataFrame, *, mark=None,
                        late: DataFrame | bool | None = None) -> DataFrame:
    """Card holder ids whose contact rows are replaced in this run."""
    return _contact_rows(cardholders, ranked, mark, late).select("CardHolder_Id").distinct()


def _with_state(rows: DataFrame, states: DataFrame, collation: str | None) -> DataFrame:
    """Left lookup of the state id by its text (``collation`` optional)."""
    st = states.select(F.col("id").alias("_state_id"), F.col("value").alias("_state_text"))
    left, right = F.col("state"), st["_state_text"]
    if collation is not None:
        left, right = F.collate(left, collation), F.collate(right, collation)
    return rows.join(st, left == right, "left").drop("_state_text")


def load_addresses(cardholders: DataFrame, ranked: DataFrame, states: DataFrame, *,
                   mark=None, collation: str | None = None, late: DataFrame | bool | None = None) -> DataFrame:
    """One address per changed card holder (its rank-1 account)."""
    rows = _with_state(_contact_rows(cardholders, ranked, mark, late), states, collation)
    return rows.select(
        to_utc("CreateDate").alias("Created"), to_utc("LastUpdateDate").alias("Modified"),
        F.lit(1).alias("Type"),
        left_n("address1", 40).alias("Address1"), left_n("address2", 40).alias("Address2"),
        left_n("address3", 40).alias("Address3"), left_n("city", 25).alias("City"),
        F.coalesce(F.col("_state_id"), F.lit(cm.UNKNOWN_STATE)).alias("State"),
        left_n(F.replace(F.col("zip"), F.lit("-"), F.lit("")), 9).alias("PostalCode"),
        F.lit(0).alias("Country"), F.lit(1).alias("Program_Id"), "CardHolder_Id")


def load_emails(cardholders: DataFrame, ranked: DataFrame, *, mark=None, late: DataFrame | bool | None = None) -> DataFrame:
    """Non-blank e-mail addresses (120 characters)."""
    rows = _contact_rows(cardholders, ranked, mark, late).where(nonblank("email"))
    return rows.select(to_utc("CreateDate").alias("Created"),
                       to_utc("LastUpdateDate").alias("Modified"),
                       left_n("email", 120).alias("Address"), F.lit(1).alias("Type"),
                       "CardHolder_Id")


def load_phones(cardholders: DataFrame, ranked: DataFrame, *, mark=None, late: DataFrame | bool | None = None) -> DataFrame:
    """Telephone (type 1) and cell (type 2) as rows, from one scan.

    The two-branch UNION ALL becomes an unpivot of the two columns, so the
    account rows are read and joined once.
    """
    rows = _contact_rows(cardholders, ranked, mark, late)
    pairs = F.explode(F.array(
        F.struct(F.lit(1).alias("Type"), F.col("telephone").alias("_digits")),
        F.struct(F.lit(2).alias("Type"), F.col("celltel").alias("_digits"))))
    unpivoted = rows.select("CreateDate", "LastUpdateDate", "CardHolder_Id", pairs.alias("_p"))
    return (unpivoted.where(nonblank(F.col("_p._digits")))
            .select(to_utc("CreateDate").alias("Created"),
                    to_utc("LastUpdateDate").alias("Modified"),
                    F.col("_p.Type").alias("Type"),
                    left_n(F.col("_p._digits"), 16).alias("Digits"), "CardHolder_Id"))


def load_cards(ranked: DataFrame, mapping: DataFrame, cards: DataFrame, materials: DataFrame,
               plastic_types: DataFrame, fee_plans: DataFrame, pin_sets: DataFrame,
               status_history: DataFrame, *, mark=None, late: DataFrame | bool | None = None) -> DataFrame:
    """Cards of converted accounts changed after ``mark``, and the ``late``
    ones (card ids that the target lacks).

    Pin flag = any pin-set row for the card (a distinct key set); block
    reason = the newest status-history row (top-1 per card). Fee plan and
    plastic type are existence joins, kept inner as in the source. The fee plan
    meets the accounts before the wide cards do; ``late`` keys meet the cards
    that are left, which are joined on the card anyway.
    """
    acc = ranked.select("entryid", "ActiveCardID", "LastFeePlanChangeID")
    m = mapping.select(F.col("Account_ID").alias("entryid"), "Cardholder_ID")
    c = cards if late is not None else _since(cards, "LastUpdateDate", mark, "cardid", None)
    mats = materials.select("MaterialID", "PlasticTypeID")
    pts = plastic_types.select("PlasticTypeID")
    plans = fee_plans.select(F.col("FeePlanChangeID").alias("LastFeePlanChangeID"))
    pins = pin_sets.select(F.col("cardid")).distinct().withColumn("_pin", F.lit(1))
    hist = first_per_group(status_history.select("cardid", "changeddate", "blockreasonid"),
                           ["cardid"], [("changeddate", True), ("blockreasonid", True)])
    hist = hist.select("cardid", F.col("blockreasonid").alias("_block"))
    j = (acc.join(plans, "LastFeePlanChangeID")
         .join(m, "entryid")
         .join(c, F.col("cardholderid") == F.col("entryid"))
         .join(mats, "MaterialID")
         .join(pts, "PlasticTypeID"))
    if late is not None:
        j = _since(j, "LastUpdateDate", mark, "cardid", late)
    j = j.join(pins, "cardid", "left").join(hist, "cardid", "left")
    block = F.coalesce(F.col("_block"), F.lit(0))
    roles = {"card_status": F.col("cardstatus"), "block_reason": block,
             "issuance_state": F.col("IssuanceState"),
             "active": (F.col("ActiveCardID") == F.col("cardid")).cast("int")}
    return j.select(
        F.col("cardid").alias("Id"),
        to_utc("CreateDate").alias("Created"), to_utc("LastUpdateDate").alias("Modified"),
        to_utc("IssueDate").alias("IssueDate"),
        F.when(F.col("_pin").isNotNull(), 1).otherwise(0).alias("IsPinSet"),
        left_n("nameoncard", 26).alias("NameOnCard"),
        F.col("expmonth").alias("CardExpiration_Month"),
        F.col("expyear").alias("CardExpiration_Year"),
        cm.build(cm.CARD_STATUS, cm.CARD_STATUS_DEFAULT, roles).alias("Status"),
        cm.build(cm.ISSUE_REASON, cm.ISSUE_REASON_DEFAULT, roles).alias("IssueReason"),
        F.col("PlasticTypeID").alias("CardStock_Id"),
        F.col("entryid").alias("Account_Id"),
        F.col("Cardholder_ID").alias("CardHolder_Id"),
        cm.build(cm.STATUS_REASON, cm.STATUS_REASON_DEFAULT, roles).alias("StatusReason"),
        F.col("cardid").alias("CardNumber_Id"),
        add_years(to_utc("created"), 1).alias("WhenEligibleForFreeReplacementCard"),
        F.lit(None).cast("bigint").alias("CardCreationHistory_Id"))


def load_card_numbers(mapping: DataFrame, cards: DataFrame, pans: DataFrame, *,
                      mask: str = cm.MASKED_PAN) -> DataFrame:
    """Every card of a mapped account with its number (16) or the mask."""
    m = mapping.select(F.col("Account_Id").alias("cardholderid"))
    c = cards.select("cardid", "cardholderid", "externalcardid", "LastUpdateDate", "CreateDate")
    p = pans.select("externalcardid", "PAN")
    j = m.join(c, "cardholderid").join(p, "externalcardid", "left")
    number = F.when(F.col("PAN").isNotNull(), left_n("PAN", 16)).otherwise(F.lit(mask))
    return j.select(F.col("cardid").alias("Id"), to_utc("LastUpdateDate").alias("Modified"),
                    to_utc("CreateDate").alias("Created"), number.alias("Number"))


def load_card_requests(requests: DataFrame, existing: DataFrame | None, master: DataFrame,
                       mapping: DataFrame, states: DataFrame, *,
                       collation: str | None = None) -> DataFrame:
    """Card requests not yet converted, with the account's address."""
    r = requests
    if existing is not None:
        r = r.join(existing.select(F.col("id").alias("CardRequestID")).distinct(),
                   "CardRequestID", "left_anti")
    mch = master.select(F.col("entryid").alias("EntryID"), "address1", "address2", "address3",
                        "city", "zip", "state")
    m = mapping.select(F.col("Account_Id").alias("EntryID"))
    j = _with_state(r.join(mch, "EntryID").join(m, "EntryID"), states, collation)
    return j.select(
        F.col("CardRequestID").alias("Id"),
        left_n("address1", 40).alias("Address1"),
        blank_to_null("address2", 40).alias("Address2"),
        blank_to_null("address3", 40).alias("Address3"),
        left_n("city", 25).alias("City"),
        F.coalesce(F.col("_state_id"), F.lit(cm.UNKNOWN_STATE)).alias("State"),
        left_n("zip", 5).alias("PostalCode"),
        F.lit(0).alias("Country"),
        cm.build(cm.DELIVERY_TYPE, cm.DELIVERY_TYPE_DEFAULT,
                 {"delivery": F.col("DeliveryTypeID")}).alias("DeliverType"),
        to_utc("CreateDate").alias("Created"), to_utc("LastUpdateDate").alias("Modified"))
