"""Role frames: the driver's tables shaped into the roles the jobs expect.

The legacy tables (events with categories, deposit ids, card holders, cards,
balances, ...) are not in the test data. Each function here maps a driver
table onto one role with plain ``select``/``filter`` so the jobs run over
whole tables and their work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.exprs import ntz
from ledgerloom.sources.tables import Tables, read_table

# ---- category flattening -------------------------------------------------


def events(t: Tables) -> DataFrame:
    """Events: orders; id = o_orderkey."""
    return t.orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus",
                           "o_orderpriority", "o_orderdate")


def event_categories(t: Tables) -> DataFrame:
    """Bridge: one lineitem per (order, part)."""
    return t.lineitem.select(F.col("l_orderkey").alias("event_id"),
                             F.col("l_partkey").alias("category_id"))


def categories(t: Tables) -> DataFrame:
    """Categories: part type."""
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("Category"))


NEW_EVENTS_FROM = "2001-01-01"


def flattened_target(t: Tables, domain: list[str]) -> DataFrame:
    """An existing flat table: the flattening of the events before 2001."""
    from ledgerloom.operators.flatten import category_flatten
    old = events(t).where(F.col("o_orderdate") < ntz(NEW_EVENTS_FROM))
    return category_flatten(old, event_categories(t), categories(t), domain)


# ---- ranked duplicate pruning ----------------------------------------------

def card_holder_keys(t: Tables) -> DataFrame:
    """Master card holders, key only: orders."""
    return t.orders.select(F.col("o_orderkey").alias("entryid"))


def _deposit_key():
    return F.col("l_partkey") * 100 + F.col("l_linenumber")


def deposit_ids(t: Tables) -> DataFrame:
    """Deposit ids: all line items; entry = order, id = part and line."""
    return t.lineitem.select(F.col("l_orderkey").alias("Entryid"),
                             F.col("l_partkey").cast("string").alias("ShortDepositID"),
                             _deposit_key().alias("FullDepositID"),
                             _deposit_key().alias("EncryptedDepositID"),
                             F.col("l_shipdate").alias("createdate"))


def deposit_usage(t: Tables) -> DataFrame:
    """Direct deposit records: a returned line item is one use of its part and line."""
    return (t.lineitem.where(F.col("l_returnflag") == "R")
            .select(_deposit_key().alias("dfiaccountno")))


# ---- incremental loads -----------------------------------------------------

CHANGED_FROM = "2001-01-01"


def loaded_accounts(t: Tables) -> DataFrame:
    """An Accounts target loaded by an earlier run: orders before the cut,
    Modified stored in UTC as the loads do."""
    from ledgerloom.functions.exprs import to_utc
    return (t.orders.where(F.col("o_orderdate") < ntz(CHANGED_FROM))
            .select(F.col("o_orderkey").alias("Id"), to_utc("o_orderdate").alias("Modified")))


def existing_accounts(t: Tables) -> DataFrame:
    """Accounts already in the target: every priority but the lowest."""
    return (t.orders.where(F.col("o_orderpriority") != "5-LOW")
            .select(F.col("o_orderkey").alias("Id"), F.col("o_orderstatus").alias("Status"),
                    F.col("o_orderdate").alias("Modified"), F.lit("target").alias("loaded_by")))


def reloaded_accounts(t: Tables) -> DataFrame:
    """Re-derived rows for changed accounts that still qualify (not pending)."""
    return (t.orders.where((F.col("o_orderdate") >= ntz(CHANGED_FROM))
                           & (F.col("o_orderstatus") != "P"))
            .select(F.col("o_orderkey").alias("Id"), F.col("o_orderstatus").alias("Status"),
                    F.col("o_orderdate").alias("Modified"), F.lit("reload").alias("loaded_by")))


def changed_account_keys(t: Tables) -> DataFrame:
    return (t.orders.where(F.col("o_orderdate") >= ntz(CHANGED_FROM))
            .select(F.col("o_orderkey").alias("Id")))


# ---- qualification (customer-level master) ---------------------------------

EXP_DATE = "2001-06-15"


def customer_master(t: Tables) -> DataFrame:
    """Card holders as customers: person = nation, BUILDING accounts are
    type 2 (secondary), HOUSEHOLD accounts are closed (status 6). Dummy
    persons by the account balance: each of the sentinel values stands for
    one range of it."""
    c = t.customer
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    return c.select(
        "*",
        F.col("c_custkey").alias("entryid"),
        F.when(bal.between(-100, 0), "999999999").when(bal.between(-200, -100), "123456789 ")
         .when(bal.between(-300, -200), "   ").otherwise(F.col("c_nationkey").cast("string")).alias("ssn"),
        F.when(bal.between(-400, -300), "FIRST NAME").otherwise(F.col("c_name")).alias("firstname"),
        F.when(seg == "BUILDING", 2).otherwise(1).alias("AccountTypeId"),
        F.when(seg == "HOUSEHOLD", 6).otherwise(1).alias("accountstatus"),
        F.col("c_custkey").alias("provideraccountID"))


def customer_cards(t: Tables) -> DataFrame:
    """Cards: all orders; expiry = order month."""
    return t.orders.select(F.col("o_orderkey").alias("cardid"),
                           F.col("o_custkey").alias("cardholderid"),
                           F.month("o_orderdate").alias("expmonth"),
                           F.year("o_orderdate").alias("expyear"),
                           F.col("o_orderkey").alias("externalcardid"))


def goals(t: Tables) -> DataFrame:
    """Goals: one per supplier; the account of its number pays into the one
    as many numbers further as its nation's key."""
    return t.supplier.select(F.col("s_suppkey").alias("EntryID"),
                             (F.col("s_suppkey") + F.col("s_nationkey")).alias("PayRewardsToEntryID"))


def _cents(c):
    return F.round(F.col(c) * 100).cast("bigint")


def ledger_balances(t: Tables) -> DataFrame:
    """Ledger balances: a customer's negative balance is outstanding, else 0."""
    bal = F.when(F.col("c_acctbal") < 0, _cents("c_acctbal")).otherwise(F.lit(0).cast("bigint"))
    return t.customer.select(F.col("c_custkey").alias("UserAccountID"),
                             bal.alias("UserLedgerBalance"), bal.alias("UserAvailableBalance"))


def order_balances(t: Tables) -> DataFrame:
    """Balance rows: all orders, amount in cents; an open order's is zero."""
    cents = F.when(F.col("o_orderstatus") == "O", F.lit(0).cast("bigint")).otherwise(_cents("o_totalprice"))
    return t.orders.select(F.col("o_custkey").alias("UserAccountID"),
                           cents.alias("UserAvailableBalance"), cents.alias("UserLedgerBalance"))


def ordering_customers(t: Tables, before: bool) -> DataFrame:
    """Run snapshots: customers ordering before / from CHANGED_FROM."""
    d = F.col("o_orderdate")
    cond = d < ntz(CHANGED_FROM) if before else d >= ntz(CHANGED_FROM)
    return t.orders.where(cond).select(F.col("o_custkey").alias("entryid"))


def existing_lookup(t: Tables) -> DataFrame:
    """Deposit-id lookup rows already present: the urgent orders."""
    return (t.orders.where(F.col("o_orderpriority") == "1-URGENT")
            .select(F.col("o_orderkey").alias("entryid")))


# ---- conversion (order-level master: one account per order) ----------------


def _account_status() -> Column:
    status = F.col("o_orderstatus")
    return F.when(status == "F", 6).when(status == "O", 1).otherwise(2)


def _account_type() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def rule_rows(t: Tables) -> DataFrame:
    """Of every row of ``accounts_master`` the columns that the qualification
    reads: the codes are taken before the lookup of the name, so that no text
    of an order is shuffled, and the active card is not sought."""
    o, c, n = t.orders, t.customer, t.nation
    o = o.select("o_orderkey", "o_custkey", _account_type().alias("AccountTypeId"), _account_status().alias("accountstatus"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    return j.select(F.col("o_orderkey").alias("entryid"), F.col("o_custkey").cast("string").alias("ssn"),
                    F.col("c_name").alias("firstname"), "AccountTypeId", "accountstatus",
                    F.col("o_orderkey").alias("provideraccountID"))


def accounts_master(t: Tables, among: DataFrame | None = None) -> DataFrame:
    """Legacy master rows, one account per order, person = customer.
    ``among`` (column ``entryid``, each once): the rows of these alone, taken
    before the lookups.

    The active card of an account is the customer's newest order; the
    provider key is junk ('K'+key or blanks) for two rare order kinds.
    """
    o, c, n = t.orders, t.customer, t.nation
    newest = (o.groupBy(F.col("o_custkey").alias("_ck"))
              .agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey"))
                   .alias("ActiveCardID")))
    if among is not None:
        wanted = among.select(F.col("entryid").alias("_wanted"))
        o = o.join(wanted, o["o_orderkey"].eqNullSafe(wanted["_wanted"]), "left_semi")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    key_text = F.col("o_orderkey").cast("string")
    provider = (F.when((status == "P") & (prio == "5-LOW"), F.concat(F.lit("K"), key_text))
                .when((status == "P") & (prio == "4-NOT SPECIFIED"), F.lit("  "))
                .otherwise(key_text))
    # every customer of an order has a newest one; left, so that a reader
    # without the active card is spared the join
    j = (o.join(c, o["o_custkey"] == c["c_custkey"])
         .join(n, c["c_nationkey"] == n["n_nationkey"])
         .join(newest, o["o_custkey"] == newest["_ck"], "left"))
    return j.select(
        F.col("o_orderkey").alias("entryid"),
        F.lit(1).alias("programid"),
        F.col("o_custkey").alias("clientkey"),
        provider.alias("providerkey"),
        F.col("c_name").alias("firstname"),
        F.col("c_mktsegment").alias("lastname"),
        F.col("c_name").alias("address1"),
        F.when(status == "F", F.lit("   ")).otherwise(prio).alias("address2"),
        status.alias("address3"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), F.lit("-"),
                 F.substring(prio, 1, 1)).alias("zip"),
        F.when(status == "O", F.concat(F.lower("c_name"), F.lit("@mail.test")))
         .otherwise(F.lit("")).alias("email"),
        F.concat(F.lit("555"), F.col("o_custkey").cast("string")).alias("telephone"),
        F.when(prio == "1-URGENT", F.concat(F.lit("1"), key_text)).alias("celltel"),
        F.col("o_custkey").cast("string").alias("ssn"),
        F.col("o_orderdate").alias("dob"),
        _account_status().alias("accountstatus"),
        F.col("o_orderdate").alias("created"),
        _cents("o_totalprice").alias("availablebalance"),
        _cents("o_totalprice").alias("ledgerbalance"),
        F.col("o_orderdate").alias("activateddate"),
        F.col("o_orderdate").alias("CreateDate"),
        F.col("o_orderdate").alias("LastUpdateDate"),
        F.col("o_orderkey").alias("provideraccountID"),
        "ActiveCardID",
        F.col("o_orderkey").alias("LastFeePlanChangeID"),
        _account_type().alias("AccountTypeId"))


def persons(t: Tables) -> DataFrame:
    """The person of every account, without the master's lookups."""
    return t.orders.select(F.col("o_custkey").cast("string").alias("ssn"))


def category_brands(t: Tables) -> DataFrame:
    """Categories: part type with brand (more than a hundred values)."""
    return t.part.select(F.col("p_partkey").alias("id"),
                         F.concat_ws(" ", "p_type", "p_brand").alias("Category"))


def _digit(c: str):
    return F.substring(F.col(c), 1, 1).cast("int")


def applications(t: Tables) -> DataFrame:
    """Applications: one per order; finished orders are approved (status 7);
    birth-date parts from the order date 30 years back (29 Feb -> invalid)."""
    o = t.orders
    return o.select(F.col("o_orderkey").alias("applicationid"),
                    F.col("o_custkey").alias("clientkey"),
                    F.when(F.col("o_orderstatus") == "F", 7).otherwise(1).alias("status"),
                    F.col("o_orderdate").alias("submitted"),
                    (F.year("o_orderdate") - 30).alias("year"),
                    F.month("o_orderdate").alias("month"),
                    F.dayofmonth("o_orderdate").alias("day"))


def fee_plans(t: Tables) -> DataFrame:
    """Fee plan changes: one per order, plan id = priority digit."""
    return t.orders.select(F.col("o_orderkey").alias("FeePlanChangeID"),
                           _digit("o_orderpriority").alias("FeePlanID"))


def deposit_lookup(t: Tables) -> DataFrame:
    """Deposit-id lookup of the accounts: finished orders, 20-character ids."""
    o = t.orders.where(F.col("o_orderstatus") == "F")
    return o.select(F.col("o_orderkey").alias("entryid"),
                    F.concat(F.lpad(F.col("o_custkey").cast("string"), 10, "0"),
                             F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))
                    .alias("FullDepositID"))


BALANCES_LOADED_BEFORE = "2000-01-01"
AS_OF = "2001-09-01 00:00:00"


def account_balances(t: Tables) -> DataFrame:
    """Account balances: finished orders, in cents."""
    o = t.orders.where(F.col("o_orderstatus") == "F")
    return o.select(F.col("o_orderkey").alias("UserAccountID"),
                    _cents("o_totalprice").alias("UserAvailableBalance"),
                    _cents("o_totalprice").alias("UserLedgerBalance"),
                    F.col("o_orderkey").alias("TransactionID"),
                    F.col("o_orderdate").alias("TransactionTime"),
                    F.col("o_orderdate").alias("CreateDate"),
                    F.col("o_orderdate").alias("LastUpdateDate"))


def loaded_balances(t: Tables) -> DataFrame:
    """AccountBalances target of an earlier run (balances before 2000)."""
    from ledgerloom.functions.exprs import to_utc
    b = account_balances(t).where(F.col("TransactionTime") < ntz(BALANCES_LOADED_BEFORE))
    return b.select(F.col("UserAccountID").alias("Id"),
                    to_utc("TransactionTime").alias("EffectiveDate"))


def legacy_mapping(t: Tables) -> DataFrame:
    """Legacy account -> card holder mapping: order -> customer."""
    return t.orders.select(F.col("o_orderkey").alias("Account_ID"),
                           F.col("o_custkey").alias("Cardholder_ID"))


def existing_mapping(t: Tables) -> DataFrame:
    """AccountCardholders already loaded: the high-priority orders."""
    return (t.orders.where(F.col("o_orderpriority") == "2-HIGH")
            .select(F.col("o_orderkey").alias("Account_Id"),
                    F.col("o_custkey").alias("Cardholder_Id")))


def cards(t: Tables) -> DataFrame:
    """Cards: one per order (card holder = the account); status O/P/F -> 1/2/3."""
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("cardid"),
        F.col("o_orderkey").alias("cardholderid"),
        F.month("o_orderdate").alias("expmonth"),
        (F.year("o_orderdate") + 3).alias("expyear"),
        F.col("o_orderkey").alias("externalcardid"),
        F.col("o_orderdate").alias("LastUpdateDate"),
        F.col("o_orderdate").alias("CreateDate"),
        F.col("o_orderdate").alias("created"),
        F.col("o_orderdate").alias("IssueDate"),
        F.concat(F.lit("CARDHOLDER NAME FOR CUSTOMER "), F.col("o_custkey").cast("string"))
         .alias("nameoncard"),
        F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 2)
         .otherwise(3).alias("cardstatus"),
        (_digit("o_orderpriority") - 1).alias("IssuanceState"),
        (_digit("o_orderpriority") - 1).alias("MaterialID"))


def card_materials(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("MaterialID"),
                           F.col("r_regionkey").alias("PlasticTypeID"))


def plastic_types(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("PlasticTypeID"))


def pin_sets(t: Tables) -> DataFrame:
    """Pin-set events: accepted line items of the order."""
    return (t.lineitem.where(F.col("l_returnflag") == "A")
            .select(F.col("l_orderkey").alias("cardid"), F.col("l_shipdate").alias("asofdate")))


def status_history(t: Tables) -> DataFrame:
    """Card status history: line items; block reason = line number."""
    return t.lineitem.select(F.col("l_orderkey").alias("cardid"),
                             F.col("l_linenumber").alias("blockreasonid"),
                             F.col("l_shipdate").alias("changeddate"))


def pans(t: Tables) -> DataFrame:
    """Card numbers on file: orders with returned items; 19-character PAN."""
    r = t.lineitem.where(F.col("l_returnflag") == "R")
    return (r.groupBy(F.col("l_orderkey").alias("externalcardid"))
            .agg(F.count(F.lit(1)).alias("_n"))
            .select("externalcardid",
                    F.concat(F.lpad(F.col("externalcardid").cast("string"), 12, "0"),
                             F.lpad(F.col("_n").cast("string"), 7, "0")).alias("PAN")))


def card_requests(t: Tables) -> DataFrame:
    """Card requests: one per order; delivery type = priority digit."""
    return t.orders.select(F.col("o_orderkey").alias("CardRequestID"),
                           F.col("o_orderkey").alias("EntryID"),
                           _digit("o_orderpriority").alias("DeliveryTypeID"),
                           F.col("o_orderdate").alias("CreateDate"),
                           F.col("o_orderdate").alias("LastUpdateDate"))


def request_histories(t: Tables) -> DataFrame:
    """Requests already converted: the finished orders."""
    return t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))


def states(t: Tables) -> DataFrame:
    """State lookup: nations outside region 0 (the rest fall back to 999)."""
    return (t.nation.where(F.col("n_regionkey") != 0)
            .select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("value")))


def conversion_inputs(t: Tables) -> dict[str, DataFrame]:
    """Every input role of the conversion run, from the driver tables."""
    return {
        "master": accounts_master(t), "cards": cards(t), "balances": account_balances(t),
        "deposit_ids": deposit_ids(t), "deposit_usage": deposit_usage(t),
        "goals": goals(t), "applications": applications(t), "fee_plans": fee_plans(t), "states": states(t),
        "pin_sets": pin_sets(t), "status_history": status_history(t),
        "materials": card_materials(t), "plastic_types": plastic_types(t), "pans": pans(t),
        "legacy_mapping": legacy_mapping(t), "card_requests": card_requests(t),
        "request_histories": request_histories(t),
    }


# ---- two snapshots of the sources, for a run that follows another -----------

#: The later run's expiry date, and when its changed orders were changed.
SECOND_EXP_DATE, CHANGED_AT = "2002-06-15", "2001-02-15"
#: The first run's time lies before every change, as its zero balances bear it.
FIRST_AS_OF = CHANGED_FROM + " 00:00:00"
#: Orders up to this price were changed between the two runs.
CHANGED_UP_TO = 100_000


class FirstSnapshot(Tables):
    """The tables before ``CHANGED_FROM``."""

    @property
    def orders(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "orders").where(F.col("o_orderdate") < ntz(CHANGED_FROM))

    @property
    def lineitem(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "lineitem").where(F.col("l_shipdate") < ntz(CHANGED_FROM))


class SecondSnapshot(Tables):
    """All rows; cheap orders of the first snapshot were dated anew and their
    price doubled, and urgent finished ones among them lost their priority (so
    that their accounts no longer qualify)."""

    @property
    def orders(self) -> DataFrame:
        o = read_table(self.spark, self.sf_dir, "orders")
        changed = (F.col("o_orderdate") < ntz(CHANGED_FROM)) & (F.col("o_totalprice") <= CHANGED_UP_TO)
        lost = changed & (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
        return o.select(*[
            F.when(lost, "5-LOW").otherwise(F.col(c)).alias(c) if c == "o_orderpriority" else
            F.when(changed, F.col(c) * 2).otherwise(F.col(c)).alias(c) if c == "o_totalprice" else
            F.when(changed, ntz(CHANGED_AT)).otherwise(F.col(c)).alias(c) if c == "o_orderdate" else F.col(c)
            for c in o.columns])
