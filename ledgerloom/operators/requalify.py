"""J13-J15 from changes only.

``qualification`` gives the state of a full evaluation; ``requalify`` takes the
state of the previous run and the keys that changed since, evaluates the rules
for the affected accounts alone and takes the other rows over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.exprs import month_end, ntz
from ledgerloom.operators import qualify
from ledgerloom.operators.feed import changed_keys
from ledgerloom.session import materialize

RELATED_TYPE = 2


def qualification(master: DataFrame, cards: DataFrame, balances: DataFrame, goals: DataFrame | None, *,
                  exp_date: str) -> DataFrame:
    """J13 and J14 with flags: ``base`` (qualifies by itself) and ``stays``
    (J15 does not drop it)."""
    base = qualify.qualify_accounts(master, cards, balances, goals, exp_date=exp_date)
    both = qualify.append_related(base.withColumn("base", F.lit(True)), master.withColumn("base", F.lit(False)))
    return _with_stays(both, balances)


def _with_stays(rows: DataFrame, balances: DataFrame) -> DataFrame:
    stays = qualify.drop_closed_zero(rows.select("entryid", "provideraccountID", "accountstatus"), balances)
    return rows.join(stays.select("entryid", F.lit(True).alias("_stays")), "entryid", "left").withColumn(
        "stays", F.coalesce("_stays", F.lit(False))).drop("_stays")


def qualifying(state: DataFrame) -> DataFrame:
    return state.where("stays").drop("base", "stays")


def _keys(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.toDF("entryid") for p in parts]).where(F.col("entryid").isNotNull()).distinct()


def source_changes(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Changed keys of each source between two snapshots, by their change
    feeds: master (entryid), cards (holders, old and new), balances (provider
    accounts), goals (goal and paid accounts, old and new)."""
    def rows(role: str, key: str) -> DataFrame:
        changed = materialize(changed_keys(before[role], after[role], key), f"changed_keys_{role}")
        return before[role].join(changed, key, "left_semi").unionByName(after[role].join(changed, key, "left_semi"))

    out = {"master": changed_keys(before["master"], after["master"], "entryid"),
           "cards": rows("cards", "cardid").select("cardholderid"),
           "balances": rows("balances", "TransactionID").select("UserAccountID")}
    if "goals" in after:
        out["goals"] = rows("goals", "EntryID").select("PayRewardsToEntryID")
    return {role: materialize(df.distinct(), f"changed_{role}") for role, df in out.items()}


def requalify(state: DataFrame, master: DataFrame, cards: DataFrame, balances: DataFrame, goals: DataFrame | None, *,
              changed: dict[str, DataFrame], exp_date: str, previous_exp_date: str) -> DataFrame:
    """The state after the changes, equal to ``qualification`` of all rows.

    ``state``: the previous state; ``changed``: as ``source_changes`` gives.
    Accounts whose master row, card, balance or goal changed, or that had a
    card expire between the two dates, are evaluated again; so are the related
    accounts of the persons among them. Sources are read through semi joins on
    those keys, and nothing else is shuffled.
    """
    accounts = master.select("entryid", "provideraccountID")
    moved = changed["balances"].toDF("provideraccountID")
    by_balance = materialize(accounts.join(moved, "provideraccountID", "left_semi").select("entryid"), "moved_accounts")
    ends = month_end("expyear", "expmonth")
    dated = cards.where((F.col("expmonth") > 0) & (F.col("expyear") > 0))
    first, last = sorted((exp_date, previous_exp_date))  # ISO dates sort as text
    expired = dated.where((ends > ntz(first)) & (ends <= ntz(last))).select("cardholderid")
    parts = [changed["master"], changed["cards"], expired, by_balance]
    if goals is not None:
        # a goal's balance, and a goal's own master row, count for the account it pays into
        source = _keys(by_balance, changed["master"]).toDF("EntryID")
        parts += [changed["goals"], goals.join(source, "EntryID", "left_semi").select("PayRewardsToEntryID")]
    affected = materialize(_keys(*parts), "affected_accounts")

    # J13 for the affected accounts, with the goals that pay into them
    needed, paying = affected, None
    if goals is not None:
        paying = goals.join(affected.toDF("PayRewardsToEntryID"), "PayRewardsToEntryID", "left_semi")
        needed = _keys(affected, paying.select("EntryID"))
    some = materialize(master.join(needed, "entryid", "left_semi"), "affected_master")
    some_balances = balances.join(some.select(F.col("provideraccountID").alias("UserAccountID")).distinct(), "UserAccountID", "left_semi")
    some_cards = cards.join(affected.toDF("cardholderid"), "cardholderid", "left_semi")
    base = qualify.qualify_accounts(some, some_cards, some_balances, paying, exp_date=exp_date)
    base = materialize(base.join(affected, "entryid", "left_semi"), "base_again")

    # J14 for the persons among them, before and after
    before = state.join(affected, "entryid", "left_semi")
    persons = materialize(before.select("ssn").unionByName(some.select("ssn")).distinct(), "affected_persons")
    kept_base = state.where("base").join(affected, "entryid", "left_anti")
    candidates = master.where(F.col("AccountTypeId") == RELATED_TYPE).join(persons, "ssn", "left_semi")
    supported = kept_base.select("ssn").unionByName(base.select("ssn")).join(persons, "ssn", "left_semi").distinct()
    related = (candidates.join(supported, "ssn", "left_semi").join(base.select("entryid"), "entryid", "left_anti")
               .join(kept_base.select("entryid"), "entryid", "left_anti"))
    again = materialize(base.withColumn("base", F.lit(True)).unionByName(related.withColumn("base", F.lit(False)).select(*base.columns, "base")),
                        "qualified_again")

    # J15 for all of these; the others are taken over
    money = balances.join(again.select(F.col("provideraccountID").alias("UserAccountID")).distinct(), "UserAccountID", "left_semi")
    gone = _keys(affected, state.where("not base").join(persons, "ssn", "left_semi").select("entryid"))
    rest = state.join(gone, "entryid", "left_anti")
    return rest.unionByName(_with_stays(again, money).select(*rest.columns))
