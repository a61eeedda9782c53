"""Qualification, cleaning and ranking of legacy card-holder accounts.

Master rows use the legacy column names: ``entryid``, ``ssn`` (person key),
``firstname``, ``AccountTypeId``, ``accountstatus``, ``provideraccountID``,
``providerkey``, ``dob``, ``activateddate``, ``CreateDate``, ...

J13 qualify_accounts, J14 append_related, J15 drop_closed_zero,
J16 snapshot_diff / mark_closed, J17 junk_filter, J18 contact_rank.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import code_maps as cm
from ledgerloom.functions.exprs import month_end, ntz, person_ok, try_bigint
from ledgerloom.functions.joins import text_join
from ledgerloom.functions.ranking import HOT_GROUP_ROWS, hot_keys, rank_in_groups
from ledgerloom.session import materialize


#: The master's columns that J13, J14 and J15 read.
RULE_COLUMNS = ["entryid", "ssn", "firstname", "AccountTypeId", "accountstatus", "provideraccountID"]
#: Those that tell kept rows from others: the name only decides which keys
#: qualify, and all rows of such a key do.
KEPT_COLUMNS = [c for c in RULE_COLUMNS if c != "firstname"]


def whole_rows(master: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``master`` that are in ``kept`` by its ``RULE_COLUMNS``.

    The rules treat rows that are equal in those columns alike, so this is
    their result for whole rows, and the wide rows are shuffled only here.
    """
    columns = [c for c in RULE_COLUMNS if c in kept.columns]
    alias = [f"_ll_q{i}" for i in range(len(columns))]
    keys = kept.select(*[F.col(c).alias(a) for c, a in zip(columns, alias)])
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(a)) for c, a in zip(columns, alias)])
    return master.join(keys, on, "left_semi")


def qualify_accounts(master: DataFrame, cards: DataFrame, balances: DataFrame,
                     goals: DataFrame | None = None, *, exp_date: str,
                     base_type: int | None = 1, extra_predicate: Column | None = None,
                     unique_key: bool = True, write: bool = False) -> DataFrame:
    """Base accounts with a live card, a non-zero ledger, or a goal with one.

    Branches (each minus sentinel persons):
      a) base accounts with a card whose expiry month ends after ``exp_date``
      b) base accounts whose ledger balance is non-zero
      c) the accounts that goals with a non-zero ledger pay into (any type)
    The union is taken on ``entryid`` only and joined back once, so the
    40-column rows are not shuffled for the DISTINCT; with
    ``unique_key=False`` whole rows are deduplicated as well.
    ``base_type=None`` skips the account-type test. ``write``: the entries paid
    into and the qualifying keys are written first, so that the joins with the
    master are planned by their real sizes and need not shuffle it for few.
    """
    ok = person_ok()
    if extra_predicate is not None:
        ok = ok & extra_predicate
    base = master.where(ok)
    if base_type is not None:
        base = base.where(F.col("AccountTypeId") == F.lit(base_type))

    live_cards = cards.where(
        (F.col("expmonth") > 0) & (F.col("expyear") > 0) & (F.col("externalcardid") > 0)
        & (month_end("expyear", "expmonth") > ntz(exp_date)))
    # key sets are deduplicated first (partial aggregate), so a card holder
    # with very many cards, or an account with many balance rows, is one row
    holders = live_cards.select(F.col("cardholderid").alias("entryid")).distinct()
    a = base.select("entryid").join(holders, "entryid", "left_semi")

    nonzero = balances.where(F.col("UserLedgerBalance") != 0).select(
        F.col("UserAccountID").alias("provideraccountID")).distinct()
    b = base.select("entryid", "provideraccountID").join(
        nonzero, "provideraccountID", "left_semi").select("entryid")

    parts = [a, b]
    if goals is not None:
        goal_accounts = master.select(F.col("entryid").alias("EntryID"), "provideraccountID")
        paying = (goals.select("EntryID", "PayRewardsToEntryID")
                  .join(goal_accounts, "EntryID")
                  # inner (each key once): a semi join would be taken before
                  # the one on the goals, for every account
                  .join(nonzero, "provideraccountID")
                  .select(F.col("PayRewardsToEntryID").alias("entryid")).distinct())
        if write:
            paying = materialize(paying, "paid_entries")
        c = master.where(ok).select("entryid").join(paying, "entryid", "left_semi")
        parts.append(c)
    keys = reduce(DataFrame.unionByName, parts).distinct()
    if write:
        keys = materialize(keys, "qualifying_keys")
    if unique_key:
        return master.join(keys, "entryid", "left_semi")
    # a key may repeat: rows that fail the person test must not come back
    # with another row of their key
    return master.where(ok).join(keys, "entryid", "left_semi").distinct()


def append_related(selected: DataFrame, master: DataFrame, *, person: str = "ssn",
                   type_col: str = "AccountTypeId", type_value=2, key: str = "entryid",
                   seed: DataFrame | None = None, as_text: bool = False, fold: bool = False,
                   write: bool = False) -> DataFrame:
    """Add the ``type_value`` accounts of every person in ``seed``.

    ``as_text``: persons are the same when they differ in trailing blanks only
    (``fold``: or in letter case), as the legacy server compares text.

    ``seed`` defaults to ``selected``. Persons are taken distinct before the
    semi join, and the result is deduplicated on ``key`` (a related account
    that already qualified is not added twice). ``write``: ``selected`` is
    read three times, so a costly one is written first.
    """
    if write:
        selected = materialize(selected, "selected_accounts")
    persons = (seed if seed is not None else selected).select(person).distinct()
    related = master.where(F.col(type_col) == F.lit(type_value))
    if as_text or fold:
        related = text_join(related, persons, (person, person), "left_semi", fold=fold)
    else:
        related = related.join(persons, person, "left_semi")
    related = related.join(selected.select(key), key, "left_anti")
    return selected.unionByName(related.select(*selected.columns))


def drop_closed_zero(accounts: DataFrame, balances: DataFrame, *,
                     closed_status: int = cm.CLOSED_ACCOUNT_STATUS) -> DataFrame:
    """Remove closed accounts with no balance row or a zero/zero row.

    The balance side is reduced to one flag per account first (partial
    aggregate), so an account with many balance rows is not fanned out.
    """
    zero = ((F.coalesce(F.col("UserAvailableBalance"), F.lit(0)) == 0)
            & (F.coalesce(F.col("UserLedgerBalance"), F.lit(0)) == 0))
    flags = (balances.groupBy(F.col("UserAccountID").alias("provideraccountID"))
             .agg(F.max(zero.cast("int")).alias("_has_zero")))
    joined = accounts.join(flags, "provideraccountID", "left")
    doomed = ((F.col("accountstatus") == F.lit(closed_status))
              & F.coalesce(F.col("_has_zero") == 1, F.lit(True)))
    return joined.where(~F.coalesce(doomed, F.lit(False))).select(*accounts.columns)


def snapshot_diff(previous: DataFrame, current: DataFrame, *, key: str = "entryid") -> DataFrame:
    """Keys in the previous run that are not in this one."""
    return previous.select(key).distinct().join(current.select(key).distinct(), key, "left_anti")


def mark_closed(target: DataFrame, keys: DataFrame, *, key: str = "Id", keys_col: str = "entryid",
                column: str = "Status", value=cm.CLOSED_TARGET_STATUS) -> DataFrame:
    """Set ``column = value`` on target rows whose key is in ``keys``."""
    flagged = keys.select(F.col(keys_col).alias(key)).distinct().withColumn("_close", F.lit(True))
    joined = target.join(flagged, key, "left")
    out = F.when(F.col("_close"), F.lit(value).cast(target.schema[column].dataType)
                 ).otherwise(F.col(column))
    return joined.select(*[out.alias(c) if c == column else F.col(c) for c in target.columns])


def _junk_reason() -> Column:
    pk = F.trim(F.col("providerkey"))
    bad_key = (F.coalesce(pk == F.lit(""), F.lit(False))
               | try_bigint(F.col("providerkey")).isNull())
    return (F.when(F.col("dob").isNull(), F.lit("dob_missing"))
            .when(bad_key, F.lit("provider_key")))


def junk_filter(accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop rows without birth date or with a non-integer provider key.

    Returns ``(kept, rejected)``; ``rejected`` carries ``reason``
    ('dob_missing' checked first, then 'provider_key').
    """
    tagged = accounts.withColumn("reason", _junk_reason())
    kept = tagged.where(F.col("reason").isNull()).drop("reason")
    rejected = tagged.where(F.col("reason").isNotNull())
    return kept, rejected


CONTACT_ORDER = [("AccountTypeId", False), ("accountstatus", False),
                 ("activateddate", True), ("CreateDate", False)]


def contact_rank(accounts: DataFrame, *, person: str = "ssn", order=CONTACT_ORDER,
                 tie_key: str = "entryid", strategy: str = "auto",
                 hot_group_rows: int = HOT_GROUP_ROWS, persons: DataFrame | None = None,
                 apart: str | None = None) -> DataFrame:
    """``ContactRank`` = row number per person; ``tie_key`` makes it total.

    Persons can be very uneven (a dummy person key may hold a large share of
    the rows), so hot persons are split by the ``auto`` ranking strategy.
    ``persons``: a narrow frame with the person of every account (or of more
    accounts), to count the hot ones on. ``apart``: a column whose values are
    ranked apart from each other.
    """
    hot, keys = False, [person] if apart is None else [person, apart]
    if strategy == "auto" and persons is not None:
        hot = hot_keys(persons.select(person), [person], hot_group_rows)
        if isinstance(hot, DataFrame) or hot:
            accounts = materialize(accounts, "accounts_to_rank")
            if apart is not None:
                hot = hot_keys(accounts, keys, hot_group_rows)
    return rank_in_groups(accounts, keys, list(order) + [(tie_key, False)], "ContactRank",
                          strategy=strategy, hot_group_rows=hot_group_rows, hot=hot)


def rank_kept(accounts: DataFrame, *, person: str = "ssn", order=CONTACT_ORDER, tie_key: str = "entryid",
              hot_group_rows: int = HOT_GROUP_ROWS, persons: DataFrame) -> DataFrame:
    """J17 and J18 at once: every row of ``accounts`` with the ``ContactRank``
    that ``contact_rank`` gives among the rows that ``junk_filter`` keeps, null
    for a rejected row. Both sets can then be read from one written table.
    ``persons`` as for ``contact_rank``.
    """
    tagged = accounts.withColumn("_ll_junk", _junk_reason().isNotNull())
    return contact_rank(tagged, person=person, order=order, tie_key=tie_key, hot_group_rows=hot_group_rows,
                        persons=persons, apart="_ll_junk").withColumn(
        "ContactRank", F.when(~F.col("_ll_junk"), F.col("ContactRank"))).drop("_ll_junk")
