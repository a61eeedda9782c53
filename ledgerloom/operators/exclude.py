"""Exclusion lists: accounts and card holders that cannot be converted.

J33 exclusions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize


def exclusions(ranked: DataFrame, cards: DataFrame, pans: DataFrame,
               cardholders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accounts_without_pan, cardholders_without_pan)``.

    a) accounts whose active card has no non-NULL card number on file;
    b) distinct card holders whose id is the provider key of an account in a);
    c) every other account of those card holders' persons, added to a).
    All steps are semi/anti joins on distinct key sets, so a person with
    many accounts is never paired row by row. ``entryid`` is the accounts'
    key.
    """
    with_pan = (cards.select("cardid", "externalcardid")
                .join(pans.where(F.col("PAN").isNotNull()).select("externalcardid").distinct(),
                      "externalcardid", "left_semi")
                .select(F.col("cardid").alias("ActiveCardID")).distinct())
    # the anti join is evaluated once, on keys: three later steps read it
    a = materialize(ranked.select("entryid", "providerkey", "ActiveCardID")
                    .join(with_pan, "ActiveCardID", "left_anti")
                    .select("entryid", "providerkey"), "accounts_without_pan")
    # the provider key is text; a value that is not a number matches no id
    keys = a.select(F.col("providerkey").try_cast("bigint").alias("Id")).distinct()
    b = cardholders.join(keys, "Id", "left_semi").distinct()
    persons = (cardholders.join(keys, "Id", "left_semi")
               .select(F.col("Ssn_Number").alias("ssn")).distinct())
    # a) and c) together: accounts of a), or of a person of b)
    listed = (a.select("entryid").unionByName(
        ranked.select("entryid", "ssn").join(persons, "ssn", "left_semi").select("entryid")).distinct())
    return ranked.join(listed, "entryid", "left_semi"), b
