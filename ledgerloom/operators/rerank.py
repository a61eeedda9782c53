"""Ranks kept up to date (J09, J18): the groups that changed are ranked again,
the stored ranks of the others are taken over.

A changed group is found by comparing its rows' count and the sum of their
64-bit digests in both versions of the table: one map-side aggregate for each
version and one join of a narrow row for each group. Rows of other groups are
neither sorted nor ranked; they pass an anti join on the changed groups.
Null groups are groups like any other; columns may come in another order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.prune import KEY, usage_rank
from ledgerloom.operators.qualify import contact_rank
from ledgerloom.session import materialize


def changed_groups(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """Values of ``group`` (one column) whose rows differ between the versions,
    those that came or went included. Both have the same columns."""
    columns = sorted(after.columns)
    if columns != sorted(before.columns):
        raise ValueError("the two versions differ in their columns")

    def summed(df: DataFrame, side: str) -> DataFrame:
        # nulls leave a digest as it is, so each column's null flag goes in too
        row = F.xxhash64(*[v for c in columns for v in (F.col(c).isNull(), F.col(c))])
        return df.groupBy(F.col(group).alias(f"_{side}")).agg(
            F.count(F.lit(1)).alias(f"_{side}_n"), F.sum(row.cast("decimal(20,0)")).alias(f"_{side}_sum"))

    both = summed(before, "old").join(summed(after, "new"), F.col("_old").eqNullSafe(F.col("_new")), "full")
    same = F.col("_old_n").eqNullSafe(F.col("_new_n")) & F.col("_old_sum").eqNullSafe(F.col("_new_sum"))
    return both.where(~same).select(F.coalesce("_new", "_old").alias(group))


def of_groups(df: DataFrame, group: str, groups: DataFrame, *, others: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``group`` is in ``groups`` (``others``: is not)."""
    wanted = groups.select(F.col(groups.columns[0]).alias("_group"))
    return df.join(wanted, F.col(group).eqNullSafe(F.col("_group")), "left_anti" if others else "left_semi")


def replace_groups(stored: DataFrame, fresh: DataFrame, group: str, groups: DataFrame) -> DataFrame:
    """``stored`` with the rows of ``groups`` replaced by ``fresh``."""
    return of_groups(stored, group, groups, others=True).unionByName(fresh.select(*stored.columns))


def contact_rerank(stored: DataFrame, before: DataFrame, after: DataFrame, *, person: str = "ssn", **ranking) -> DataFrame:
    """J18 of ``after`` from ``stored``, the ranks of ``before``.

    ``ranking`` goes to ``contact_rank`` for the changed persons.
    """
    groups = materialize(changed_groups(before, after, person), "changed_persons")
    fresh = contact_rank(of_groups(after, person, groups), person=person, **ranking)
    return replace_groups(stored, fresh, person, groups)


def changed_entries(before: tuple[DataFrame, DataFrame, DataFrame], after: tuple[DataFrame, DataFrame, DataFrame], *,
                    key: str = "entryid", id: str = "EncryptedDepositID", account: str = "dfiaccountno") -> DataFrame:
    """Entries whose ranks may differ between two versions of (master, child,
    usage): their master rows or ids changed, or the use of one of their ids."""
    (old_master, old_child, old_usage), (master, child, usage) = before, after
    used = changed_groups(old_usage.select(account), usage.select(account), account)
    touched = [
        changed_groups(old_master.select(key), master.select(key), key).select(F.col(key).alias(KEY)),
        changed_groups(old_child, child, KEY),
        # an id that left the child changed its entry already
        child.join(used, F.col(id) == F.col(account), "left_semi").select(KEY)]
    return reduce(DataFrame.unionByName, touched).distinct()


def usage_rerank(stored: DataFrame, before: tuple[DataFrame, DataFrame, DataFrame], after: tuple[DataFrame, DataFrame, DataFrame], *,
                 key: str = "entryid", id: str = "EncryptedDepositID", account: str = "dfiaccountno", **ranking) -> DataFrame:
    """J09 of ``after`` = (master, child, usage) from ``stored``, the ranks of
    ``before``. Uses are counted for the ids of changed entries alone."""
    master, child, usage = after
    groups = materialize(changed_entries(before, after, key=key, id=id, account=account), "changed_entries")
    rows = materialize(of_groups(child, KEY, groups), "changed_ids")  # counted, joined and ranked below
    uses = usage.join(rows.select(F.col(id).alias("_used")).distinct(), F.col(account) == F.col("_used"), "left_semi")
    fresh = usage_rank(of_groups(master, key, groups), rows, uses, key=key, **ranking)
    return replace_groups(stored, fresh, KEY, groups)
