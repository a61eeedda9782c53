"""Ranked duplicate pruning: thin an entry's deposit ids by use and id rank.

Roles (column names are the contract):
  master  ``entryid``
  child   ``Entryid``, ``FullDepositID``, ``EncryptedDepositID`` (+ any others)
  usage   ``dfiaccountno`` (one row per use of a deposit id)

J07 multi_key_entries, J08 usage_count, J09 usage_rank, J10 prune_unused,
J11 prune_less_used, J12 keep_best.

The delete predicates only ask whether a row's rank is 1, and a dense rank is
1 exactly when the value equals the group's best value. So J10-J12 compare
each row with per-entry maxima from one partial aggregate (a hot entry is
pre-aggregated map-side) instead of sorting whole entries in one task.
J09, which must output the ranks themselves, uses the range-split ranking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ranking import HOT_GROUP_ROWS, first_per_group, hot_keys, ranks_in_groups
from ledgerloom.session import materialize

KEY = "Entryid"
ID = "FullDepositID"
USED = "DDID_Used"


def multi_key_entries(master: DataFrame, child: DataFrame, *, key: str = "entryid",
                      child_key: str = KEY) -> DataFrame:
    """Entries with more than one (master row x child row) pair.

    Counted as product of per-key counts on both sides, which is what the
    grouped join counts, without materialising the join.
    """
    c = child.groupBy(F.col(child_key).alias(KEY)).agg(F.count(F.lit(1)).alias("_n_child"))
    m = master.groupBy(F.col(key).alias(KEY)).agg(F.count(F.lit(1)).alias("_n_master"))
    return (c.join(m, KEY).where(F.col("_n_child") * F.col("_n_master") > 1).select(KEY))


def usage_count(child: DataFrame, usage: DataFrame, *, id: str = "EncryptedDepositID",
                account: str = "dfiaccountno") -> DataFrame:
    """Child rows + how often their id is used (NULL when never)."""
    counts = usage.groupBy(F.col(account).alias("_acc")).agg(F.count(F.lit(1)).alias(USED))
    return (child.join(counts, child[id] == counts["_acc"], "left").drop("_acc"))


def _entry_stats(used: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Per multi-id entry: best use count and highest id (one aggregate)."""
    per_entry = used.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n_child"),
                                      F.max(USED).alias("_max_used"),
                                      F.max(ID).alias("_max_id"))
    m = master.groupBy(F.col(key).alias(KEY)).agg(F.count(F.lit(1)).alias("_n_master"))
    return (per_entry.join(m, KEY)
            .where(F.col("_n_child") * F.col("_n_master") > 1)
            .select(KEY, "_max_used", "_max_id", F.lit(True).alias("_multi")))


def _use_rank_is_1() -> F.Column:
    # dense_rank(order by used desc nulls last) = 1: the best count, or all NULL
    return F.col("_max_used").isNull() | F.coalesce(F.col(USED) == F.col("_max_used"),
                                                    F.lit(False))


def _id_rank_above_1() -> F.Column:
    # dense_rank(order by id desc nulls last) > 1: not the highest id
    return (F.coalesce(F.col(ID) < F.col("_max_id"), F.lit(False))
            | (F.col(ID).isNull() & F.col("_max_id").isNotNull()))


def _flag(child: DataFrame, master: DataFrame, usage: DataFrame, key: str) -> DataFrame:
    # a child that already carries its use count (J10 with keep_usage) is not
    # recounted: the usage table does not change between the two deletes
    used = child if USED in child.columns else usage_count(child, usage)
    stats = _entry_stats(used, master, key)
    return used.join(stats, KEY, "left")


def usage_rank(master: DataFrame, child: DataFrame, usage: DataFrame, *,
               key: str = "entryid", strategy: str = "auto",
               hot_group_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Rows of multi-id entries with UseRank and DDIDRank (dense ranks)."""
    used = usage_count(child, usage)
    multi = multi_key_entries(master, child, key=key)
    rows = used.join(multi, KEY, "left_semi")
    # both ranks share the key: its counts are taken once, on the child's key alone
    hot = hot_keys(child.select(KEY), [KEY], hot_group_rows) if strategy == "auto" else []
    if strategy == "range" or isinstance(hot, DataFrame) or hot:
        rows = materialize(rows, "used_ids")  # read by the cold and the hot branch, and by each rank of the latter
    return ranks_in_groups(rows, [KEY], {"UseRank": [(USED, True)], "DDIDRank": [(ID, True)]}, method="dense_rank",
                           strategy=strategy, hot_group_rows=hot_group_rows, hot=hot)


def _out_cols(child: DataFrame, keep_usage: bool):
    cols = [c for c in child.columns if c != USED]
    return cols + [USED] if keep_usage else cols


def _survivors(flagged: DataFrame, delete: F.Column, child_cols, literal: bool) -> DataFrame:
    delete = F.coalesce(F.col("_multi") & delete, F.lit(False))
    if not literal:
        return flagged.where(~delete).select(*child_cols)
    # As written: the delete joins back on the entry only, so one flagged row
    # removes every row of its entry.
    doomed = flagged.where(delete).select(KEY).distinct()
    return flagged.join(doomed, KEY, "left_anti").select(*child_cols)


def prune_unused(master: DataFrame, child: DataFrame, usage: DataFrame, *,
                 key: str = "entryid", literal: bool = False,
                 keep_usage: bool = False) -> DataFrame:
    """Drop never-used ids that are not the entry's highest id.

    ``keep_usage=True`` keeps the ``DDID_Used`` column so J11 can reuse it.
    """
    flagged = _flag(child, master, usage, key)
    delete = F.col(USED).isNull() & _id_rank_above_1()
    return _survivors(flagged, delete, _out_cols(child, keep_usage), literal)


def prune_less_used(master: DataFrame, child: DataFrame, usage: DataFrame, *,
                    key: str = "entryid", literal: bool = False) -> DataFrame:
    """Drop rows with UseRank > 1, or UseRank = 1 and DDIDRank > 1.

    Ranks are taken on ``child`` as given (the output of J10).
    """
    flagged = _flag(child, master, usage, key)
    use1 = _use_rank_is_1()
    delete = ~use1 | _id_rank_above_1()
    return _survivors(flagged, delete, _out_cols(child, False), literal)


def best_per_entry(child: DataFrame, usage: DataFrame, tie_keys) -> DataFrame:
    """Per entry its most used id (ties: highest id, then ``tie_keys``).

    The limit stands before any join on the entry, so that each map task
    sends one row of a hot entry (partial WindowGroupLimit below the
    exchange on the entry).
    """
    used = child if USED in child.columns else usage_count(child, usage)
    order = [(USED, True), (ID, True)] + [(c, True) for c in tie_keys]
    return first_per_group(used, [KEY], order).select(*_out_cols(child, False))


def keep_best(master: DataFrame, child: DataFrame, usage: DataFrame, *,
              key: str = "entryid", tie_keys=("EncryptedDepositID", "createdate")) -> DataFrame:
    """One id per multi-id entry: most used, then highest id.

    An entry of the master keeps its best row (its only one, when it has a
    single id); rows of entries without a master row are kept as they are.
    """
    cols = _out_cols(child, False)
    entries = master.select(F.col(key).alias(KEY)).distinct()
    best = best_per_entry(child, usage, tie_keys).join(entries, KEY, "left_semi")
    rest = child.select(*cols).join(entries, KEY, "left_anti")
    return best.select(*cols).unionByName(rest.select(*cols))
