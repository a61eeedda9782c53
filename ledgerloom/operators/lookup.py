"""Deposit-id lookup: one deposit id per account, kept across runs.

J19 best_id_lookup. (J23 latest_per_key lives in ``incremental``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.exprs import to_utc
from ledgerloom.operators import prune

LOOKUP_COLUMNS = ["entryid", "ShortDepositId", "FullDepositID", "EncryptedDepositID", "CreateDate"]


def best_id_lookup(master: DataFrame, child: DataFrame, usage: DataFrame,
                   existing_lookup: DataFrame | None = None, *,
                   tie_keys=("EncryptedDepositID", "createdate")) -> DataFrame:
    """Rows to append to the lookup.

    Entries of the master: the most used id (ties: highest id, then
    ``tie_keys``), which is the only one of a single-id entry. Entries
    already in the lookup are left alone (insert-only). Both parts get the
    creation time in UTC (the legacy text converted only the first part).
    The best row is taken before any join on the entry, so that a hot entry
    sends one row per map task.
    """
    in_master = master.select(F.col("entryid").alias(prune.KEY)).distinct()
    rows = prune.best_per_entry(child, usage, tie_keys).join(in_master, prune.KEY, "left_semi")
    if existing_lookup is not None:
        present = existing_lookup.select(F.col("entryid").alias(prune.KEY)).distinct()
        rows = rows.join(present, prune.KEY, "left_anti")
    return rows.select(F.col(prune.KEY).alias("entryid"),
                       F.col("ShortDepositID").alias("ShortDepositId"),
                       "FullDepositID", "EncryptedDepositID",
                       to_utc("createdate").alias("CreateDate"))
