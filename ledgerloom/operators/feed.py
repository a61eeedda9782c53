"""Change feed between two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def change_feed(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Keys that were inserted, changed or removed, and the changed columns.

    Both sides are reduced to the key and a 64-bit digest of each column that
    they share, and compared by one full outer join. Returns ``key``, change
    ('inserted', 'changed' or 'removed') and changed_columns (comma-joined in
    the order of ``current``; empty unless changed). The key is taken to be
    unique on each side (``check_unique``); null keys match nothing and come
    as removed and inserted. Null and any value differ.
    """
    columns = [c for c in current.columns if c != key and c in previous.columns]

    def digests(df: DataFrame, name: str) -> DataFrame:
        each = [F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c))) for c in columns]
        return df.select(F.col(key).alias(f"_{name}_key"), F.array(*each).alias(f"_{name}"))

    both = digests(previous, "old").join(digests(current, "new"), F.col("_old_key") == F.col("_new_key"), "full")
    differs = [F.when(~F.col("_old")[i].eqNullSafe(F.col("_new")[i]), F.lit(c)) for i, c in enumerate(columns)]
    change = (F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "removed")
              .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed"))
    return (both.withColumn("change", change).where(F.col("change").isNotNull())
            .select(F.coalesce("_new_key", "_old_key").alias(key), "change",
                    F.when(F.col("change") == "changed", F.concat_ws(",", *differs)).otherwise("").alias("changed_columns")))


def changed_keys(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """The keys that ``change_feed`` gives, without what changed: a row is
    compared by one 64-bit digest of all its shared columns and their nulls."""
    columns = [c for c in current.columns if c != key and c in previous.columns]

    def digest(df: DataFrame, name: str) -> DataFrame:
        row = F.xxhash64(F.lit(0), *[v for c in columns for v in (F.col(c).isNull(), F.col(c))])
        return df.select(F.col(key).alias(f"_{name}_key"), row.alias(f"_{name}"))

    both = digest(previous, "old").join(digest(current, "new"), F.col("_old_key") == F.col("_new_key"), "full")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(F.coalesce("_new_key", "_old_key").alias(key))
