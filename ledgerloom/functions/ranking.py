"""Ranking within groups that survives a hot group.

``Window.partitionBy(k)`` sends every row of a key to one task. When one key
holds a third of the data, that task holds a third of the data. The default
``auto`` strategy first counts rows per key (one partial aggregate) and
sends only the keys above ``HOT_GROUP_ROWS`` through the ``range`` plan,
which splits such a group:

1. ``repartitionByRange`` on (keys, order): the sampled bounds cut a hot key
   over several partitions; rows with identical sort keys stay together.
2. Inside each sorted partition ``monotonically_increasing_id`` follows the
   sort order, so (row id - first row id of the key in that partition) is
   the local position.
3. A small aggregate per (partition, key) gives the first row id and the row
   count; a window over that small table (at most one row per partition for
   any key) sums the counts of the key in earlier partitions.
4. Join back on (partition, key): the hot key is spread over its partitions,
   so the join is balanced; when only hot keys take this path the small
   stats table is broadcast and the numbered rows are not shuffled again.

The numbered rows are written to the checkpoint folder between 2 and 3: the stats and the join
must read the same partition bounds, and a second evaluation of the range
exchange could sample different ones.

Dense rank: rows with equal sort keys lie together in one partition, so each
sorted partition counts its own values as its rows pass (an Arrow batch at a
time), and only a key that goes on from an earlier partition needs an offset:
at most one per partition, broadcast. The rows themselves are shuffled once.
Where a column's type does not allow that, it is the row number over the
distinct (keys, order values), joined back on those values. Ties keep their order only if the caller adds a unique
last key, which every job here does.

Order is given as ``[(column, descending), ...]`` with NULLs lowest (first
ascending, last descending), the SQL Server default.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import materialize

OrderSpec = Sequence[tuple[str, bool]]


def sort_columns(order: OrderSpec) -> list[Column]:
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first()
            for c, desc in order]


def _null_safe_on(left: DataFrame, right: DataFrame, pairs) -> Column:
    return reduce(lambda a, b: a & b,
                  [left[lc].eqNullSafe(right[rc]) for lc, rc in pairs])


def _window_rank(df, keys, order, out, method):
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    fn = F.row_number() if method == "row_number" else F.dense_rank()
    return df.withColumn(out, fn.over(w).cast("bigint"))


def _range_row_number(df: DataFrame, keys, order, out, partitions: int,
                      small_stats: bool = False) -> DataFrame:
    sort = [F.col(k).asc_nulls_first() for k in keys] + sort_columns(order)
    ordered = (df.repartitionByRange(partitions, *sort)
               .sortWithinPartitions(*sort)
               .withColumn("_ll_rid", F.monotonically_increasing_id())
               .withColumn("_ll_pid", F.spark_partition_id()))
    # Both branches below must see the same partition bounds and row ids;
    # re-running the range exchange may sample different bounds, so the
    # numbered rows are written once as a table in the shared checkpoint
    # folder (computed once, survives executor loss).
    ordered = materialize(ordered, "ranked")
    key_alias = [f"_ll_k{i}" for i in range(len(keys))]
    stats = (ordered.groupBy("_ll_pid", *keys)
             .agg(F.min("_ll_rid").alias("_ll_first"), F.count(F.lit(1)).alias("_ll_cnt")))
    earlier = Window.partitionBy(*keys).orderBy("_ll_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    stats = stats.withColumn("_ll_before", F.coalesce(F.sum("_ll_cnt").over(earlier), F.lit(0)))
    stats = stats.select(F.col("_ll_pid").alias("_ll_spid"),
                         *[F.col(k).alias(a) for k, a in zip(keys, key_alias)],
                         "_ll_first", "_ll_before")
    if small_stats:
        # only hot keys here: at most one stats row per range partition plus
        # one per hot key, a known bound, so the numbered rows stay in place
        stats = F.broadcast(stats)
    on = (ordered["_ll_pid"] == stats["_ll_spid"]) & _null_safe_on(
        ordered, stats, list(zip(keys, key_alias)))
    joined = ordered.join(stats, on, "inner")
    rank = (F.col("_ll_before") + F.col("_ll_rid") - F.col("_ll_first") + 1).cast("bigint")
    return joined.withColumn(out, rank).drop(
        "_ll_rid", "_ll_pid", "_ll_spid", "_ll_first", "_ll_before", *key_alias)


# Types whose equality is the same in Arrow as in Spark; others may be carried.
_COUNTED = (T.IntegralType, T.BooleanType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
_CARRIED = (*_COUNTED, T.StringType, T.FractionalType)


def _counted(kind: T.DataType) -> bool:
    return isinstance(kind, _COUNTED) or kind == T.StringType()  # text without a collation


def _count_values(keys: list[str], values: list[str], out: str) -> Callable:
    """For sorted rows: numbers the distinct ``values`` of each of the ``keys``
    from 1, in the column ``out``."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, number = None, 0  # the row before the batch, and its number

        def changed(batch, columns):
            """Of each row, whether it differs from the one before."""
            flags = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                here = batch.column(c)
                before = here.slice(0, batch.num_rows - 1)
                before = pa.concat_arrays([here.slice(0, 1) if last is None else last.column(c), before])
                differ = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(here.is_null(), before.is_null()))
                flags |= differ.to_numpy(zero_copy_only=False)
            return flags

        for batch in batches:
            if not batch.num_rows:
                continue
            new_key = changed(batch, keys)
            new_value = changed(batch, values) | new_key
            if last is None:
                new_key[0] = new_value[0] = True
            runs = number + np.cumsum(new_value)
            # the runs before the latest new key: of this batch, or none where its key goes on
            start = np.maximum.accumulate(np.where(new_key, runs - 1, 0))
            numbers = (runs - start).astype(np.int64)
            number, last = int(numbers[-1]), batch.slice(batch.num_rows - 1, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], names=[*batch.schema.names, out])
    return run


def _range_dense_rank(df: DataFrame, keys, order, out, partitions: int) -> DataFrame:
    sort = [F.col(k).asc_nulls_first() for k in keys] + sort_columns(order)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields] + [T.StructField("_ll_value", T.LongType())])
    # written once, as the bounds of another evaluation may differ
    ordered = materialize(df.repartitionByRange(partitions, *sort).sortWithinPartitions(*sort)
                          .mapInArrow(_count_values(keys, [c for c, _ in order], "_ll_value"), schema)
                          .withColumn("_ll_pid", F.spark_partition_id()), "ranked")
    key_alias = [f"_ll_k{i}" for i in range(len(keys))]
    earlier = Window.partitionBy(*key_alias).orderBy("_ll_spid").rowsBetween(Window.unboundedPreceding, -1)
    stats = (ordered.groupBy(F.col("_ll_pid").alias("_ll_spid"), *[F.col(k).alias(a) for k, a in zip(keys, key_alias)])
             .agg(F.max("_ll_value").alias("_ll_cnt")).withColumn("_ll_before", F.sum("_ll_cnt").over(earlier))
             .where(F.col("_ll_before").isNotNull()).drop("_ll_cnt"))  # one a partition at most: its first key
    stats = F.broadcast(materialize(stats, "ranked_before"))
    on = (ordered["_ll_pid"] == stats["_ll_spid"]) & _null_safe_on(ordered, stats, list(zip(keys, key_alias)))
    rank = F.col("_ll_value") + F.coalesce(F.col("_ll_before"), F.lit(0))
    return ordered.join(stats, on, "left").select(*df.columns, rank.alias(out))


# A group above this many rows is "hot": one task would sort it alone.
HOT_GROUP_ROWS = 2_000_000
# At most this many hot keys are collected (a third of 10^12 rows in groups
# of 2*10^6 rows is far below it); beyond it they are kept as a table.
MAX_HOT_KEYS = 10_000
# Largest per-partition stats table that is broadcast in the hot-key path.
MAX_STATS_ROWS = 1_000_000


def _range_rank(df, keys, order, out, method, n, small_stats=False):
    if method == "row_number":
        return _range_row_number(df, keys, order, out, n, small_stats)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if (all(isinstance(kind, _CARRIED) for kind in kinds.values())
            and all(_counted(kinds.get(c)) for c in [*keys, *[c for c, _ in order]])):
        return _range_dense_rank(df, keys, order, out, n)
    # dense rank = row number over distinct (keys, order values)
    value_cols = [c for c, _ in order]
    distinct = df.select(*keys, *value_cols).distinct()
    ranked = _range_row_number(distinct, keys, order, out, n, small_stats)
    cols = keys + value_cols
    alias = [f"_ll_v{i}" for i in range(len(cols))]
    ranked = ranked.select(*[F.col(c).alias(a) for c, a in zip(cols, alias)], out)
    joined = df.join(ranked, _null_safe_on(df, ranked, list(zip(cols, alias))), "inner")
    return joined.drop(*alias)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_group_rows: int = HOT_GROUP_ROWS,
             max_keys: int = MAX_HOT_KEYS) -> list | DataFrame:
    """Keys with more than ``hot_group_rows`` rows, each with its count
    ``_ll_n`` (one partial aggregate).

    When there are more than ``max_keys`` of them they come as a written
    table, so what reaches the driver is bounded.
    """
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ll_n"))
           .where(F.col("_ll_n") > hot_group_rows))
    rows = hot.limit(max_keys + 1).collect()
    return materialize(hot, "hot_keys") if len(rows) > max_keys else rows


def _range_partitions(rows: int, hot_group_rows: int, least: int) -> int:
    """As many that no task gets more than a hot group's worth of rows; a low
    threshold (groups that a task takes easily) makes no more of them."""
    return max(least, -(-rows // max(hot_group_rows, HOT_GROUP_ROWS)))


def rank_in_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: OrderSpec,
    out: str,
    **options,
) -> DataFrame:
    """Add ``out`` = row_number / dense_rank within ``keys`` by ``order``.
    ``options``: those of ``ranks_in_groups``."""
    return ranks_in_groups(df, keys, {out: order}, **options)


def ranks_in_groups(
    df: DataFrame,
    keys: Sequence[str],
    orders: dict[str, OrderSpec],
    *,
    method: str = "row_number",
    strategy: str = "auto",
    partitions: int | None = None,
    hot_group_rows: int = HOT_GROUP_ROWS,
    hot: list | DataFrame | bool = False,
) -> DataFrame:
    """Add each ``out`` of ``orders`` = row_number / dense_rank within ``keys``
    by its order. Ordinary and hot keys are told apart once for all of them.

    strategy "window": one plain window (groups known to be small);
    "range": the hot-group-safe plan of the module docstring for all rows;
    "auto": find the hot keys first; rows of ordinary keys get the plain
    window, rows of hot keys (a broadcast set of bounded size, or a table)
    the range plan. With no hot key this is one aggregate plus the plain
    window.

    ``hot``: what ``hot_keys`` gave on a narrower frame with the same keys
    (or more rows of them), so that the keys are counted once and without
    evaluating ``df``. A frame with hot keys is read by both branches: callers
    whose ``df`` is costly materialize it first.
    """
    keys = list(keys)
    if method not in ("row_number", "dense_rank"):
        raise ValueError(method)

    def ranked(rank: Callable[..., DataFrame], rows: DataFrame, *more) -> DataFrame:
        return reduce(lambda d, out: rank(d, keys, orders[out], out, method, *more), orders, rows)

    if strategy == "window":
        return ranked(_window_rank, df)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if strategy == "range":
        return ranked(_range_rank, df, n)
    if strategy != "auto":
        raise ValueError(strategy)
    if hot is False:
        hot = hot_keys(df, keys, hot_group_rows)
    alias = [f"_ll_h{i}" for i in range(len(keys))]
    if isinstance(hot, DataFrame):
        n_keys, hot_rows = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("_ll_n"), F.lit(0))).first()
        hot_df = hot.select(*[F.col(k).alias(a) for k, a in zip(keys, alias)])
    else:
        n_keys, hot_rows = len(hot), sum(r["_ll_n"] for r in hot)
        hot_df = F.broadcast(df.sparkSession.createDataFrame(
            [tuple(r[k] for k in keys) for r in hot], df.select(*keys).schema).toDF(*alias))
    if not n_keys:
        return ranked(_window_rank, df)
    n = _range_partitions(hot_rows, hot_group_rows, n)
    on = _null_safe_on(df, hot_df, list(zip(keys, alias)))
    cold = ranked(_window_rank, df.join(hot_df, on, "left_anti"))
    # stats rows <= n + n_keys, both bounded: broadcast (MAX_STATS_ROWS check)
    small = n + n_keys <= MAX_STATS_ROWS
    warm = ranked(_range_rank, df.join(hot_df, on, "left_semi"), n, small)
    return cold.unionByName(warm)


def first_per_group(df: DataFrame, keys: Sequence[str], order: OrderSpec) -> DataFrame:
    """The first row per key by ``order`` (row_number = 1).

    Planned as WindowGroupLimit. Where ``df`` is not already partitioned by
    the keys, each map task keeps one row per key before the shuffle, so a
    hot key sends at most one row per task; callers therefore limit before
    they join on the key.
    """
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return (df.withColumn("_ll_rn", F.row_number().over(w))
            .filter(F.col("_ll_rn") == 1).drop("_ll_rn"))
