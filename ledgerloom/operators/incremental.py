"""Incremental loads: insert-if-absent, high-water marks, replace-changed.

J20 insert_absent, J21 high_water_mark / changed_since, J22 replace_changed.
Targets are immutable DataFrames: each function returns rows to append or
the new state; writing it is the caller's (see ``plans.runs``).
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import code_maps as cm
from ledgerloom.functions.exprs import ntz, to_local, to_utc, to_utc_later


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def insert_absent(target: DataFrame, source: DataFrame, *, key, target_key=None,
                  distinct: bool = False) -> DataFrame:
    """Source rows whose key is not in the target (rows to append).

    The target's keys are deduplicated first (partial aggregate), so a key
    repeated in the target is shuffled once per map task, not once per row;
    then a left anti join, which AQE may split when a key is hot.
    """
    skeys = _keys(key)
    tkeys = _keys(target_key) if target_key is not None else skeys
    present = target.select(*[F.col(t).alias(s) for s, t in zip(skeys, tkeys)]).distinct()
    rows = source.distinct() if distinct else source
    return rows.join(present, skeys, "left_anti")


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append by column name, never by position."""
    return target.unionByName(rows.select(*target.columns))


def high_water_mark(target: DataFrame, column: str, *, default: str = cm.EMPTY_MARK,
                    zone: str | None = cm.LEGACY_ZONE) -> dt.datetime:
    """max(column) of the target as legacy local time; ``default`` if empty.

    One aggregate value crosses to the driver; it is then used as a literal so
    the comparison in ``changed_since`` still reaches the parquet scan.
    """
    value = F.max(column)
    if zone is not None:
        value = to_local(value, zone)
    mark = target.agg(value.alias("m")).collect()[0]["m"]
    if mark is None:
        mark = dt.datetime.fromisoformat(default)
    return mark


def changed_since(source: DataFrame, column: str, mark, *, inclusive: bool = False) -> DataFrame:
    """Source rows modified after the mark (strict ``>`` by default)."""
    lit = mark if isinstance(mark, Column) else ntz(mark)
    c = F.col(column)
    return source.where(c >= lit if inclusive else c > lit)


def changed_since_utc(source: DataFrame, column: str, mark, *, zone: str = cm.LEGACY_ZONE) -> DataFrame:
    """J21 with a mark in UTC: rows whose wall-clock ``column`` may lie after it.

    A wall-clock time inside the autumn overlap stands for two instants; a row
    counts as changed when the later one is after the mark, so that a mark
    inside the overlap skips nothing (rows read twice are replaced by key). The
    mark (a datetime or text) crosses as two literals: the local time from
    which on rows can qualify, which reaches the scan, and the mark itself for
    the exact test above it. The bound is the mark's own local time, or where
    the mark lies in the first pass of the overlap, the full hour at which the
    second pass begins.
    """
    utc = ntz(mark)
    local = to_local(utc, zone)
    at = dt.datetime.fromisoformat(str(mark)).replace(tzinfo=None)
    turn = ntz(at.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1))
    twice = (to_utc(local, zone) == utc) & (to_utc_later(local, zone) > utc)
    bound = source.sparkSession.range(1).select(F.when(twice, to_local(turn, zone)).otherwise(local).alias("m")).first()["m"]
    return source.where((F.col(column) >= ntz(bound)) & (to_utc_later(column, zone) > utc))


def replace_changed(target: DataFrame, rows: DataFrame, *, key, changed_keys: DataFrame | None = None,
                    literal: bool = False) -> tuple[DataFrame, DataFrame]:
    """Merge re-derived ``rows`` into ``target`` by key.

    Default: the keys of ``rows`` are deleted from the target and ``rows``
    inserted (one key set). Keys in ``changed_keys`` that are in the target
    but have no re-derived row are returned as ``delete_only_keys`` and kept.
    ``literal=True``: every changed key is deleted, as the legacy procedure
    did, so changed rows that no longer qualify vanish.

    Returns ``(new_target, delete_only_keys)``.
    """
    keys = _keys(key)
    insert_keys = rows.select(*keys).distinct()
    if changed_keys is None:
        changed_keys = insert_keys
    changed_keys = changed_keys.select(*keys).distinct()
    in_target = changed_keys.join(target.select(*keys).distinct(), keys, "left_semi")
    delete_only = in_target.join(insert_keys, keys, "left_anti")
    doomed = changed_keys if literal else insert_keys
    kept = target.join(doomed, keys, "left_anti")
    return append(kept, rows), delete_only


def latest_per_key(left: DataFrame, right: DataFrame, *, on: Sequence[tuple[str, str]],
                   order: Sequence[tuple[str, bool]], columns: Sequence[str],
                   where: Column | None = None, prefix: str = "") -> DataFrame:
    """Left rows + ``columns`` of the newest matching right row (NULL if none).

    ``on`` pairs (left column, right column); ``order`` as in ranking
    (first row wins). The top-1 is a WindowGroupLimit: each map task keeps
    one row per key before the shuffle.
    """
    from ledgerloom.functions.ranking import first_per_group

    r = right.where(where) if where is not None else right
    rkeys = [rc for _, rc in on]
    needed = list(dict.fromkeys(rkeys + [c for c, _ in order] + list(columns)))
    best = first_per_group(r.select(*needed),
                           rkeys, order)
    best = best.select(*[F.col(rc).alias(f"_lk{i}") for i, (_, rc) in enumerate(on)],
                       *[F.col(c).alias(prefix + c) for c in columns])
    cond = None
    for i, (lc, _) in enumerate(on):
        term = left[lc] == best[f"_lk{i}"]
        cond = term if cond is None else cond & term
    joined = left.join(best, cond, "left")
    return joined.drop(*[f"_lk{i}" for i in range(len(on))])
