"""Category flattening: events with many-to-many categories -> one wide row.

Input roles (column names are the contract; adapt frames with ``select``):
  events      ``id`` + event attributes
  bridge      ``event_id``, ``category_id``
  categories  ``id``, ``Category``

J01 bridge_expand, J02 category_domain, J03 category_pivot,
J04 category_flatten, J05 category_flatten_incremental, J06 category_drift.

``category_counts_long`` is the form without any bound: one row per (id,
Category). A wide table needs its list of columns on the driver, so the wide
forms take the list (``domain``), or find it and check it against
``max_categories`` when the caller sets that; nothing is capped by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.joins import hottest_keys, salted_join
from ledgerloom.session import materialize


def quote(name: str) -> str:
    """Backtick-quote a column name so dots, spaces and brackets are literal."""
    return "`" + name.replace("`", "``") + "`"


def _category_rows(bridge: DataFrame, categories: DataFrame,
                   collation: str | None = None) -> DataFrame:
    """(id, Category) per bridge row; repeated bridge rows stay repeated.

    ``collation`` (e.g. 'UTF8_LCASE') makes grouping and matching of the
    category text follow it; the default is binary comparison.
    """
    cat = F.col("Category") if collation is None else F.collate("Category", collation)
    cats = categories.select(F.col("id").alias("category_id"), cat.alias("Category"))
    return (bridge.select("event_id", "category_id")
            .join(cats, "category_id")
            .select(F.col("event_id").alias("id"), "Category"))


def bridge_expand(events: DataFrame, bridge: DataFrame, categories: DataFrame, *,
                  collation: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """One row per (event, bridge row); events without categories drop out.

    ``hot_rows``: categories and events of more bridge rows than that are
    salted in both joins (``functions.joins``), for clusters where skew
    settings are off.
    """
    if hot_rows is None:
        return events.join(_category_rows(bridge, categories, collation), "id")
    cat = F.col("Category") if collation is None else F.collate("Category", collation)
    cats = categories.select(F.col("id").alias("category_id"), cat.alias("Category"))
    rows = salted_join(bridge.select("event_id", "category_id"), cats, "category_id", hot_rows=hot_rows)
    rows = rows.select(F.col("event_id").alias("id"), "Category")
    # the bridge's own event ids bound those of its rows with a category
    hot = hottest_keys(bridge, "event_id", hot_rows)
    return salted_join(rows, events, "id", hot_rows=hot_rows, hot=hot).select(
        "id", *[F.col(quote(c)) for c in events.columns if c != "id"], "Category")


def domain_frame(expanded: DataFrame, category: str = "Category") -> DataFrame:
    """J02 as a frame: sorted distinct non-NULL category values."""
    c = F.col(category)
    return expanded.select(c).where(c.isNotNull()).distinct().orderBy(c)


def domain_text(expanded: DataFrame, category: str = "Category") -> DataFrame:
    """J02 as text: one row, the sorted values bracket-quoted and comma
    separated (the form of a column list), NULLs dropped.

    The text is one value by definition; its size is that of the distinct
    values, which the aggregate has reduced the rows to before.
    """
    c = F.col(category)
    distinct = expanded.where(c.isNotNull()).select(c.alias("_v")).distinct()
    values = F.array_sort(F.collect_list("_v"))
    quoted = F.transform(values, lambda v: F.concat(F.lit("["), F.replace(v, F.lit("]"),
                                                                          F.lit("]]")), F.lit("]")))
    return distinct.agg(F.concat_ws(",", quoted).alias("columns"))


def category_domain(expanded: DataFrame, category: str = "Category",
                    max_categories: int | None = None) -> list[str]:
    """The column list of the pivot, collected once to the driver.

    It is the list of the columns that the result will have. With
    ``max_categories`` a longer list raises, and no more than one value over
    it is collected.
    """
    found = domain_frame(expanded, category)
    rows = (found if max_categories is None else found.limit(max_categories + 1)).collect()
    if max_categories is not None and len(rows) > max_categories:
        raise ValueError(f"more than {max_categories} distinct categories")
    values = [r[0] for r in rows]
    lowered = {v.lower() for v in values}
    if len(lowered) != len(values):  # column names are case-insensitive
        raise ValueError("categories differ only by letter case; column names would collide")
    return values


def _long(rows: DataFrame, id: str, category: str) -> DataFrame:
    """(id, category, _ll_n): rows per pair, summed map-side first."""
    return rows.groupBy(id, category).agg(F.count(F.lit(1)).alias("_ll_n"))


#: Bytes of wide rows that one task of the pivot aggregates, at most.
TASK_BYTES = 128 << 20


def _wide(long: DataFrame, domain, id: str, category: str, pairs: int) -> DataFrame:
    """``id`` + one bigint count per domain value (0 when absent), from the
    counted pairs: one aggregate and one shuffle on ``id`` for a list of any
    width (a collated category is matched as it was grouped).

    ``pairs``: how many there are at most. The pairs are narrow and the rows
    made of them are wide, so the partitions are numbered by the latter: a
    task holds ``TASK_BYTES`` of them (ids of many pairs less).
    """
    c = F.col(category)
    n = -(-pairs * 8 * (len(domain) + 1) // TASK_BYTES)
    if n > 1:
        long = long.repartition(n, id)
    return long.groupBy(id).agg(*[
        F.coalesce(F.sum(F.when(c == F.lit(v), F.col("_ll_n"))), F.lit(0)).cast("bigint").alias(v)
        for v in domain])


def category_pivot(expanded: DataFrame, domain=None, *, id: str = "id", category: str = "Category",
                   max_categories: int | None = None) -> DataFrame:
    """One row per id, one bigint count per category value.

    Pairs (id, category) are counted map-side, so a hot id is small before it
    is shuffled. The counted pairs are written once: their number, the list
    (without ``domain``) and the pivot are taken from them.
    """
    long = materialize(_long(expanded, id, category), "category_counts")
    if domain is None:
        domain = category_domain(long, category, max_categories)
    if not domain:
        return expanded.select(id).where(F.lit(False))
    return _wide(long, domain, id, category, long.count())


def category_counts_long(events: DataFrame, bridge: DataFrame, categories: DataFrame, *,
                         collation: str | None = None) -> DataFrame:
    """J03 in long form: (id, Category, n) for events that exist; no bound on
    the categories, nothing crosses to the driver.

    An event id that repeats counts its bridge rows once per event row, as
    the join of J01 does.
    """
    counted = _long(_category_rows(bridge, categories, collation), "id", "Category")
    repeats = events.groupBy("id").agg(F.count(F.lit(1)).alias("_ll_e"))
    return counted.join(repeats, "id").select(
        "id", "Category", (F.col("_ll_n") * F.col("_ll_e")).alias("n"))


def category_counts(events: DataFrame, bridge: DataFrame, categories: DataFrame,
                    domain=None, *, max_categories: int | None = None,
                    collation: str | None = None) -> DataFrame:
    """J03 from the source tables: ``id`` + one count per category, for events
    that exist.

    Same rows as ``category_pivot(bridge_expand(...))`` (also for event ids
    that repeat), but the bridge rows are counted per (id, Category) before
    they meet the events, and the events contribute only their ids.
    """
    long = category_counts_long(events, bridge, categories, collation=collation).withColumnRenamed("n", "_ll_n")
    if domain is None:
        long = materialize(long, "category_counts")
        domain = category_domain(long, "Category", max_categories)
    if not domain:
        return events.select("id").where(F.lit(False))
    return _wide(long, domain, "id", "Category", bridge.count())


def category_flatten(events: DataFrame, bridge: DataFrame, categories: DataFrame,
                     domain=None, *, literal: bool = False, max_categories: int | None = None,
                     collation: str | None = None) -> DataFrame:
    """Event attributes + one count column per category.

    Default: one row per event. The counts are aggregated on the narrow
    (id, Category) rows before the wide event rows are joined, so the event
    table is joined once per event instead of once per bridge row. Without
    ``domain`` the counted pairs of live events are written once and give
    both the column list and the counts.
    ``literal=True``: the pivot is joined back to the expanded rows, one row
    per (event, bridge row), as the positional insert did.
    ``collation``: see ``_category_rows`` (values equal under it share a column).
    """
    rows = _category_rows(bridge, categories, collation)
    counted = _long(rows, "id", "Category")
    if domain is None:
        live = events.select("id").distinct()
        counted = materialize(counted.join(live, "id", "left_semi"), "category_counts")
        domain = category_domain(counted, "Category", max_categories)
    event_cols = events.columns
    clash = {c.lower() for c in event_cols} & {v.lower() for v in domain}
    if clash:
        raise ValueError(f"categories named like event columns: {sorted(clash)}")
    if not domain:
        return events.where(F.lit(False))
    left = events.join(rows.select("id"), "id") if literal else events
    return left.join(_wide(counted, domain, "id", "Category", bridge.count()), "id").select(
        *[F.col(quote(c)) for c in event_cols], *[F.col(quote(v)) for v in domain])


def category_drift(expanded: DataFrame, target_columns, *,
                   category: str = "Category") -> DataFrame:
    """Categories in the data but not in the target, and the reverse.

    Columns: Category, n_rows (bridge rows carrying it; 0 when absent),
    direction ('not_in_target' | 'not_in_data').
    """
    spark = expanded.sparkSession
    c = F.col(category)
    counts = (expanded.where(c.isNotNull()).groupBy(c.alias("Category"))
              .agg(F.count(F.lit(1)).alias("n_rows")))
    # one side of each pair is missing exactly where the two sets differ
    target = spark.createDataFrame([(v, True) for v in target_columns], "Category string, in_target boolean")
    return (counts.join(target, "Category", "full_outer")
            .where(F.col("n_rows").isNull() | F.col("in_target").isNull())
            .select("Category", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                    F.when(F.col("in_target").isNull(), F.lit("not_in_target"))
                    .otherwise(F.lit("not_in_data")).alias("direction")))


class NewCategories(ValueError):
    """Categories that the target lacks; ``drift`` has all of them."""

    def __init__(self, drift: DataFrame, total: int, first: list[str]):
        super().__init__(f"{total} new categories not in the target, among them: " + ", ".join(first))
        self.drift, self.total = drift, total


def category_flatten_incremental(events: DataFrame, bridge: DataFrame,
                                 categories: DataFrame, target: DataFrame, *,
                                 on_new_category: str = "error", max_categories: int | None = None) -> DataFrame:
    """Flatten only events whose id is not yet in ``target``.

    The column list is the target's (its columns that are not event
    columns), so the result can be appended by name. Categories outside it
    raise ``NewCategories`` with the full drift by default
    (``on_new_category='error'``), are ignored (``'ignore'``), or become
    columns after the target's, in order of their names (``'grow'``;
    ``plans.growing`` keeps such a target). ``max_categories`` bounds those
    new columns.
    """
    domain = [c for c in target.columns if c not in events.columns]
    fresh = events.join(target.select("id"), "id", "left_anti")
    rows = _category_rows(bridge, categories).join(fresh.select("id"), "id", "left_semi")
    drift = category_drift(rows, domain).where(F.col("direction") == "not_in_target")
    if on_new_category == "grow":
        domain += category_domain(drift, "Category", max_categories)
    elif on_new_category == "error":
        # one row: how many, and the first few names for the message
        found = drift.agg(F.count(F.lit(1)).alias("n"), F.min("Category").alias("first"),
                          F.max("Category").alias("last")).first()
        if found["n"]:
            raise NewCategories(drift, found["n"], sorted({found["first"], found["last"]}))
    elif on_new_category != "ignore":
        raise ValueError(on_new_category)
    return category_flatten(fresh, bridge, categories, domain)
