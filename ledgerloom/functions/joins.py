"""Joins whose keys may be hot, and joins on text keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ranking import HOT_GROUP_ROWS, MAX_HOT_KEYS

_SALT = "_ll_salt"


def hottest_keys(df: DataFrame, key: str, hot_rows: int = HOT_GROUP_ROWS, max_keys: int = MAX_HOT_KEYS) -> list:
    """(key, n_rows) of the keys with more than ``hot_rows`` rows, the largest
    first. Beyond ``max_keys`` of them each of the rest holds less than one
    row in ``max_keys``, which one task can take."""
    counted = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") > hot_rows).orderBy(F.desc("n_rows"), "key").limit(max_keys).collect()


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", *,
                hot_rows: int = HOT_GROUP_ROWS, hot: list | None = None) -> DataFrame:
    """``left.join(right, key, how)`` for a ``key`` that may hold a large share
    of the left rows. ``how``: inner, left, left_semi or left_anti.

    One count on the key finds the keys of more than ``hot_rows`` left rows
    (or ``hot`` gives them: what ``hottest_keys`` returned). The left rows of
    such a key go to ceil(n / hot_rows) salts, dealt by map partition, so a
    task that runs again deals the same; only the right rows of hot keys are
    repeated, once for each salt of their key. Null keys match nothing and are
    spread like a hot key. The list of hot keys is bounded (``MAX_HOT_KEYS``)
    and broadcast; no skew setting is relied on.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    if hot is None:
        hot = hottest_keys(left, key, hot_rows)
    if not hot:
        return left.join(right, key, how)
    spark = left.sparkSession
    kind = left.schema[key].dataType.simpleString()
    salts = F.broadcast(spark.createDataFrame([(r["key"], -(-r["n_rows"] // hot_rows)) for r in hot],
                                              f"_ll_hot {kind}, _ll_salts bigint"))
    dealt = (left.join(salts, F.col(key).eqNullSafe(F.col("_ll_hot")), "left")
             .withColumn(_SALT, F.pmod(F.spark_partition_id().cast("bigint"), F.coalesce("_ll_salts", F.lit(1))))
             .drop("_ll_hot", "_ll_salts"))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_ll_salts", F.lit(1)) - 1))
    repeated = (right.where(F.col(key).isNotNull()).join(salts, F.col(key) == F.col("_ll_hot"), "left")
                .withColumn(_SALT, each).drop("_ll_hot", "_ll_salts"))
    return dealt.join(repeated, [key, _SALT], how).drop(_SALT)


def text_key(c: Column | str, fold: bool = False) -> Column:
    """A text key as the legacy server compares it: trailing blanks do not
    count (text of blanks alone equals the empty text), with ``fold`` neither
    does letter case. Null stays null."""
    c = F.rtrim(F.col(c) if isinstance(c, str) else c)
    return F.lower(c) if fold else c


def text_join(left: DataFrame, right: DataFrame, on: tuple[str, str], how: str = "inner", *, fold: bool = False) -> DataFrame:
    """Join on two text columns by ``text_key``; both keep their own columns
    and spelling, which must have different names (semi and anti: any)."""
    key = "_ll_text_key"
    keyed = right.withColumn(key, text_key(on[1], fold))
    if how in ("left_semi", "left_anti"):
        keyed = keyed.select(key).distinct()
    return left.withColumn(key, text_key(on[0], fold)).join(keyed, key, how).drop(key)
