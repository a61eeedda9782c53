"""Declared-key checks (the legacy tables declared keys the files cannot enforce).

J37 check_unique, check_unique_sketched; references between tables: orphans,
check_references.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with ``n_rows``.

    One hash aggregate with map-side partial counts; a hot key costs one
    row per map task in the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def check_unique_sketched(df: DataFrame, keys) -> DataFrame:
    """J37 for wide keys that hardly ever repeat: the same rows as ``check_unique``.

    The first pass counts 64-bit digests of the keys, so eight bytes a row are
    shuffled whatever the keys' width. A digest counted once proves its key
    unique; only rows of the other digests (repeated keys, and the rare pairs
    of keys that share a digest) reach the exact count. The input is read
    twice. Null keys repeat like others; floating-point keys are refused,
    since equal ones may have different digests.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    floats = [k for k in keys if df.schema[k].dataType.typeName() in ("float", "double")]
    if floats:
        raise ValueError(f"floating-point keys {floats}")
    digest = F.xxhash64(*[v for k in keys for v in (F.col(k).isNull(), F.col(k))])
    possible = (df.groupBy(digest.alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > 1).select("_digest"))
    rows = df.select(*keys).withColumn("_digest", digest)
    return check_unique(rows.join(possible, "_digest", "left_semi"), keys)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values of the child's ``column`` that no parent row has, with ``n_rows``.

    Child rows are counted by value map-side before they meet the parent's
    keys, so a hot value is one row. Null refers to nothing and is no orphan.
    """
    counted = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = parent.select(F.col(key).alias("_parent"))
    return counted.join(keys, F.col(column) == F.col("_parent"), "left_anti")


def check_references(tables: dict[str, DataFrame], references, *, missing: str = "skip") -> DataFrame:
    """``orphans`` of every (child, column, parent, key) of ``references`` whose
    tables are given: child, column, parent, value (as text), n_rows.
    ``missing="fail"``: a reference with a table that is not given is an error,
    so that none is left out."""
    if missing not in ("skip", "fail"):
        raise ValueError(missing)
    absent = sorted({name for child, _, parent, _ in references for name in (child, parent)} - set(tables))
    if absent and missing == "fail":
        raise ValueError(f"tables of references are missing: {absent}")
    found = [orphans(tables[child], column, tables[parent], key).select(
        F.lit(child).alias("child"), F.lit(column).alias("column"), F.lit(parent).alias("parent"),
        F.col(column).cast("string").alias("value"), "n_rows")
        for child, column, parent, key in references if child in tables and parent in tables]
    if not found:
        raise ValueError("no reference between the given tables")
    return reduce(DataFrame.unionByName, found)


def check_keys(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """Values of the declared ``keys`` (table -> column) that repeat or are null
    in the given tables: table, key, value (as text, null for null), n_rows."""
    found = []
    for name, key in keys.items():
        if name not in tables:
            continue
        counted = tables[name].groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
        bad = counted.where((F.col("n_rows") > 1) | F.col(key).isNull())
        found.append(bad.select(F.lit(name).alias("table"), F.lit(key).alias("key"), F.col(key).cast("string").alias("value"), "n_rows"))
    if not found:
        raise ValueError("none of the tables has a declared key")
    return reduce(DataFrame.unionByName, found)
