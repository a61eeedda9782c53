"""The hot-group-safe ranking equals a plain window, including on a hot key."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.ranking import first_per_group, rank_in_groups


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds a third of the rows; values repeat so dense ranks have ties
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("k"),
        (F.col("id") % 50).alias("v"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 13).alias("w"),
        F.col("id").alias("tie"))
    return df


@pytest.mark.parametrize("method", ["row_number", "dense_rank"])
def test_range_equals_window(spark, skewed, method):
    order = [("v", True), ("w", False)] + ([("tie", False)] if method == "row_number" else [])
    a = rank_in_groups(skewed, ["k"], order, "r", method=method, strategy="range")
    b = rank_in_groups(skewed, ["k"], order, "r", method=method, strategy="window")
    assert a.count() == skewed.count()
    assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    out = {(r.k, r.v): r.r for r in
           rank_in_groups(df, ["k"], [("v", False)], "r").collect()}
    assert out == {(None, 1): 1, (None, 2): 2, ("a", 3): 1}


def test_first_per_group_nulls_last_desc(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (2, None, 3)], "k int, v int, id int")
    got = {r.k: r.id for r in first_per_group(df, ["k"], [("v", True)]).collect()}
    assert got == {1: 2, 2: 3}


@pytest.mark.parametrize("method", ["row_number", "dense_rank"])
def test_auto_splits_hot_keys_only(spark, skewed, method):
    from ledgerloom.functions.ranking import hot_keys
    assert [r.k for r in hot_keys(skewed, ["k"], 5000)] == [0]
    order = [("v", True), ("w", False)] + ([("tie", False)] if method == "row_number" else [])
    a = rank_in_groups(skewed, ["k"], order, "r", method=method, hot_group_rows=5000)
    b = rank_in_groups(skewed, ["k"], order, "r", method=method, strategy="window")
    assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)


def test_a_low_threshold_makes_no_more_partitions(spark, monkeypatch):
    """More hot keys than are collected, of few rows each: they come as a
    table, and the range plan keeps to the session's partitions."""
    from pyspark.sql import DataFrame

    from ledgerloom.functions import ranking
    df = spark.range(21000).select((F.col("id") % 10500).alias("k"), F.col("id").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 1), (None, 2), (-1, 5)], "k long, v long"))
    assert isinstance(ranking.hot_keys(df, ["k"], 1), DataFrame)
    used, plan = [], ranking._range_row_number
    monkeypatch.setattr(ranking, "_range_row_number", lambda d, keys, order, out, n, *more: (
        used.append((n, d.count())), plan(d, keys, order, out, n, *more))[1])
    got = rank_in_groups(df, ["k"], [("v", True)], "r", hot_group_rows=1)
    assert used == [(8, 21002)]  # the key of one row takes the window
    want = rank_in_groups(df, ["k"], [("v", True)], "r", strategy="window")
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_ranks_are_taken_together(spark, skewed):
    from ledgerloom.functions.ranking import ranks_in_groups
    orders = {"a": [("v", True)], "b": [("w", False)]}
    got, want = (ranks_in_groups(skewed, ["k"], orders, method="dense_rank", **more)
                 for more in ({"hot_group_rows": 5000}, {"strategy": "window"}))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def _uneven(spark):
    """One key of many values and rows, null keys and values, ties, columns that are carried along."""
    rows = spark.range(20000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 101 = 0 THEN NULL ELSE CONCAT('k', id % 997) END AS k",
        "CASE WHEN id % 9 <> 0 THEN id * 7919 % 4001 END AS v", "CAST(id AS double) / 3 AS x",
        "TIMESTAMP_NTZ '2001-01-01' + make_dt_interval(id % 400) AS at", "id")
    return rows.unionByName(rows.where("id < 3000"))


def test_dense_ranks_shuffle_the_rows_once(spark, monkeypatch):
    """Values are counted where the rows lie: no join back on the values."""
    from ledgerloom.functions import ranking
    df, written = _uneven(spark), []
    monkeypatch.setattr(ranking, "_range_row_number", lambda *a: pytest.fail("rows are joined back"))
    write = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda d, label: (written.append(write(d, label)), written[-1])[1])
    orders = {"a": [("v", True)], "b": [("at", False), ("v", False)]}
    got, want = (ranking.ranks_in_groups(df, ["k"], orders, method="dense_rank", strategy=s, partitions=11) for s in ("range", "window"))
    assert got.columns == want.columns and sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert written[0].groupBy("k").agg(F.countDistinct("_ll_pid").alias("n")).where("k = 'hot' AND n > 3").count() == 1
    assert 0 < written[1].count() < 11 and "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    none = ranking.ranks_in_groups(df.where("id < 0"), ["k"], orders, method="dense_rank", strategy="range")
    assert none.columns == want.columns and none.isEmpty()


def test_values_that_arrow_compares_otherwise_are_joined_back(spark):
    """NaN equals NaN, and text with a collation is equal in any case."""
    rows = [(1, float("nan"), "a"), (1, float("nan"), "A"), (1, 2.0, "b"), (2, None, "B"), (2, -0.0, "b"), (2, 0.0, None)]
    df = spark.createDataFrame(rows, "k long, v double, t string").withColumn("t", F.collate("t", "UTF8_LCASE"))
    for order in ([("v", False)], [("t", True)]):
        got, want = (rank_in_groups(df, ["k"], order, "r", method="dense_rank", strategy=s).selectExpr("k", "v", "CAST(t AS string) t", "r")
                     for s in ("range", "window"))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
