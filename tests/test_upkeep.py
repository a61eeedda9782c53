"""Ranks of changed groups, growing targets, keys and references, salted and
text joins, marks inside the autumn overlap."""

import datetime as dt
import random
from collections import Counter
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import joins
from ledgerloom.operators import checks, flatten, incremental as inc, prune, qualify, rerank
from ledgerloom.plans import runs
from ledgerloom.plans.growing import GrowingTable

ACCOUNT = "entryid int, ssn string, AccountTypeId int, accountstatus int, activateddate int, CreateDate int"


def rows(df):
    columns = sorted(df.columns)
    return Counter(map(tuple, df.select(*[flatten.quote(c) for c in columns]).collect()))


def account(rng, k):
    return (k, rng.choice([None, "", "a", "b", "c", "d", "e"]), rng.choice([1, 2, None]), rng.choice([1, 6]), rng.randrange(5), rng.randrange(5))


def test_changed_groups(spark):
    a = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", None, 1), (None, 1, 1), ("same", 3, 3), ("gone", 1, 1)], "g string, x int, y int")
    b = spark.createDataFrame([("a", 1, None), ("b", 1, None), (None, 1, 2), ("same", 3, 3), ("new", 1, 1)], "g string, x int, y int")
    assert {r.g for r in rerank.changed_groups(a, b.select("y", "g", "x"), "g").collect()} == {"a", "b", None, "gone", "new"}
    assert rerank.changed_groups(a, a, "g").count() == 0
    assert {r.g for r in rerank.changed_groups(a.where("false"), a, "g").collect()} == {"a", "b", None, "same", "gone"}
    with pytest.raises(ValueError):
        rerank.changed_groups(a, b.drop("y"), "g")


@pytest.mark.parametrize("seed,hot", [(1, 10**6), (2, 3)])
def test_contact_ranks_from_changes_equal_a_full_rank(spark, seed, hot):
    rng = random.Random(seed)
    before = [account(rng, k) for k in range(60)]
    after = [account(rng, r[0]) if rng.random() < 0.08 else r for r in before if rng.random() > 0.05] + [account(rng, 100)]
    a, b = spark.createDataFrame(before, ACCOUNT), spark.createDataFrame(after, ACCOUNT)
    got = rerank.contact_rerank(qualify.contact_rank(a), a, b, hot_group_rows=hot)
    assert rows(got) == rows(qualify.contact_rank(b))


def test_only_changed_persons_are_ranked(spark):
    """A rank that the stored table bears for an unchanged person is taken over as it is."""
    a = spark.createDataFrame([(1, "a", 1, 1, 1, 1), (2, "a", 1, 1, 2, 1), (3, "b", 1, 1, 1, 1)], ACCOUNT)
    b = spark.createDataFrame([(1, "a", 1, 1, 1, 1), (2, "a", 1, 1, 2, 1), (4, "b", 1, 1, 5, 1), (3, "b", 1, 1, 1, 1)], ACCOUNT)
    stored = qualify.contact_rank(a).withColumn("ContactRank", F.when(F.col("ssn") == "a", 99).otherwise(F.col("ContactRank")))
    got = {r.entryid: r.ContactRank for r in rerank.contact_rerank(stored, a, b).collect()}
    assert got == {1: 99, 2: 99, 4: 1, 3: 2}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_usage_ranks_from_changes_equal_a_full_rank(spark, seed):
    rng = random.Random(seed)

    def version(old=None):
        master, child, usage = old or ([], [], [])
        master = [m for m in master if rng.random() > 0.1] + [(rng.randrange(12),) for _ in range(3 if old else 10)]
        child = [c for c in child if rng.random() > 0.1] + [
            (rng.choice([None, *range(12)]), rng.randrange(30), rng.choice([None, *range(30)])) for _ in range(4 if old else 40)]
        usage = [u for u in usage if rng.random() > 0.1] + [(rng.choice([None, *range(30)]),) for _ in range(3 if old else 40)]
        return master, child, usage

    def frames(v):
        ddl = "entryid int", "Entryid int, FullDepositID int, EncryptedDepositID int", "dfiaccountno int"
        return tuple(spark.createDataFrame(r, d) for r, d in zip(v, ddl))

    first = version()
    a, b = frames(first), frames(version(first))
    want = rows(prune.usage_rank(*b))
    assert want and rows(rerank.usage_rerank(prune.usage_rank(*a), a, b)) == want


def test_growing_table(spark, tmp_path):
    table = GrowingTable(spark, str(tmp_path), "Flat", "id bigint, note string")
    assert table.read().columns == ["id", "note"] and table.read().count() == 0
    table.append(spark.createDataFrame([(1, "x", 2)], "id bigint, note string, `a.b` int"), "1")
    # a run that broke off before its column list does not count
    runs.write_run(spark.createDataFrame([(9, "lost", 1)], "id bigint, note string, z bigint"), str(tmp_path), "Flat", "2")
    assert table.read().columns == ["id", "note", "a.b"] and table.read().count() == 1
    table.append(spark.createDataFrame([(5, "y", 2), (6, None, None)], "c bigint, note string, id bigint"), "2")
    assert table.read().columns == ["id", "note", "a.b", "c"]
    assert rows(table.read()) == Counter([(2, 0, 1, "x"), (0, 5, 2, "y"), (0, 6, None, None)])
    assert rows(table.read("1")) == Counter([(2, 1, "x")])
    table.append(spark.createDataFrame([], "id bigint, note string"), "3")
    assert table.read().count() == 3 and table.counts() == ["a.b", "c"]
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame([(1, "late")], "id bigint, note string"), "2")


def test_new_categories_become_columns(spark):
    events = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    bridge = spark.createDataFrame([(1, 1), (2, 2), (2, 3), (2, 3), (3, 1)], "event_id bigint, category_id bigint")
    cats = spark.createDataFrame([(1, "old"), (2, "b.new"), (3, "a new")], "id bigint, Category string")
    target = spark.createDataFrame([(1, 1, 0)], "id bigint, old bigint, never bigint")
    grown = flatten.category_flatten_incremental(events, bridge, cats, target, on_new_category="grow")
    assert grown.columns == ["id", "old", "never", "a new", "b.new"]
    assert sorted(map(tuple, grown.collect())) == [(2, 0, 0, 2, 1), (3, 1, 0, 0, 0)]
    with pytest.raises(ValueError):
        flatten.category_flatten_incremental(events, bridge, cats, target, on_new_category="grow", max_categories=1)


def test_sketched_check_equals_the_exact_one(spark):
    df = spark.createDataFrame([(None, None), (None, None), ("a", 1), ("a", 2), ("a", 2), ("a", None), (None, 1), ("b", 7)], "k string, n int")
    for keys in ("k", ["k", "n"]):
        assert rows(checks.check_unique_sketched(df, keys)) == rows(checks.check_unique(df, keys))
    assert checks.check_unique_sketched(df.where("false"), "k").count() == 0
    with pytest.raises(ValueError):
        checks.check_unique_sketched(df.withColumn("f", F.lit(1.0)), ["f"])


def test_references_and_keys(spark):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "Id int")
    child = spark.createDataFrame([(1, 1), (2, 5), (3, 5), (4, None)], "Id int, Parent_Id int")
    tables = {"P": parent, "C": child}
    got = checks.check_references(tables, [("C", "Parent_Id", "P", "Id"), ("C", "Id", "Elsewhere", "Id")])
    assert [tuple(r) for r in got.collect()] == [("C", "Parent_Id", "P", "5", 2)]
    assert checks.check_references({"P": parent.where("false"), "C": child}, [("C", "Parent_Id", "P", "Id")]).count() == 2
    bad = checks.check_keys({"P": parent.union(parent.where("Id = 1")), "C": child}, {"P": "Id", "C": "Id"})
    assert rows(bad) == Counter([("Id", 2, "P", "1"), ("Id", 1, "P", None)])
    with pytest.raises(ValueError):
        checks.check_references(tables, [])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_one(spark, how):
    left = spark.range(0, 3000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 400).alias("k"), (F.col("id") % 5).alias("v"))
    right = spark.createDataFrame([(0, "hot"), (0, "hot again"), (2, "two"), (None, "none"), (399, "x"), (5000, "other")], "k long, w string")
    want = rows(left.join(right, "k", how))
    for hot_rows in (100, 5, 10**6):
        assert rows(joins.salted_join(left, right, "k", how, hot_rows=hot_rows)) == want
    assert rows(joins.salted_join(left.where("false"), right, "k", how, hot_rows=1)) == Counter()
    empty = right.where("false")
    assert rows(joins.salted_join(left, empty, "k", how, hot_rows=100)) == rows(left.join(empty, "k", how))


def test_a_hot_key_is_dealt_over_tasks(spark):
    """Neither adaptive execution nor a broadcast helps: the salts alone spread the key."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 8000, 1, 40).select((F.col("id") % 1 + 7).alias("k"), "id")
        right = spark.createDataFrame([(7, "w")], "k long, w string")
        plain = left.join(right, "k").groupBy(F.spark_partition_id()).count().collect()
        salted = joins.salted_join(left, right, "k", hot_rows=200).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(plain) == 1 and len(salted) >= 6 and max(r["count"] for r in salted) <= 3000


def test_hottest_keys_come_first(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 9 + [(None,)] * 7 + [(3,)], "k int")
    assert [tuple(r) for r in joins.hottest_keys(df, "k", 2, 2)] == [(2, 9), (None, 7)]


def test_text_join(spark):
    a = spark.createDataFrame([("a ", 1), ("A", 2), ("  ", 3), (None, 4), (" a", 5)], "s string, n int")
    b = spark.createDataFrame([("a",), ("",), (None,), ("a   ",)], "t string")
    assert sorted(r.n for r in joins.text_join(a, b, ("s", "t")).collect()) == [1, 1, 3]
    assert sorted(r.n for r in joins.text_join(a, b, ("s", "t"), "left_semi", fold=True).collect()) == [1, 2, 3]
    assert sorted(r.n for r in joins.text_join(a, b, ("s", "t"), "left_anti").collect()) == [2, 4, 5]


@pytest.mark.parametrize("mark", ["2001-10-28 04:59:59", "2001-10-28 05:00:00", "2001-10-28 05:59:59", "2001-10-28 06:00:00",
                                  "2001-10-28 06:59:59", "2001-10-28 07:00:00", "2001-04-01 06:30:00", "2001-04-01 07:00:00", "2001-07-01 12:00:00"])
def test_a_mark_skips_no_instant(spark, mark):
    """Rows written at every ten minutes of real time around the mark: none
    after it is skipped, and outside the overlap none before it is read."""
    zone, utc = ZoneInfo("America/New_York"), dt.datetime.fromisoformat(mark)
    instants = [utc.replace(minute=0, second=0) + dt.timedelta(minutes=10 * i) for i in range(-24, 25)]
    clock = [i.replace(tzinfo=dt.timezone.utc).astimezone(zone).replace(tzinfo=None) for i in instants]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(clock)], "n int, w timestamp_ntz")
    got = {r.n for r in inc.changed_since_utc(df, "w", mark).collect()}
    last = {i: max(instants[j] for j in range(len(clock)) if clock[j] == clock[i]) for i in range(len(clock))}
    assert got == {i for i in last if last[i] > utc}
    assert got >= {i for i in range(len(instants)) if instants[i] > utc}


def test_the_overlap_bound_reaches_the_scan(spark, small_dir):
    df = inc.changed_since_utc(spark.read.parquet(f"{small_dir}/orders.parquet"), "o_orderdate", "2001-10-28 05:30:00")
    assert "GreaterThanOrEqual(o_orderdate,2001-10-28T01:00" in df._jdf.queryExecution().executedPlan().toString()
