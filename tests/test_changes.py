"""Change feeds, requalification from changes, targets in buckets."""

import os
import random

import pytest

from ledgerloom.operators import feed, requalify as rq
from ledgerloom.plans.buckets import BucketedTable

OLD, NEW = "2001-06-15", "2001-09-15"


def test_change_feed(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 5), (3, None, 1), (5, "s", 1)], "k int, s string, n int")
    b = spark.createDataFrame([(1, 0, "x"), (2, 5, "z"), (3, 1, None), (4, 1, "w")], "k int, n int, s string")
    got = sorted(map(tuple, feed.change_feed(a, b, "k").collect()))
    assert got == [(1, "changed", "n"), (2, "changed", "s"), (4, "inserted", ""), (5, "removed", "")]
    assert feed.change_feed(a, a, "k").count() == 0
    empty = a.where("false")
    assert {r.change for r in feed.change_feed(empty, a, "k").collect()} == {"inserted"}
    assert {r.change for r in feed.change_feed(a, empty, "k").collect()} == {"removed"}


def sources(spark, rng, old=None):
    """Small random sources; with ``old`` some of its rows change, go or come."""
    def rows(name, n, make):
        kept = {r[0]: r for r in old[name]} if old else {}
        for k in list(kept):
            if rng.random() < 0.15:
                kept.pop(k)
        for k in range(n):
            if k not in kept and (old is None or rng.random() < 0.3) or k in kept and rng.random() < 0.15:
                kept[k] = (k, *make(k))
        return list(kept.values())

    plain = {
        "master": rows("master", 40, lambda k: (str(rng.randrange(12)), rng.choice(["A", "FIRST NAME"]) if rng.random() < 0.2 else "A",
                                                rng.choice([1, 1, 2]), rng.choice([1, 6]), 100 + k % 30)),
        "cards": rows("cards", 50, lambda k: (rng.randrange(40), rng.choice([0, 5, 6, 7, 8, 9, 10]), 2001, 1)),
        "balances": rows("balances", 40, lambda k: (100 + rng.randrange(30), rng.choice([0, 0, 7]), rng.choice([0, 7]))),
        "goals": rows("goals", 40, lambda k: (rng.randrange(40),)),
    }
    ddl = {"master": "entryid bigint, ssn string, firstname string, AccountTypeId int, accountstatus int, provideraccountID bigint",
           "cards": "cardid bigint, cardholderid bigint, expmonth int, expyear int, externalcardid bigint",
           "balances": "TransactionID bigint, UserAccountID bigint, UserLedgerBalance bigint, UserAvailableBalance bigint",
           "goals": "EntryID bigint, PayRewardsToEntryID bigint"}
    return plain, {name: spark.createDataFrame(r, ddl[name]) for name, r in plain.items()}


@pytest.mark.parametrize("seed,dates", [(1, (OLD, NEW)), (2, (NEW, OLD)), (3, (OLD, OLD)), (4, (OLD, NEW))])
def test_requalification_equals_a_full_evaluation(spark, seed, dates):
    rng = random.Random(seed)
    plain, before = sources(spark, rng)
    _, after = sources(spark, rng, plain)
    roles = ("master", "cards", "balances", "goals")
    state = rq.qualification(*[before[r] for r in roles], exp_date=dates[0])
    want = rq.qualification(*[after[r] for r in roles], exp_date=dates[1])
    got = rq.requalify(state, *[after[r] for r in roles], changed=rq.source_changes(before, after), exp_date=dates[1],
                       previous_exp_date=dates[0])
    columns = sorted(want.columns)
    key = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert key(got) == key(want) and want.count() > 0


def test_requalification_without_changes_takes_everything_over(spark):
    _, before = sources(spark, random.Random(9))
    roles = [before[r] for r in ("master", "cards", "balances", "goals")]
    state = rq.qualification(*roles, exp_date=OLD)
    got = rq.requalify(state, *roles, changed=rq.source_changes(before, before), exp_date=OLD, previous_exp_date=OLD)
    assert sorted(map(str, got.select(*state.columns).collect())) == sorted(map(str, state.collect()))


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_a_merge_writes_only_touched_buckets(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path), "T", "Id bigint, v string", "Id", 16)
    table.write(spark.createDataFrame([(i, "old") for i in range(400)] + [(None, "none")], "Id bigint, v string"), "1")
    before = files(f"{tmp_path}/T/data")
    rows = spark.createDataFrame([(3, "new"), (1000, "new")], "Id bigint, v string")
    touched = table.merge("1", "2", rows, spark.createDataFrame([(3,), (5,), (7777,)], "Id bigint"))
    assert 1 <= len(touched) <= 4
    written = files(f"{tmp_path}/T/data")
    assert all(written[f] == t for f, t in before.items())
    fresh = {f.split("bucket=")[1].split("/")[0] for f in set(written) - set(before)}
    assert {int(b) for b in fresh} <= set(touched)
    got = {r.Id: r.v for r in table.read("2").collect()}
    assert got == {i: "old" for i in range(400) if i not in (3, 5)} | {3: "new", 1000: "new", None: "none"}
    assert table.read("1").count() == 401
    table.merge("2", "3", spark.createDataFrame([(1, "again")], "Id bigint, v string"), spark.createDataFrame([(1,)], "Id bigint"))
    table.drop_unused(["3"])
    assert {r.Id: r.v for r in table.read("3").collect()} == got | {1: "again"}
    assert not table.has("1") and table.has("3") and len(files(f"{tmp_path}/T/data")) < len(written)


def test_empty_tables_in_buckets(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path), "T", "Id bigint, v string", "Id", 4)
    none = spark.createDataFrame([], "Id bigint, v string")
    table.write(none, "1")
    assert table.read("1").count() == 0 and table.merge("1", "2", none) == [] and table.read("2").collect() == []
    table.merge("2", "3", spark.createDataFrame([(1, "a"), (1, "a")], "Id bigint, v string"))
    assert table.read("3").count() == 2
    table.merge("3", "4", none, spark.createDataFrame([(1,)], "Id bigint"))
    assert table.read("4").collect() == []
