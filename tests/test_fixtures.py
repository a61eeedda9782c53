"""Small literal fixtures for cases the driver's tables do not contain
(NULLs, blanks, ties, bad codes, DST edges, empty inputs)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import code_maps as cm
from ledgerloom.functions.exprs import to_local, to_utc
from ledgerloom.operators import (exclude, flatten, incremental as inc, loads, lookup, prune,
                                  qualify)

D = dt.datetime

MASTER_SCHEMA = (
    "entryid long, clientkey long, providerkey string, firstname string, lastname string, "
    "address1 string, address2 string, address3 string, city string, state string, zip string, "
    "email string, telephone string, celltel string, ssn string, dob timestamp_ntz, "
    "accountstatus int, created timestamp_ntz, activateddate timestamp_ntz, "
    "CreateDate timestamp_ntz, LastUpdateDate timestamp_ntz, provideraccountID long, "
    "ActiveCardID long, LastFeePlanChangeID long, AccountTypeId int")
MASTER_COLS = [c.split()[0] for c in MASTER_SCHEMA.split(", ")]
T0 = D(2020, 1, 1)


def master(spark, *rows):
    base = dict(clientkey=None, providerkey=None, firstname="ANN", lastname="LEE",
                address1="1 MAIN ST", address2=None, address3=None, city="TOWN", state="NY",
                zip="12345", email=None, telephone=None, celltel=None, ssn="111", dob=T0,
                accountstatus=1, created=T0, activateddate=T0, CreateDate=T0,
                LastUpdateDate=T0, provideraccountID=None, ActiveCardID=None,
                LastFeePlanChangeID=None, AccountTypeId=1)
    out = []
    for r in rows:
        d = dict(base, **r)
        d.setdefault("providerkey", str(d["entryid"]))
        if d["providerkey"] is None:
            d["providerkey"] = str(d["entryid"])
        if d["provideraccountID"] is None:
            d["provideraccountID"] = d["entryid"]
        if d["clientkey"] is None:
            d["clientkey"] = d["entryid"]
        out.append(tuple(d[c] for c in MASTER_COLS))
    return spark.createDataFrame(out, MASTER_SCHEMA)


# ---------------------------------------------------------------- categories

@pytest.fixture
def cat_frames(spark):
    events = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, Email string")
    bridge = spark.createDataFrame(
        [(2, 10), (3, 10), (3, 11), (3, 12), (3, 12), (3, 13)], "event_id long, category_id long")
    cats = spark.createDataFrame(
        [(10, "Sales, Q1"), (11, "a.b [x]"), (12, "#tag"), (13, None)], "id long, Category string")
    return events, bridge, cats


def test_flatten_counts_repeats_and_zeros(spark, cat_frames):
    events, bridge, cats = cat_frames
    out = flatten.category_flatten(events, bridge, cats)
    assert out.columns == ["id", "Email", "#tag", "Sales, Q1", "a.b [x]"]
    rows = {r["id"]: r.asDict() for r in out.collect()}
    assert set(rows) == {2, 3}                      # event 1 has no category
    assert rows[3]["#tag"] == 2                     # repeated bridge row
    assert rows[2]["#tag"] == 0 and rows[2]["a.b [x]"] == 0   # zero, not NULL
    lit = flatten.category_flatten(events, bridge, cats, literal=True)
    assert lit.count() == 6                         # one row per bridge row
    pivot = flatten.category_pivot(flatten.bridge_expand(events, bridge, cats))
    total = pivot.select(sum(F.col(f"`{c}`") for c in pivot.columns[1:]).alias("t")).agg(
        F.sum("t")).first()[0]
    assert total == 5                               # sum of cells = non-NULL bridge rows


def test_flatten_empty_domain(spark, cat_frames):
    events, _, cats = cat_frames
    empty = spark.createDataFrame([], "event_id long, category_id long")
    out = flatten.category_flatten(events, empty, cats)
    assert out.count() == 0 and out.columns == ["id", "Email"]


def test_drift_and_incremental_refusal(spark, cat_frames):
    events, bridge, cats = cat_frames
    target = flatten.category_flatten(events.where("id = 2"), bridge, cats)  # only 'Sales, Q1'
    drift = {(r.Category, r.direction): r.n_rows for r in flatten.category_drift(
        flatten.bridge_expand(events, bridge, cats), ["Sales, Q1", "gone"]).collect()}
    assert drift == {("a.b [x]", "not_in_target"): 1, ("#tag", "not_in_target"): 2,
                     ("gone", "not_in_data"): 0}
    with pytest.raises(ValueError, match="new categories"):
        flatten.category_flatten_incremental(events, bridge, cats, target)
    ok = flatten.category_flatten_incremental(events, bridge, cats, target,
                                              on_new_category="ignore")
    assert [r.id for r in ok.collect()] == [3] and ok.columns == target.columns


# ---------------------------------------------------------------- deposit ids

@pytest.fixture
def deposits(spark):
    m = spark.createDataFrame([(i,) for i in range(1, 7)], "entryid long")
    child = spark.createDataFrame([
        (1, "s", 10, "a", T0), (2, "s", 20, "b", T0), (2, "s", 21, "c", T0),
        (3, "s", 30, "d", T0), (3, "s", 31, "e", T0), (4, "s", 40, "f", T0),
        (4, "s", 41, "g", T0), (5, "s", 50, "h", T0), (5, "s", 51, "i", T0),
        (6, "s", 60, None, T0), (6, "s", 61, "j", T0), (7, "s", 70, "k", T0),
        (7, "s", 71, "l", T0)],
        "Entryid long, ShortDepositID string, FullDepositID long, EncryptedDepositID string, "
        "createdate timestamp_ntz")
    usage = spark.createDataFrame([(x,) for x in ["d", "f", "g", "h", "h", "i"]],
                                  "dfiaccountno string")
    return m, child, usage


def ids(df):
    return sorted(r.FullDepositID for r in df.collect())


def test_prune_row_level_literal_and_chain(deposits):
    m, child, usage = deposits
    assert prune.multi_key_entries(m, child).count() == 5
    step1 = prune.prune_unused(m, child, usage)
    assert ids(step1) == [10, 21, 30, 31, 40, 41, 50, 51, 61, 70, 71]
    assert step1.count() + 2 == child.count()       # survivors + deleted = input
    assert ids(prune.prune_unused(m, child, usage, literal=True)) == [
        10, 30, 31, 40, 41, 50, 51, 70, 71]
    # ranks are not nested: entries 3 and 5 lose every row
    assert ids(prune.prune_less_used(m, step1, usage)) == [10, 21, 41, 61, 70, 71]
    assert ids(prune.keep_best(m, child, usage)) == [10, 21, 30, 41, 50, 61, 70, 71]


def test_usage_rank_dense_nulls_last(deposits):
    m, child, usage = deposits
    r = {(x.Entryid, x.FullDepositID): (x.UseRank, x.DDIDRank)
         for x in prune.usage_rank(m, child, usage).collect()}
    assert r[(3, 30)] == (1, 2) and r[(3, 31)] == (2, 1)
    assert r[(2, 20)] == (1, 2) and r[(2, 21)] == (1, 1)   # all NULL use: rank 1
    assert r[(5, 50)] == (1, 2) and r[(5, 51)] == (2, 1)


def test_best_id_lookup_insert_only_and_utc(spark, deposits):
    m, child, usage = deposits
    existing = spark.createDataFrame([(4,)], "entryid long")
    out = lookup.best_id_lookup(m, child, usage, existing).collect()
    assert sorted((r.entryid, r.FullDepositID) for r in out) == [
        (1, 10), (2, 21), (3, 30), (5, 50), (6, 61)]
    assert {r.CreateDate for r in out} == {D(2020, 1, 1, 5, 0)}


# ---------------------------------------------------------------- qualification

def test_sentinels_expiry_and_goals(spark):
    mch = master(spark,
                 dict(entryid=1), dict(entryid=2, ssn=None), dict(entryid=3, ssn=""),
                 dict(entryid=4, ssn="   "), dict(entryid=5, ssn="999999999"),
                 dict(entryid=6, ssn="123456789"), dict(entryid=7, firstname="FIRST NAME"),
                 dict(entryid=8, firstname=None), dict(entryid=9), dict(entryid=10),
                 dict(entryid=11, AccountTypeId=2), dict(entryid=12, AccountTypeId=2),
                 dict(entryid=13, AccountTypeId=2))
    cards = spark.createDataFrame(
        [(100 + i, i, 12, 2024, 1) for i in range(1, 9)]       # live card for 1..8
        + [(120, 9, 0, 2024, 1), (121, 9, 13, 2024, 1), (122, 9, 5, 0, 1),
           (123, 10, 6, 2024, 1)],                               # 10: month end == expDate
        "cardid long, cardholderid long, expmonth int, expyear int, externalcardid long")
    bal = spark.createDataFrame([(12, 500), (13, 7)], "UserAccountID long, UserLedgerBalance long")
    goals = spark.createDataFrame([(12, 9), (13, 11)], "EntryID long, PayRewardsToEntryID long")
    q = qualify.qualify_accounts(mch, cards, bal, goals, exp_date="2024-06-30 00:00:00")
    got = sorted(r.entryid for r in q.collect())
    # 2-8 are sentinels; 9 has only bad expiry parts but its goal pays it;
    # 10 expires exactly on expDate; goal 13 pays into the goal account 11
    assert got == [1, 9, 11]


def test_expiry_with_time_of_day(spark):
    mch = master(spark, dict(entryid=1))
    cards = spark.createDataFrame([(1, 1, 6, 2024, 1)], "cardid long, cardholderid long, "
                                  "expmonth int, expyear int, externalcardid long")
    bal = spark.createDataFrame([], "UserAccountID long, UserLedgerBalance long")
    q = qualify.qualify_accounts(mch, cards, bal, exp_date="2024-06-29 12:00:00")
    assert q.count() == 1


def test_append_related_dedupes(spark):
    mch = master(spark, dict(entryid=1, ssn="p"), dict(entryid=2, ssn="p", AccountTypeId=2),
                 dict(entryid=3, ssn="q", AccountTypeId=2))
    sel = mch.where("entryid in (1, 2)")
    out = qualify.append_related(sel, mch)
    assert sorted(r.entryid for r in out.collect()) == [1, 2]


def test_drop_closed_zero(spark):
    acc = master(spark, dict(entryid=1, accountstatus=6), dict(entryid=2, accountstatus=6),
                 dict(entryid=3, accountstatus=6), dict(entryid=4, accountstatus=6),
                 dict(entryid=5, accountstatus=None), dict(entryid=6, accountstatus=1))
    bal = spark.createDataFrame([(1, 0, 0), (2, None, None), (4, 0, 5), (5, 0, 0)],
                                "UserAccountID long, UserAvailableBalance long, "
                                "UserLedgerBalance long")
    out = qualify.drop_closed_zero(acc, bal)
    assert sorted(r.entryid for r in out.collect()) == [4, 5, 6]


def test_snapshot_diff_and_mark_closed(spark):
    prev = spark.createDataFrame([(1,), (2,), (3,)], "entryid long")
    cur = spark.createDataFrame([(2,), (4,)], "entryid long")
    dropped = qualify.snapshot_diff(prev, cur)
    assert sorted(r.entryid for r in dropped.collect()) == [1, 3]
    target = spark.createDataFrame([(1, 10), (2, 10), (4, 10)], "Id long, Status int")
    out = {r.Id: r.Status for r in qualify.mark_closed(target, dropped).collect()}
    assert out == {1: 40, 2: 10, 4: 10}


def test_junk_filter_provider_keys(spark):
    keys = ["12", " 12 ", "+5", "12.5", "1e3", "", "   ", None]
    acc = master(spark, *[dict(entryid=i, providerkey=k) for i, k in enumerate(keys)],
                 dict(entryid=99, dob=None))
    # providerkey None falls back to str(entryid) in the helper; force NULL
    acc = acc.withColumn("providerkey", F.when(F.col("entryid") == 7, None)
                         .otherwise(F.col("providerkey")))
    kept, rejected = qualify.junk_filter(acc)
    assert sorted(r.entryid for r in kept.collect()) == [0, 1, 2]
    reasons = {r.entryid: r.reason for r in rejected.collect()}
    assert reasons[99] == "dob_missing"
    assert {reasons[i] for i in range(3, 8)} == {"provider_key"}


def test_contact_rank_ties_and_nulls(spark):
    acc = master(spark, dict(entryid=5, ssn="p"), dict(entryid=3, ssn="p"),
                 dict(entryid=4, ssn="p", activateddate=None),
                 dict(entryid=9, ssn="p", AccountTypeId=0))
    r = {x.entryid: x.ContactRank for x in qualify.contact_rank(acc).collect()}
    assert r == {9: 1, 3: 2, 5: 3, 4: 4}


# ---------------------------------------------------------------- incremental

def test_marks_and_replace(spark):
    empty = spark.createDataFrame([], "Id long, Modified timestamp_ntz")
    assert inc.high_water_mark(empty, "Modified") == D(1900, 1, 1)
    tgt = spark.createDataFrame([(1, D(2024, 7, 1, 16))], "Id long, Modified timestamp_ntz")
    mark = inc.high_water_mark(tgt, "Modified")
    assert mark == D(2024, 7, 1, 12)
    src = spark.createDataFrame([(1, D(2024, 7, 1, 12)), (2, D(2024, 7, 1, 13))],
                                "Id long, LastUpdateDate timestamp_ntz")
    assert [r.Id for r in inc.changed_since(src, "LastUpdateDate", mark).collect()] == [2]
    target = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "Id long, v string")
    rows = spark.createDataFrame([(2, "new"), (4, "new")], "Id long, v string")
    changed = spark.createDataFrame([(1,), (2,), (4,)], "Id long")
    new, only = inc.replace_changed(target, rows, key="Id", changed_keys=changed)
    assert sorted(map(tuple, new.collect())) == [(1, "old"), (2, "new"), (3, "old"), (4, "new")]
    assert [r.Id for r in only.collect()] == [1]
    lit, _ = inc.replace_changed(target, rows, key="Id", changed_keys=changed, literal=True)
    assert sorted(map(tuple, lit.collect())) == [(2, "new"), (3, "old"), (4, "new")]
    absent = inc.insert_absent(target, rows, key="Id")
    assert [r.Id for r in absent.collect()] == [4]


# ---------------------------------------------------------------- loads

def test_time_zone_edges(spark):
    df = spark.createDataFrame([(D(2024, 7, 1, 12),), (D(2024, 1, 1, 12),),
                                (D(2024, 3, 10, 2, 30),), (D(2024, 11, 3, 1, 30),)],
                               "t timestamp_ntz")
    got = [r.u for r in df.select(to_utc("t").alias("u")).collect()]
    assert got == [D(2024, 7, 1, 16), D(2024, 1, 1, 17), D(2024, 3, 10, 7, 30),
                   D(2024, 11, 3, 5, 30)]
    back = df.select(to_local(to_utc("t")).alias("b")).first().b
    assert back == D(2024, 7, 1, 12)


def test_cardholder_birth_dates(spark):
    ranked = master(spark, *[dict(entryid=i, ssn=f"p{i}", dob=D(1980, 1, 1)) for i in range(1, 5)]
                    ).withColumn("ContactRank", F.lit(1).cast("long"))
    apps = spark.createDataFrame([
        (1, 2, 7, D(2020, 1, 1), 1990, 5, 6), (2, 2, 7, D(2021, 1, 1), 1991, 7, 8),
        (3, 3, 7, D(2020, 1, 1), 1990, 2, 30), (4, 4, 7, D(2020, 1, 1), 1990, 2, None),
        (5, 1, 1, D(2020, 1, 1), 1970, 1, 1)],
        "applicationid long, clientkey long, status int, submitted timestamp_ntz, year int, "
        "month int, day int")
    existing = spark.createDataFrame([(0, "p9")], "Id long, Ssn_Number string")
    out = {r.Id: r.DateOfBirth for r in loads.load_cardholders(ranked, apps, existing).collect()}
    assert out == {1: D(1980, 1, 1), 2: D(1991, 7, 8), 3: D(1980, 1, 1), 4: D(1980, 1, 1)}


def test_fee_plan_codes(spark):
    plans = [1, 2, 3, 5, 6, 7, 9, 4, None]
    ranked = master(spark, *[dict(entryid=i, LastFeePlanChangeID=i) for i in range(10)])
    fees = spark.createDataFrame([(i, p) for i, p in enumerate(plans)],
                                 "FeePlanChangeID long, FeePlanID int")
    lk = spark.createDataFrame([(0, "1234567890123456789")], "entryid long, FullDepositID string")
    apps = spark.createDataFrame([(7, 0)], "applicationid long, clientkey long")
    out = {r.Id: r for r in loads.load_accounts(ranked, fees, lk, apps).collect()}
    assert [out[i].Type_Id for i in range(10)] == [1, 2, 4, 1, 2, 3, 2, 1, 1, 1]
    assert out[0].DepositNumber == "1234567890123456" and out[0].ApplicationId == 7
    assert out[1].DepositNumber is None


def test_balances_cents_zero_rows_once(spark):
    accounts = spark.createDataFrame([(1,), (2,), (3,), (4,)], "Id long")
    ranked = master(spark, *[dict(entryid=i) for i in range(1, 5)])
    bal = spark.createDataFrame([(1, 12345, -500, 9, T0), (2, -1, -2, 8, T0)],
                                "UserAccountID long, UserAvailableBalance long, "
                                "UserLedgerBalance long, TransactionID long, "
                                "TransactionTime timestamp_ntz").withColumn(
        "CreateDate", F.col("TransactionTime")).withColumn("LastUpdateDate",
                                                           F.col("TransactionTime"))
    existing = spark.createDataFrame([(4,)], "Id long")
    out = {r.Id: r for r in loads.load_balances(accounts, ranked, bal, existing,
                                                as_of="2024-01-01 00:00:00").collect()}
    assert out[1].AvailableBalance == Decimal("123.45") and out[1].LedgerBalance == Decimal("-5.00")
    assert out[2].AvailableBalance == Decimal("-0.01")
    assert out[3].AvailableBalance == Decimal("0.00") and out[3].EffectiveDate == D(2024, 1, 1)
    assert 4 not in out                              # zero row inserted once only
    lit = loads.load_balances(accounts, ranked, bal, None, as_of="2024-01-01", literal=True)
    assert sorted(r.Id for r in lit.collect()) == [3, 4]   # NULL mark: no real balances


def test_contacts(spark):
    ranked = master(
        spark,
        dict(entryid=1, ssn="p1", email="  ", telephone=None, celltel="555", zip="12345-6789",
             state="ZZ", address1="A" * 41, city="C" * 26),
        dict(entryid=2, ssn="p2", email="x@y", telephone="", celltel="  ", state="NY"),
    ).withColumn("ContactRank", F.lit(1).cast("long"))
    ch = spark.createDataFrame([(11, "p1"), (12, "p2")], "Id long, Ssn_Number string")
    states = spark.createDataFrame([(7, "NY")], "id int, value string")
    addr = {r.CardHolder_Id: r for r in loads.load_addresses(ch, ranked, states).collect()}
    assert addr[11].PostalCode == "123456789" and addr[11].State == 999 and addr[12].State == 7
    assert len(addr[11].Address1) == 40 and len(addr[11].City) == 25
    assert [r.CardHolder_Id for r in loads.load_emails(ch, ranked).collect()] == [12]
    phones = [(r.CardHolder_Id, r.Type, r.Digits) for r in loads.load_phones(ch, ranked).collect()]
    assert phones == [(11, 2, "555")]


def test_card_codes_and_replacement_date(spark):
    ranked = master(spark, dict(entryid=1, ActiveCardID=10, LastFeePlanChangeID=1))
    mapping = spark.createDataFrame([(1, 99)], "Account_ID long, Cardholder_ID long")
    rows = [  # cardid, cardstatus, IssuanceState
        (10, 1, 1), (11, 1, 3), (12, 2, 0), (13, 3, 2), (14, 3, 2), (15, 4, None), (16, 3, 5)]
    cards = spark.createDataFrame(
        [(c, 1, 12, 2030, c, T0, T0, D(2024, 2, 29, 10, 30), T0, "N" * 30, s, i, 1)
         for c, s, i in rows],
        "cardid long, cardholderid long, expmonth int, expyear int, externalcardid long, "
        "LastUpdateDate timestamp_ntz, CreateDate timestamp_ntz, created timestamp_ntz, "
        "IssueDate timestamp_ntz, nameoncard string, cardstatus int, IssuanceState int, "
        "MaterialID int")
    mats = spark.createDataFrame([(1, 5)], "MaterialID int, PlasticTypeID int")
    pts = spark.createDataFrame([(5,)], "PlasticTypeID int")
    fees = spark.createDataFrame([(1, 1)], "FeePlanChangeID long, FeePlanID int")
    pins = spark.createDataFrame([(10, T0)], "cardid long, asofdate timestamp_ntz")
    hist = spark.createDataFrame([(13, 7, T0), (13, 2, D(2019, 1, 1)), (14, None, T0),
                                  (16, 14, T0)],
                                 "cardid long, blockreasonid int, changeddate timestamp_ntz")
    out = {r.Id: r for r in loads.load_cards(ranked, mapping, cards, mats, pts, fees, pins,
                                             hist).collect()}
    assert {k: (v.Status, v.IssueReason, v.StatusReason) for k, v in out.items()} == {
        10: (10, 1, 10), 11: (30, 2, 10), 12: (20, 2, 20), 13: (50, 2, 100),
        14: (30, 2, 30), 15: (30, 6, 34), 16: (30, 7, 80)}
    assert out[10].IsPinSet == 1 and out[11].IsPinSet == 0 and len(out[10].NameOnCard) == 26
    # 29 Feb 10:30 local -> 15:30 UTC -> one year later 28 Feb, time kept
    assert out[10].WhenEligibleForFreeReplacementCard == D(2025, 2, 28, 15, 30)
    assert out[10].CardHolder_Id == 99 and out[10].CardStock_Id == 5


def test_card_numbers_mask(spark):
    mapping = spark.createDataFrame([(1,)], "Account_Id long")
    cards = spark.createDataFrame([(10, 1, 100, T0, T0), (11, 1, 101, T0, T0), (12, 1, 102, T0, T0)],
                                  "cardid long, cardholderid long, externalcardid long, "
                                  "LastUpdateDate timestamp_ntz, CreateDate timestamp_ntz")
    pans = spark.createDataFrame([(101, None), (102, "1234567890123456789")],
                                 "externalcardid long, PAN string")
    out = {r.Id: r.Number for r in loads.load_card_numbers(mapping, cards, pans).collect()}
    assert out == {10: cm.MASKED_PAN, 11: cm.MASKED_PAN, 12: "1234567890123456"}


def test_card_requests(spark):
    mch = master(spark, dict(entryid=1, address2="   ", address3="  x ", zip="123456789"))
    mapping = spark.createDataFrame([(1,)], "Account_Id long")
    req = spark.createDataFrame([(i, 1, d, T0, T0) for i, d in [(1, 1), (2, 2), (3, 3), (4, None),
                                                                   (5, 1)]],
                                "CardRequestID long, EntryID long, DeliveryTypeID int, "
                                "CreateDate timestamp_ntz, LastUpdateDate timestamp_ntz")
    existing = spark.createDataFrame([(5,)], "id long")
    states = spark.createDataFrame([(7, "NY")], "id int, value string")
    out = {r.Id: r for r in loads.load_card_requests(req, existing, mch, mapping, states).collect()}
    assert {k: v.DeliverType for k, v in out.items()} == {
        1: "Standard", 2: "Expedited", 3: "UNKNOWN", 4: "UNKNOWN"}
    assert out[1].Address2 is None and out[1].Address3 == "  x " and out[1].PostalCode == "12345"


def test_exclusions_closure(spark):
    ranked = master(spark,
                    dict(entryid=1, ssn="p", ActiveCardID=10),   # rank-1 of p, no PAN row
                    dict(entryid=2, ssn="p", ActiveCardID=20),   # has a PAN, same person
                    dict(entryid=3, ssn="q", ActiveCardID=30),   # NULL PAN
                    dict(entryid=4, ssn="r", ActiveCardID=99),   # card missing
                    dict(entryid=5, ssn="s", ActiveCardID=20))   # fine
    cards = spark.createDataFrame([(10, 100), (20, 200), (30, 300)],
                                  "cardid long, externalcardid long")
    pans = spark.createDataFrame([(200, "4"), (300, None)], "externalcardid long, PAN string")
    ch = spark.createDataFrame([(1, "p"), (3, "q"), (5, "s")], "Id long, Ssn_Number string")
    awp, chwp = exclude.exclusions(ranked, cards, pans, ch)
    assert sorted(r.entryid for r in awp.collect()) == [1, 2, 3, 4]
    assert sorted(r.Id for r in chwp.collect()) == [1, 3]


def test_collation_groups_case_variants(spark):
    events = spark.createDataFrame([(1,), (2,)], "id long")
    bridge = spark.createDataFrame([(1, 10), (1, 11), (2, 11)], "event_id long, category_id long")
    cats = spark.createDataFrame([(10, "Promo"), (11, "PROMO")], "id long, Category string")
    with pytest.raises(ValueError, match="letter case"):
        flatten.category_flatten(events, bridge, cats)
    out = flatten.category_flatten(events, bridge, cats, collation="UTF8_LCASE")
    assert len(out.columns) == 2
    assert sorted(r[1] for r in out.collect()) == [1, 2]
    ranked = master(spark, dict(entryid=1, ssn="p", state="ny")).withColumn(
        "ContactRank", F.lit(1).cast("long"))
    ch = spark.createDataFrame([(11, "p")], "Id long, Ssn_Number string")
    states = spark.createDataFrame([(7, "NY")], "id int, value string")
    assert loads.load_addresses(ch, ranked, states).first().State == 999
    assert loads.load_addresses(ch, ranked, states, collation="UTF8_LCASE").first().State == 7


def test_domain_text_quotes_and_explicit_bounds(spark, cat_frames):
    events, bridge, cats = cat_frames
    expanded = flatten.bridge_expand(events, bridge, cats)
    assert flatten.domain_text(expanded).first().columns == "[#tag],[Sales, Q1],[a.b [x]]]"
    assert len(flatten.category_domain(expanded)) == 3  # no bound unless the caller sets one
    with pytest.raises(ValueError, match="more than 2"):
        flatten.category_domain(expanded, max_categories=2)


def test_hot_person_ranked_by_split_path(spark):
    # person "p" holds most accounts; a low threshold sends it down the range path
    acc = master(spark, *[dict(entryid=i, ssn="p" if i % 4 else f"q{i}",
                               AccountTypeId=i % 3, activateddate=D(2020, 1, 1 + i % 20))
                          for i in range(60)])
    a = qualify.contact_rank(acc, hot_group_rows=10).select("entryid", "ContactRank")
    b = qualify.contact_rank(acc, strategy="window").select("entryid", "ContactRank")
    assert sorted(a.collect()) == sorted(b.collect())


def test_wide_and_long_counts_agree(spark):
    n = 150
    events = spark.range(40).select(F.col("id"), (F.col("id") % 3).alias("g"))
    bridge = spark.range(400).select((F.col("id") % 40).alias("event_id"),
                                     (F.col("id") % n).alias("category_id"))
    cats = spark.range(n).select(F.col("id"), F.format_string("c.%03d", "id").alias("Category"))
    wide = flatten.category_flatten(events, bridge, cats)
    assert len(wide.columns) == 2 + n
    cells = {(r["id"], c): r[c] for r in wide.collect() for c in wide.columns[2:] if r[c]}
    long = flatten.category_counts_long(events, bridge, cats).collect()
    assert cells == {(r["id"], r["Category"]): r["n"] for r in long}


def test_repeated_event_ids_multiply(spark):
    events = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id bigint, x string")
    bridge = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (3, 7)], "event_id bigint, category_id bigint")
    cats = spark.createDataFrame([(7, "k")], "id bigint, Category string")
    expanded = flatten.category_pivot(flatten.bridge_expand(events, bridge, cats))
    counted = flatten.category_counts(events, bridge, cats)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, expanded.collect())) == [(1, 4), (2, 1)]


def test_new_categories_come_with_the_whole_drift(spark):
    events = spark.range(60).withColumn("x", F.lit(1))
    bridge = spark.range(60).select(F.col("id").alias("event_id"), F.col("id").alias("category_id"))
    cats = spark.range(60).select("id", F.format_string("c%02d", "id").alias("Category"))
    target = spark.createDataFrame([], "id bigint, x int, c00 bigint")
    with pytest.raises(flatten.NewCategories, match="59 new categories") as e:
        flatten.category_flatten_incremental(events, bridge, cats, target)
    assert e.value.total == e.value.drift.count() == 59


def test_sentinel_rows_stay_out_when_keys_repeat(spark):
    m = master(spark, dict(entryid=1, ssn="5", AccountTypeId=1, provideraccountID=9),
               dict(entryid=1, ssn="999999999", AccountTypeId=1, provideraccountID=9),
               dict(entryid=2, ssn="6", firstname="FIRST NAME", AccountTypeId=1, provideraccountID=9))
    cards = spark.createDataFrame([], "cardholderid bigint, expmonth int, expyear int, externalcardid bigint")
    balances = spark.createDataFrame([(9, 5)], "UserAccountID bigint, UserLedgerBalance bigint")
    got = qualify.qualify_accounts(m, cards, balances, exp_date="2020-01-01", unique_key=False)
    assert [(r.entryid, r.ssn) for r in got.collect()] == [(1, "5")]


# Written by hand from the code lists: card status with the active flag or the
# block reason; issue reason by issuance state, else block reason, else state;
# status reason by card status, for blocked cards by block reason.
CARD_STATUS = {(0, True): 10, (1, True): 10, (0, False): 30, (1, False): 30, 2: 20, 4: 30, 5: 30, 6: 30, None: 30}
BLOCKED_STATUS = {2: 40, 7: 50, 8: 40}
ISSUE_BY_STATE = {1: 1, 3: 2}
ISSUE_BY_BLOCK = {1: 5, 2: 8, 8: 6, 14: 7}
ISSUE_OTHERWISE = {0: 2, 2: 2}
REASON = {0: 10, 1: 10, 2: 20, 4: 34, 5: 20, 6: 20, None: 20}
BLOCKED_REASON = {2: 90, 4: 34, 7: 100, 8: 30, 9: 43, 14: 80}


def test_every_branch_of_the_code_tables(spark):
    rows = [(s, a, b, i) for s in (None, 0, 1, 2, 3, 4, 5, 6) for a in (True, False)
            for b in range(16) for i in (None, 0, 1, 2, 3, 4)]
    frame = spark.createDataFrame(rows, "s int, a boolean, b int, i int")
    roles = {"card_status": F.col("s"), "active": F.col("a").cast("int"), "block_reason": F.col("b"),
             "issuance_state": F.col("i")}
    got = frame.select("s", "a", "b", "i", *[
        cm.build(rules, default, roles).alias(n) for n, rules, default in (
            ("status", cm.CARD_STATUS, cm.CARD_STATUS_DEFAULT), ("issue", cm.ISSUE_REASON, cm.ISSUE_REASON_DEFAULT),
            ("reason", cm.STATUS_REASON, cm.STATUS_REASON_DEFAULT))]).collect()
    for r in got:
        status = BLOCKED_STATUS.get(r.b, 30) if r.s == 3 else CARD_STATUS[(r.s, r.a) if r.s in (0, 1) else r.s]
        issue = ISSUE_BY_STATE.get(r.i) or ISSUE_BY_BLOCK.get(r.b) or ISSUE_OTHERWISE.get(r.i, 6)
        reason = BLOCKED_REASON.get(r.b, 30) if r.s == 3 else REASON[r.s]
        assert (r.status, r.issue, r.reason) == (status, issue, reason), r
    plans = spark.range(12).select("id", cm.build(cm.FEE_PLAN_TYPE, cm.FEE_PLAN_TYPE_DEFAULT, {"fee_plan": F.col("id")}).alias("t"),
                                   cm.build(cm.DELIVERY_TYPE, cm.DELIVERY_TYPE_DEFAULT, {"delivery": F.col("id")}).alias("d"),
                                   cm.build(cm.ACCOUNT_STATUS, cm.ACCOUNT_STATUS_DEFAULT, {"account_status": F.col("id")}).alias("s"),
                                   cm.build(cm.ACCOUNT_STATUS_REASON, cm.ACCOUNT_STATUS_REASON_DEFAULT,
                                            {"account_status": F.col("id")}).alias("r")).collect()
    assert [r.t for r in plans] == [1, 1, 2, 4, 1, 1, 2, 3, 1, 2, 1, 1]
    assert [r.d for r in plans] == ["UNKNOWN", "Standard", "Expedited"] + ["UNKNOWN"] * 9
    assert [(r.s, r.r) for r in plans] == [(10, 10)] * 6 + [(40, 44)] + [(10, 10)] * 5


def test_declared_schemas_conform_and_read(spark):
    import tempfile

    from ledgerloom.sources.schemas import INPUT_SCHEMAS, conform, read_role
    df = spark.createDataFrame([("7", "x")], "CARDID string, extra string")
    with pytest.raises(ValueError, match="missing column"):
        conform(df, INPUT_SCHEMAS["pin_sets"])
    out = conform(df, INPUT_SCHEMAS["pin_sets"], allow_missing=True)
    assert out.columns == ["cardid", "asofdate"] and out.first() == (7, None)
    path = tempfile.mkdtemp(prefix="ll-role-") + "/pins"
    out.write.parquet(path)
    back = read_role(spark, path, "pin_sets")
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["bigint", "timestamp_ntz"]


def test_insert_absent_distinct_and_append_by_name(spark):
    target = spark.createDataFrame([(1, "a")], "Id long, v string")
    source = spark.createDataFrame([("b", 2), ("b", 2), ("a", 1)], "v string, Id long")
    rows = inc.insert_absent(target, source, key="Id", distinct=True)
    assert rows.count() == 1
    out = inc.append(target, rows)
    assert out.columns == ["Id", "v"] and sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b")]


def test_latest_per_key_with_filter_and_no_match(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "clientkey long")
    apps = spark.createDataFrame([(1, 10, 7, T0), (1, 11, 7, D(2021, 1, 1)), (1, 12, 1, D(2022, 1, 1)),
                                  (2, 20, 1, T0)],
                                 "clientkey long, applicationid long, status int, submitted timestamp_ntz")
    out = inc.latest_per_key(left, apps, on=[("clientkey", "clientkey")],
                             order=[("submitted", True)], columns=["applicationid"],
                             where=F.col("status") == 7, prefix="app_")
    got = {r.clientkey: r.app_applicationid for r in out.collect()}
    assert got == {1: 11, 2: None, 3: None}


def test_mark_inclusive_and_without_zone(spark):
    tgt = spark.createDataFrame([(1, D(2024, 1, 1, 5))], "Id long, Modified timestamp_ntz")
    assert inc.high_water_mark(tgt, "Modified", zone=None) == D(2024, 1, 1, 5)
    mark = inc.high_water_mark(tgt, "Modified")           # 05:00 UTC = 00:00 Eastern
    src = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2))],
                                "Id long, LastUpdateDate timestamp_ntz")
    assert [r.Id for r in inc.changed_since(src, "LastUpdateDate", mark).collect()] == [2]
    both = inc.changed_since(src, "LastUpdateDate", mark, inclusive=True)
    assert sorted(r.Id for r in both.collect()) == [1, 2]


def test_values_that_do_not_fit_are_not_hidden(spark):
    from ledgerloom.sources.schemas import conform, misfits
    df = spark.createDataFrame([("7", "2020-01-01 00:00:00"), ("x", None), (None, "no time")], "cardid string, asofdate string")
    ddl = "cardid bigint, asofdate timestamp_ntz"
    with pytest.raises(Exception, match="is no (bigint|timestamp_ntz)"):
        conform(df, ddl).collect()
    assert [r.cardid for r in conform(df, ddl, on_bad="null").collect()] == [7, None, None]
    assert sorted(r.reason for r in misfits(df, ddl).collect()) == ["asofdate", "cardid"]
