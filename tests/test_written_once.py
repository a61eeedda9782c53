"""Step tables that are outputs are written once; ranks of kept rows beside the rejected ones."""

from pyspark.sql import functions as F

from ledgerloom.operators import lookup, qualify
from ledgerloom.plans import conversion, runs
from ledgerloom.sources import analogues as A
from ledgerloom.sources.tables import Tables


def rows(df):
    return sorted(map(repr, df.collect()))


def test_ranks_of_kept_rows_are_those_without_the_rejected(spark):
    accounts = spark.range(400).selectExpr(
        "id AS entryid", "CAST(id % 7 AS string) AS ssn", "CAST(id % 3 AS int) AS AccountTypeId", "1 AS accountstatus",
        "TIMESTAMP_NTZ '2001-01-01' AS activateddate", "TIMESTAMP_NTZ '2001-01-01' AS CreateDate",
        "CASE WHEN id % 5 = 0 THEN 'K1' WHEN id % 11 = 0 THEN NULL ELSE '12' END AS providerkey",
        "CASE WHEN id % 13 <> 0 THEN TIMESTAMP_NTZ '1970-01-01' END AS dob")
    accounts = accounts.unionByName(accounts.where("entryid < 50"))  # keys may repeat
    kept, rejected = qualify.junk_filter(accounts)
    want = rows(qualify.contact_rank(kept))
    for hot in (10 ** 6, 20):  # every person hot as well
        both = qualify.rank_kept(accounts, persons=accounts, hot_group_rows=hot)
        assert both.count() == accounts.count()
        assert sorted(r[:-1] for r in map(tuple, qualify.junk_filter(both)[0].drop("ContactRank").collect())) == sorted(
            r[:-1] for r in map(tuple, kept.collect()))
        got = qualify.junk_filter(both)[0].groupBy("ssn").agg(F.sort_array(F.collect_list("ContactRank")).alias("r"))
        assert rows(got) == rows(qualify.contact_rank(kept).groupBy("ssn").agg(F.sort_array(F.collect_list("ContactRank")).alias("r")))
        unique = qualify.rank_kept(accounts.dropDuplicates(), persons=accounts, hot_group_rows=hot)
        assert rows(qualify.junk_filter(unique)[0]) == rows(qualify.contact_rank(kept.dropDuplicates()))
        assert qualify.junk_filter(both)[1].where("ContactRank IS NOT NULL").isEmpty()
    assert want and rejected.count()


def test_a_step_that_is_an_output_is_written_once(spark, small_dir, tmp_path, monkeypatch):
    root, written, write = str(tmp_path), [], runs.write_run
    monkeypatch.setattr(runs, "write_run", lambda df, root, table, run_id: (written.append(table), write(df, root, table, run_id))[1])
    inputs = A.conversion_inputs(Tables(spark, small_dir))

    def commit(exp_date):
        conversion.commit_run(spark, inputs, root, exp_date=exp_date, as_of=A.AS_OF, run_id="20240101T000000",
                              only=("Accounts", "QualifyingAccounts", "DDID_Lookup"))
        return runs.read_run(spark, root, "Accounts", "20240101T000000").count()

    before = commit(A.EXP_DATE)
    assert written == ["QualifyingAccounts", runs.REPORT_TABLE]
    # the same run over other parameters does not take the accounts that lie there
    want = conversion.Conversion(inputs, exp_date="2030-01-01", as_of=A.AS_OF).target("Accounts").count()
    assert commit("2030-01-01") == want != before


def test_entries_of_the_lookup_are_left_out_first(spark, small_dir):
    t = Tables(spark, small_dir)
    inputs = A.conversion_inputs(t)
    existing = A.existing_lookup(t).withColumns({c: F.lit(None).cast("string") for c in lookup.LOOKUP_COLUMNS[1:]})
    existing = existing.unionByName(existing.limit(5)).unionByName(existing.limit(1).withColumn("entryid", F.lit(None).cast("long")))
    run = conversion.Conversion(inputs, exp_date=A.EXP_DATE, as_of=A.AS_OF, existing_lookup=existing)
    want = lookup.best_id_lookup(inputs["master"], inputs["deposit_ids"], inputs["deposit_usage"], existing)
    assert rows(run.lookup_added()) == rows(want) != []


def test_the_selected_accounts_are_selected_once(spark, monkeypatch):
    """They are read three times (as they are, their persons, their keys)."""
    master = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 2), (4, None, 2), (None, "a", 2)], "entryid long, ssn string, AccountTypeId int")
    written, write = [], qualify.materialize
    monkeypatch.setattr(qualify, "materialize", lambda df, label: (written.append(label), write(df, label))[1])
    selected = master.where("entryid = 1").select("entryid", "ssn")
    got = qualify.append_related(selected, master, write=True)
    assert written == ["selected_accounts"] and rows(got) == rows(qualify.append_related(selected, master))
    assert "entryid#" in (plan := got._jdf.queryExecution().optimizedPlan().toString()) and "entryid = 1" not in plan


def test_late_cards_are_sought_among_those_of_the_accounts(spark, small_dir):
    """The wide cards are not shuffled for the late keys or the fee plans; the rows are the same."""
    import re

    from ledgerloom.operators import loads
    i = A.conversion_inputs(Tables(spark, small_dir))
    acc = i["master"].where("entryid % 3 = 0")
    late = i["cards"].where("cardid % 2 = 0").select("cardid")
    late = late.unionByName(late.limit(3))
    tables = [i[n] for n in ("legacy_mapping", "cards", "materials", "plastic_types", "fee_plans", "pin_sets", "status_history")]
    got = loads.load_cards(acc, *tables, mark="1998-01-01", late=late)
    whole = loads.load_cards(acc, *tables, mark=None)
    newer = i["cards"].where("LastUpdateDate > TIMESTAMP_NTZ '1998-01-01' OR cardid % 2 = 0").selectExpr("cardid AS Id")
    assert rows(got) == rows(whole.join(newer, "Id", "left_semi").select(*whole.columns)) != rows(whole)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    holder = re.search(r"\((?:cardholderid#\w+ = entryid#\w+|entryid#\w+ = cardholderid#\w+)\)", plan).start()
    fee = re.search(r"LastFeePlanChangeID#\w+ = LastFeePlanChangeID#\w+", plan).start()
    assert plan.index("_late#") < holder < fee


def test_loaded_accounts_meet_the_lookup_where_they_met_the_late_keys(spark, small_dir):
    import re

    from ledgerloom.operators import loads
    t = Tables(spark, small_dir)
    i = A.conversion_inputs(t)
    late = i["master"].where("entryid % 2 = 0").select("entryid")
    got = loads.load_accounts(i["master"], i["fee_plans"], A.deposit_lookup(t), i["applications"], mark="1998-01-01", late=late)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    fee, deposit, late_keys = (re.search(f"= _{c}#", plan).start() for c in ("fpc", "dd", "late"))
    assert fee < deposit < late_keys and got.count() > 0
