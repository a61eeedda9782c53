"""A run reads of the master what its outputs need; small key sets are written before the master meets them."""

from ledgerloom.operators import qualify
from ledgerloom.plans import conversion, runs
from ledgerloom.sources import analogues as A
from ledgerloom.sources.tables import Tables


def rows(df):
    return sorted(map(repr, df.collect()))


def test_rule_rows_are_the_master_rows(spark, small_dir):
    t = Tables(spark, small_dir)
    rules, master = A.rule_rows(t), A.accounts_master(t)
    assert rules.columns == qualify.RULE_COLUMNS
    assert rows(rules) == rows(master.select(*qualify.RULE_COLUMNS)) != []
    plan = rules._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and "o_orderpriority" not in plan.split("Join Inner")[1].split("Project")[0]
    # a reader without the active card is spared the search for it, others are not
    assert "max_by" not in master.drop("ActiveCardID")._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" in master._jdf.queryExecution().optimizedPlan().toString()
    assert master.where("ActiveCardID IS NULL").isEmpty()


def test_written_keys_select_the_same_accounts(spark, monkeypatch):
    master = spark.createDataFrame(
        [(1, "a", "x", 1, 1, 11), (1, "999999999", "x", 2, 1, 12), (2, "b", "x", 1, 1, 13), (3, "c", "x", 2, 1, 14),
         (4, "d", "FIRST NAME", 2, 1, 15), (5, None, "x", 1, 1, 16), (None, "e", "x", 1, 1, 17), (6, "f", "x", 1, 1, 18)],
        "entryid long, ssn string, firstname string, AccountTypeId int, accountstatus int, provideraccountID long")
    master = master.unionByName(master.where("entryid = 2"))  # keys may repeat
    cards = spark.createDataFrame([(1, 12, 2030, 1), (None, 12, 2030, 1), (5, 12, 2030, 1), (6, 1, 1999, 1)],
                                  "cardholderid long, expmonth int, expyear int, externalcardid long")
    balances = spark.createDataFrame([(13, 5), (14, 0), (15, 7), (17, 7)], "UserAccountID long, UserLedgerBalance long")
    goals = spark.createDataFrame([(2, 3), (2, 4), (3, 6), (4, None)], "EntryID long, PayRewardsToEntryID long")
    written, write = [], qualify.materialize
    monkeypatch.setattr(qualify, "materialize", lambda df, label: (written.append(label), write(df, label))[1])
    want = rows(qualify.qualify_accounts(master, cards, balances, goals, exp_date="2020-01-01"))
    assert written == [] and len(want) == 5  # both rows of 1 and of 2, and 3
    assert rows(qualify.qualify_accounts(master, cards, balances, goals, exp_date="2020-01-01", write=True)) == want
    assert written == ["paid_entries", "qualifying_keys"]


def test_ranked_rows_have_the_columns_of_the_outputs(spark, small_dir, tmp_path, monkeypatch):
    t, seen, real = Tables(spark, small_dir), [], qualify.contact_rank
    inputs = A.conversion_inputs(t)
    monkeypatch.setattr(qualify, "contact_rank", lambda df, **k: (seen.append(set(df.columns) - {"_ll_junk"}), real(df, **k))[1])
    for only in (("Accounts", "QualifyingAccounts", "DDID_Lookup"), ("Accounts",)):
        conversion.commit_run(spark, inputs, f"{tmp_path}/{len(only)}", exp_date=A.EXP_DATE, as_of=A.AS_OF, run_id="1", only=only,
                              rule_rows=A.rule_rows(t))
        assert seen.pop() == set(conversion.columns_read(only)) < set(inputs["master"].columns) and not seen
    conversion.commit_run(spark, inputs, f"{tmp_path}/all", exp_date=A.EXP_DATE, as_of=A.AS_OF, run_id="1")
    assert seen.pop() == set(inputs["master"].columns)
    for name, folder in (("Accounts", "1"), ("Accounts", "3"), ("QualifyingAccounts", "3")):
        got, want = (runs.read_run(spark, f"{tmp_path}/{f}", name, "1") for f in (folder, "all"))
        assert got.columns == want.columns and rows(got) == rows(want) != []
