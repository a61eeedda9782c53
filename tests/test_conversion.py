"""The whole run (J35/J36): invariants and idempotence on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import conversion
from ledgerloom.sources import analogues as A
from ledgerloom.sources.tables import Tables


@pytest.fixture(scope="module")
def two_runs(spark, small_dir):
    inputs = A.conversion_inputs(Tables(spark, small_dir))
    first = conversion.run_conversion(inputs, exp_date=A.EXP_DATE, as_of=A.AS_OF,
                                      full_reload=True)
    second = conversion.run_conversion(inputs, exp_date=A.EXP_DATE, as_of=A.AS_OF,
                                       targets=first.targets,
                                       previous_qualifying=first.qualifying,
                                       existing_lookup=first.lookup, report=False)
    return first, second


def same_rows(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_report_has_every_step(two_runs):
    first, _ = two_runs
    steps = {r.step: r.rows for r in first.report.collect()}
    assert steps["qualifying"] > 0 and steps["cards_loaded"] > 0
    assert steps["accounts_loaded"] == steps["qualifying"]   # first run: all accounts are new


def test_second_run_changes_nothing(two_runs):
    first, second = two_runs
    for name, df in first.targets.items():
        assert same_rows(df, second.targets[name]), name


def test_targets_have_unique_keys(two_runs):
    first, _ = two_runs
    for name, key in [("Accounts", "Id"), ("Cards", "Id"), ("Cardholders", "Id"),
                      ("AccountBalances", "Id"), ("CardNumbers", "Id")]:
        df = first.targets[name]
        assert df.select(key).distinct().count() == df.count(), name


def test_exclusions_closed_under_person(two_runs):
    first, _ = two_runs
    persons = first.cardholders_without_pan.select(F.col("Ssn_Number").alias("ssn"))
    every = first.ranked.join(persons, "ssn", "left_semi").select("entryid")
    missing = every.join(first.accounts_without_pan.select("entryid"), "entryid", "left_anti")
    assert missing.count() == 0


def test_invariants_on_driver_tables(spark, small_dir):
    import __spark_entry__ as E
    q = E.queries()
    # sum of pivot cells = bridge rows
    pivot = q["j03_category_pivot"](spark, small_dir)
    cells = pivot.select(sum(F.col(f"`{c}`") for c in pivot.columns[1:]).alias("s")).agg(
        F.sum("s")).first()[0]
    assert cells == q["j01_bridge_expand"](spark, small_dir).count()
    # keep_best: one row per entry
    best = q["j12_keep_best"](spark, small_dir)
    assert best.select("Entryid").distinct().count() == best.count()
    # insert_absent never adds a key already in the target
    rows = q["j20_insert_absent"](spark, small_dir)
    t = Tables(spark, small_dir).lineitem
    assert rows.join(t, rows.o_orderkey == t.l_orderkey, "left_semi").count() == 0
    # merge keeps the key unique
    new = q["j22_replace_changed"](spark, small_dir)
    assert new.select("Id").distinct().count() == new.count()


def test_run_job_from_files_twice(spark, small_dir):
    """Inputs written as files with the declared schemas; the second run
    starts from the first run's directories and changes no target."""
    import tempfile

    from ledgerloom.plans import runs
    from ledgerloom.sources.schemas import INPUT_SCHEMAS, conform

    work = tempfile.mkdtemp(prefix="ll-job-")
    paths = {}
    for role, df in A.conversion_inputs(Tables(spark, small_dir)).items():
        paths[role] = f"{work}/in/{role}"
        conform(df, INPUT_SCHEMAS[role], allow_missing=True).write.parquet(paths[role])
    root = f"{work}/out"
    first, _ = conversion.run_job(spark, paths, root, exp_date=A.EXP_DATE, as_of=A.AS_OF,
                                  run_id="20240101T000000", full_reload=True)
    second, report = conversion.run_job(spark, paths, root, exp_date=A.EXP_DATE,
                                        as_of=A.AS_OF, run_id="20240102T000000")
    assert runs.last_complete_run(spark, root) == second
    # what the run reports rather than loads is there as tables
    for name in ("AccountsToClose", "RejectedAccounts", "AccountsNotLoaded", "AccountsDeleteOnly", "CardsDeleteOnly"):
        assert runs.read_run(spark, root, name, second) is not None, name
    # the intermediate tables of both runs are gone
    from ledgerloom import session
    import glob
    import os
    left = glob.glob(session.tables_root(spark).removeprefix("file:") + "/run-*")
    assert not [f for folder in left for _, _, files in os.walk(folder) for f in files]
    # writing a finished run again takes its mark back until it is done
    runs.reopen_run(spark, root, second)
    assert runs.last_complete_run(spark, root) == first
    for name in runs.RELOADED_TARGETS:
        a = runs.read_run(spark, root, name, first)
        b = runs.read_run(spark, root, name, second)
        assert same_rows(a, b), name
    steps = {r.step: r.rows for r in report.collect()}
    assert steps["Accounts"] > 0 and set(runs.RELOADED_TARGETS) <= set(steps)


def test_first_run_reports_nothing_missing(two_runs):
    first, _ = two_runs
    steps = {r.step: r.rows for r in first.report.collect()}
    assert steps["qualifying_not_in_accounts"] == 0 and steps["delete_only_keys"] == 0


def test_changed_card_of_an_account_that_no_longer_qualifies_stays(spark, small_dir):
    """Second run: every card changes, some accounts stop qualifying (their
    provider key becomes junk)."""
    inputs = A.conversion_inputs(Tables(spark, small_dir))
    first = conversion.run_conversion(inputs, exp_date=A.EXP_DATE, as_of=A.AS_OF, full_reload=True, report=False)
    before = {r.Id: r for r in first.targets["Cards"].collect()}
    gone = F.col("entryid") % 7 == 3
    later = dict(inputs)
    later["master"] = inputs["master"].withColumn("providerkey", F.when(gone, F.lit("junk")).otherwise(F.col("providerkey")))
    later["cards"] = (inputs["cards"].withColumn("LastUpdateDate", F.col("LastUpdateDate") + F.expr("INTERVAL 10 YEARS"))
                      .withColumn("nameoncard", F.lit("NEW NAME")))
    second = conversion.run_conversion(later, exp_date=A.EXP_DATE, as_of=A.AS_OF, targets=first.targets,
                                       previous_qualifying=first.qualifying, existing_lookup=first.lookup)
    after = {r.Id: r for r in second.targets["Cards"].collect()}
    qualifying = {r.entryid for r in second.qualifying.select("entryid").collect()}
    lost = {i for i, r in before.items() if r.Account_Id not in qualifying}
    assert lost and set(after) == set(before) | {i for i in after if after[i].Account_Id in qualifying}
    assert all(after[i] == before[i] for i in lost)
    assert all(after[i].NameOnCard == "NEW NAME" for i in set(after) - lost)
    assert {r.Id for r in second.cards_delete_only_keys.collect()} == lost
    closed = {r.entryid for r in second.accounts_to_close.collect()}
    assert closed == {r.entryid for r in first.qualifying.select("entryid").collect()} - qualifying
    statuses = {r.Id: r.Status for r in second.targets["Accounts"].collect()}
    assert all(statuses[i] == 40 for i in closed)
    steps = {r.step: r.rows for r in second.report.collect()}
    assert steps["rejected"] > 0 and steps["accounts_to_close"] == len(closed)


def test_repeated_declared_keys_stop_a_job(spark, tmp_path):
    from ledgerloom.sources.schemas import INPUT_SCHEMAS
    paths = {}
    for role, ddl in INPUT_SCHEMAS.items():
        paths[role] = f"{tmp_path}/in/{role}"
        rows = [(7, 1), (7, 2)] if role == "fee_plans" else []
        spark.createDataFrame(rows, ddl).write.parquet(paths[role])
    with pytest.raises(ValueError, match="fee_plans.FeePlanChangeID"):
        conversion.run_job(spark, paths, f"{tmp_path}/out", exp_date=A.EXP_DATE, as_of=A.AS_OF)


def test_checkpoint_folder_of_the_session_is_kept(spark):
    """get_spark never names a checkpoint folder over one that is configured."""
    from ledgerloom import session
    assert "spark.checkpoint.dir" not in session.BASE_CONF
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    again = session.get_spark()
    assert again.sparkContext.getConf().get("spark.checkpoint.dir") == configured
    assert session.checkpoint_root(again).removeprefix("file:").startswith(configured.removeprefix("file:"))
