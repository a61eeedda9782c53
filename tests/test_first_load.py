"""What a run loads to a target that nothing was loaded to is the target, written once."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import loads
from ledgerloom.plans import conversion, runs
from ledgerloom.sources import analogues as A
from ledgerloom.sources.tables import Tables


def rows(df):
    return sorted(map(repr, df.collect()))


def test_all_keys_are_late_ones(spark):
    df = spark.createDataFrame([(1, dt.datetime(2001, 1, 1)), (2, None), (None, dt.datetime(2001, 1, 1)), (None, None),
                                (None, dt.datetime(1800, 1, 1)), (3, dt.datetime(1800, 1, 1)), (3, None)], "k long, t timestamp_ntz")
    late = df.select("k").distinct()
    for mark in (None, dt.datetime(2000, 1, 1), dt.datetime(2030, 1, 1)):
        got = loads._since(df, "t", mark, "k", True)
        assert rows(got) == rows(loads._since(df, "t", mark, "k", late)) and got.count() >= 4
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_targets_of_a_first_run_are_those_merged_into_empty_ones(spark, small_dir):
    inputs = A.conversion_inputs(Tables(spark, small_dir))
    for late in ("load", "report"):
        options = dict(exp_date=A.EXP_DATE, as_of=A.AS_OF, late=late)
        first = conversion.Conversion(inputs, **options)
        merged = conversion.Conversion(inputs, targets=runs.empty_targets(spark), **options)
        for name in conversion.TARGETS:
            got, want = first.target(name), merged.target(name)
            assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
            assert rows(got) == rows(want) != []
        assert not {"accounts", "cardholders", "changed_cardholders"} & set(first.step.made)
        assert {"accounts", "cardholders", "changed_cardholders"} <= set(merged.step.made)


def test_a_first_run_writes_its_targets_once(spark, small_dir, tmp_path, monkeypatch):
    root, written, write, made = str(tmp_path), [], runs.write_run, []
    monkeypatch.setattr(runs, "write_run", lambda df, root, table, run_id: (written.append(table), write(df, root, table, run_id))[1])
    real = conversion.Steps.__call__
    monkeypatch.setattr(conversion.Steps, "__call__", lambda self, name, build: (made.append(name), real(self, name, build))[1])
    t = Tables(spark, small_dir)
    only = ("Accounts", "Addresses", "Cardholders")
    inputs = A.conversion_inputs(t)
    for run_id, tables in (("1", [runs.REPORT_TABLE]), ("2", ["Addresses", runs.REPORT_TABLE])):
        written.clear(), made.clear()
        conversion.commit_run(spark, inputs, root, exp_date=A.EXP_DATE, as_of=A.AS_OF, run_id=run_id, only=only, rule_rows=A.rule_rows(t))
        assert written == tables
        assert ("accounts" in made) == ("cardholders" in made) == ("changed_cardholders" in made) == (run_id == "2")
    for name in only:  # nothing changed between the runs
        got, want = runs.read_run(spark, root, name, "1"), runs.read_run(spark, root, name, "2")
        assert got.columns == want.columns and rows(got) == rows(want) != []


def test_kept_keys_are_written_for_their_readers(spark, small_dir, monkeypatch):
    t, seen = Tables(spark, small_dir), []
    write = conversion.materialize
    monkeypatch.setattr(conversion, "materialize", lambda df, label: (seen.append((label, df.columns)), write(df, label))[1])
    among = lambda keys: (seen.append(keys.inputFiles() != []), A.accounts_master(t, keys))[1]
    run = conversion.Conversion(A.conversion_inputs(t), exp_date=A.EXP_DATE, as_of=A.AS_OF, master_among=among, rule_rows=A.rule_rows(t))
    keys = run.qualified().select("entryid")
    assert seen[-3:-1] == [("kept_keys", ["entryid"]), True] and seen[-1][0] == "qualified"
    assert keys.count() == keys.distinct().count() == keys.where(F.col("entryid").isNotNull()).count() > 0
