"""A run that follows another: resuming, late accounts, registered outputs."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import loads, qualify
from ledgerloom.plans import conversion, runs
from ledgerloom.session import path_exists
from ledgerloom.sources import analogues as A
from ledgerloom.sources.tables import Tables


class Broken(Exception):
    pass


def commit(spark, small_dir, root, **more):
    options = dict(exp_date=A.EXP_DATE, as_of=A.AS_OF, run_id="20240101T000000") | more
    return conversion.commit_run(spark, A.conversion_inputs(Tables(spark, small_dir)), root, **options)


def test_a_broken_run_goes_on_where_it_stopped(spark, small_dir, tmp_path, monkeypatch):
    root = f"{tmp_path}/out"

    def broken(*args, **kwargs):
        raise Broken

    with monkeypatch.context() as m:
        m.setattr(loads, "load_card_numbers", broken)  # after the cards step
        with pytest.raises(Broken):
            commit(spark, small_dir, root)
    assert runs.last_complete_run(spark, root) is None
    ranked = []
    real = qualify.contact_rank
    with monkeypatch.context() as m:
        m.setattr(qualify, "contact_rank", lambda *a, **k: ranked.append(1) or real(*a, **k))
        m.setattr(loads, "load_cards", broken)  # committed before the failure
        run_id, report = commit(spark, small_dir, root)
    assert not ranked and runs.last_complete_run(spark, root) == run_id
    assert not path_exists(spark, runs.run_path(root, runs.STEPS_TABLE, run_id))
    whole = f"{tmp_path}/whole"
    _, want = commit(spark, small_dir, whole)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, want.collect()))
    for name in ("Accounts", "Cards", "CardNumbers"):
        a, b = (runs.read_run(spark, r, name, run_id) for r in (root, whole))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name


def test_steps_of_other_parameters_are_not_taken_over(spark, tmp_path):
    root = f"{tmp_path}/out"
    first = runs.open_steps(spark, root, "1", {"exp_date": "a"})
    spark.range(3).write.parquet(f"{first}/ranked")
    assert runs.open_steps(spark, root, "1", {"exp_date": "a"}) == first and path_exists(spark, f"{first}/ranked/_SUCCESS")
    runs.open_steps(spark, root, "1", {"exp_date": "b"})
    assert not path_exists(spark, f"{first}/ranked")


def test_one_target_runs_only_the_steps_it_needs(spark, small_dir):
    run = conversion.Conversion(A.conversion_inputs(Tables(spark, small_dir)), exp_date=A.EXP_DATE, as_of=A.AS_OF)
    run.target("CardNumbers")
    assert set(run.step.made) == {"card_numbers"}
    run.target("Cards")
    assert set(run.step.made) == {"card_numbers", "cards_loaded", "ranked", "qualifying", "qualified"}
    with pytest.raises(ValueError):
        conversion.Conversion(run.i, exp_date=A.EXP_DATE, as_of=A.AS_OF, late="sometimes")


def test_late_keys_load_whatever_their_age(spark):
    rows = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-01"), (3, "2022-01-01"), (None, "2020-01-01")], "k bigint, at string")
    rows = rows.withColumn("at", F.col("at").cast("timestamp_ntz"))
    late = spark.createDataFrame([(2,), (2,), (9,), (None,)], "Id bigint")
    got = loads._since(rows, "at", "2021-01-01 00:00:00", "k", late)
    assert got.columns == rows.columns and sorted(r.k for r in got.collect()) == [2, 3]
    assert [r.k for r in loads._since(rows, "at", "2021-01-01 00:00:00", "k", None).collect()] == [3]
