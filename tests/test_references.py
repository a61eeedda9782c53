"""The check between targets covers every declared reference, none is left out unsaid."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerloom.operators import checks
from ledgerloom.plans import registry as R
from ledgerloom.sources.schemas import TARGET_REFERENCES, TARGET_SCHEMAS, struct


def _targets(spark):
    """Every target with five rows: in the columns of references one value that
    all of them share, one that no other column has (twice), nulls."""
    linked = {(t, c) for child, column, parent, key in TARGET_REFERENCES for t, c in ((child, column), (parent, key))}
    own = {place: 100 + i for i, place in enumerate(sorted(linked))}
    targets = {}
    for name, ddl in TARGET_SCHEMAS.items():
        values = {c: [1, 1, own[name, c], own[name, c], None] if (name, c) in linked else [None] * 5 for c in struct(ddl).names}
        targets[name] = spark.createDataFrame(list(zip(*values.values())), ddl)
    return targets, own


def test_every_declared_reference_is_checked(spark, small_dir, monkeypatch):
    targets, own = _targets(spark)
    monkeypatch.setattr(R, "_full_reload", lambda *a: SimpleNamespace(target=targets.__getitem__))
    got = sorted(map(tuple, E.queries()["j37_target_references"](spark, small_dir).collect()))
    assert got == sorted((child, column, parent, str(own[child, column]), 2) for child, column, parent, _ in TARGET_REFERENCES)


@pytest.mark.parametrize("child, column, parent, key", TARGET_REFERENCES)
def test_the_sql_names_every_declared_reference(child, column, parent, key):
    sql = E.oracle_sql()["j37_target_references"]
    assert f"SELECT '{child}' AS child, '{column}' AS column, '{parent}' AS parent" in sql
    assert f'FROM t_{child.lower()} WHERE "{column}" NOT IN (SELECT "{key}" FROM t_{parent.lower()})' in sql


def test_a_missing_table_is_an_error_if_asked_for(spark):
    parent = spark.createDataFrame([(1,)], "Id int")
    child = spark.createDataFrame([(1,), (2,)], "Parent_Id int")
    tables, linked = {"P": parent, "C": child}, [("C", "Parent_Id", "P", "Id")]
    assert [tuple(r) for r in checks.check_references(tables, linked, missing="fail").collect()] == [("C", "Parent_Id", "P", "2", 1)]
    for absent in (("C", "Parent_Id", "Elsewhere", "Id"), ("Elsewhere", "Id", "P", "Id")):
        with pytest.raises(ValueError, match="Elsewhere"):
            checks.check_references(tables, [*linked, absent], missing="fail")
    with pytest.raises(ValueError):
        checks.check_references(tables, linked, missing="none")


def test_no_target_is_written_a_second_time(spark, small_dir, monkeypatch):
    """The targets of a full reload are tables of its steps already."""
    from ledgerloom.plans import conversion, upkeep
    from ledgerloom.session import materialize
    written = []
    for module in (conversion, upkeep):
        monkeypatch.setattr(module, "materialize", lambda df, label: (written.append(label), materialize(df, label))[1])
    got = E.queries()["j37_target_references"](spark, small_dir)
    assert written.count("cards_loaded") == written.count("addresses_loaded") == written.count("card_numbers") == 1
    assert not {"Cards", "AccountBalances", "AccountCardholders", "Phones"} & set(written) and len(set(written)) == len(written)
    assert got.where(F.col("child") == "Cards").count() > 0
