"""The rules run on narrow rows and give whole ones; comparisons of versions by one digest."""

from ledgerloom.operators import feed, qualify
from ledgerloom.plans import registry as R
from ledgerloom.session import materialize

_MASTER = "entryid long, ssn string, firstname string, AccountTypeId int, accountstatus int, provideraccountID long, note string"


def test_whole_rows_tell_rows_of_one_key_apart(spark):
    rows = [(1, "a", "x", 1, 1, 1, "p"), (1, "a", "x", 2, 1, 1, "q"), (None, "a", "x", 2, 1, None, "r"), (2, "b", None, 1, 6, 2, "s")]
    master = spark.createDataFrame(rows, _MASTER)
    kept = master.where("note IN ('q', 'r', 's')").select(*qualify.RULE_COLUMNS)
    assert {r.note for r in qualify.whole_rows(master, kept).collect()} == {"q", "r", "s"}


def test_qualification_reads_the_narrow_rows_and_writes_them_once(spark, small_dir, monkeypatch):
    from ledgerloom.plans import conversion
    written = []
    monkeypatch.setattr(conversion, "materialize", lambda df, label: (written.append((label, df.columns)), materialize(df, label))[1])
    run = R._full_reload(spark, small_dir)
    got = run.rows_of("qualifying")
    labels = [name for name, _ in written]
    assert labels == ["rule_columns", "kept_rule_columns", "qualified"]  # the kept rows are read from the qualified ones
    assert written[0][1] == qualify.RULE_COLUMNS
    plain = qualify.qualify_accounts(run.i["master"], run.i["cards"], run.i["balances"], run.i["goals"], exp_date=run.exp_date)
    plain = qualify.drop_closed_zero(qualify.append_related(plain, run.i["master"]), run.i["balances"])
    want = qualify.junk_filter(plain)[0].select(*got.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_changed_keys_are_those_of_the_feed(spark):
    schema = "k long, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (2, "y", "z"), (3, "q", "q"), (4, None, "m"), (None, "n", "n")], schema)
    new = spark.createDataFrame([(1, None, "x"), (2, "y", "z"), (4, "m", None), (5, "e", "e"), (None, "n", "n")], schema)
    got, want = feed.changed_keys(old, new, "k"), feed.change_feed(old, new, "k").select("k")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "array" not in got._jdf.queryExecution().optimizedPlan().toString()
