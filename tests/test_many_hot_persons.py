"""Contact ranks where more persons are hot than are collected."""

from ledgerloom.operators import qualify


def test_accounts_of_many_hot_persons_are_written_once(spark, monkeypatch):
    n = 10050
    rows = spark.range(2 * n).selectExpr(
        "id AS entryid", f"CAST(id % {n} AS string) AS ssn", "CAST(id % 3 AS int) AS AccountTypeId", "1 AS accountstatus",
        "TIMESTAMP_NTZ '2001-01-01' AS activateddate", "TIMESTAMP_NTZ '2001-01-01' AS CreateDate")
    written, write = [], qualify.materialize
    monkeypatch.setattr(qualify, "materialize", lambda df, label: (written.append(label), write(df, label))[1])
    got = qualify.contact_rank(rows, hot_group_rows=1, persons=rows.select("ssn"))
    assert written == ["accounts_to_rank"]
    want = qualify.contact_rank(rows, strategy="window")
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
