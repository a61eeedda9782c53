"""The wide pivot's partitions follow the width of its rows."""

import re

from pyspark.sql import functions as F

from ledgerloom.operators import flatten


def test_wide_rows_are_spread_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(flatten, "TASK_BYTES", 8 * 11 * 100)  # a hundred pairs of ten columns
    events = spark.range(300).toDF("id")
    bridge = spark.range(1200).select((F.col("id") % 300).alias("event_id"), (F.col("id") % 7).alias("category_id"))
    categories = spark.range(7).select("id", F.concat(F.lit("c"), F.col("id").cast("string")).alias("Category"))
    domain = [f"c{i}" for i in range(10)]
    wide = flatten.category_counts(events, bridge, categories, domain)
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(id#\d+L?, 12\), REPARTITION_BY_NUM", text), text
    rows = {r["id"]: r for r in wide.collect()}
    assert len(rows) == 300 and all(sum(r[c] for c in domain) == 4 for r in rows.values())
    assert {r["id"] for r in rows.values() if r["c9"]} == set()
    n = sum(1 for i in range(1200) if i % 300 == 5 and i % 7 == 5 % 7)
    assert rows[5]["c5"] == n
