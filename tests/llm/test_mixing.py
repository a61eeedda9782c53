"""Mixing of sources against plain Python."""

import re
from fractions import Fraction

import pytest

from helpers import documents
from ledgerloom.llm import mixing


def plain_targets(sizes, weights=(1, 2, 3), epochs=3):
    """Targets by sharing the excess again and again, in exact fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, excess = dict.fromkeys(order, Fraction(0)), Fraction(sum(sizes.values()))
    open_ = set(order)
    while excess and open_:
        share = sum(w[s] for s in open_)
        for s in open_:
            target[s] += excess * w[s] / share
        excess = Fraction(0)
        for s in list(open_):
            if target[s] > epochs * sizes[s]:
                excess += target[s] - epochs * sizes[s]
                target[s] = Fraction(epochs * sizes[s])
                open_.discard(s)
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    assert len(got) == len(rows)
    assert sorted((str(r[0]), words(r[1])) for r in rows) == sorted((str(g["doc_id"]), g["size"]) for g in got)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    target = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for g in got:
        assert 0 <= g["taken"] <= 3 * g["size"] and g["source_size"] == sizes[g["source"]]
        assert g["target"] == pytest.approx(float(target[g["source"]]), rel=1e-12, abs=1e-9)
        taken[g["source"]] += g["taken"]
    for s, n in taken.items():
        assert abs(n - target[s]) < 1.001, s
    # whole copies but for one document of a source
    for s in sizes:
        odd = [g for g in got if g["source"] == s and g["size"] and g["taken"] % g["size"]]
        assert len(odd) <= 1
        times = {g["taken"] // g["size"] for g in got if g["source"] == s and g["size"]}
        assert max(times, default=0) - min(times, default=0) <= 1


def mixed(spark, rows):
    return mixing.mix(documents(spark, rows)).collect()


def test_against_plain_python(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), "en", f"s{i % 5 if i % 3 else 0}") for i in range(600)]
    rows += [(1000 + i, " x y\tz\x1c\x0b" * (i + 1), "en", "\U0001F600") for i in range(3)]
    rows += [(2000, "big " * 50_000, "en", "￮"), (2001, "a b", "en", "￮")]
    got = mixed(spark, rows)
    check(rows, got)
    again = mixed(spark, rows[::-1])
    key = lambda g: (g["doc_id"], g["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_odd_rows(spark):
    rows = [(None, "a b", "en", None)] * 40 + [(7, "same same", "en", "hot")] * 300 + [
        (1, None, "en", "none"), (2, "", "en", "none"), (3, " \t\n", "en", None), (4, "x", "en", ""), (5, "y z", "en", "b")]
    check(rows, mixed(spark, rows))


def test_nothing(spark):
    assert mixed(spark, []) == []
    got = mixed(spark, [(1, "", "en", "a"), (2, None, "en", None)])
    assert [(g["size"], g["target"], g["taken"]) for g in got] == [(0, 0.0, 0)] * 2


def test_nested_thresholds(spark):
    """A smaller budget's rows are a subset of a larger one's."""
    rows = spark.range(3000).selectExpr("'s' as source", "1 + id % 9 as size", "id as row").withColumn("place", mixing.place(mixing.F.col("row")))
    total = rows.agg(mixing.F.sum("size")).first()[0]
    budgets = spark.createDataFrame([("s", c, total * c // 10) for c in range(1, 10)], "source string, copy int, rest long")
    cuts = {r["copy"]: r for r in mixing.thresholds(rows, budgets).collect()}
    local = sorted((r["place"], r["size"]) for r in rows.collect())
    for c in range(1, 10):
        below = sum(n for p, n in local if p < cuts[c]["place"])
        assert below + cuts[c]["rest"] == total * c // 10
    assert [cuts[c]["place"] for c in range(1, 10)] == sorted(cuts[c]["place"] for c in range(1, 10))


def test_no_python_and_no_sort(spark):
    frame = mixing.mix(documents(spark, [(i, "a b c", "en", f"s{i % 2}") for i in range(50)]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Sort " not in plan


def test_oracle_sql(spark):
    import duckdb

    from ledgerloom.llm import queries
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    for q in ("op11_mixing", "op12_prefix_trie", "op13_hard_negatives"):
        frame = queries.QUERIES[q](spark, sf)
        want = con.execute(f"select {', '.join(frame.columns)} from ({queries.ORACLE_SQL[q]})").fetchall()
        key = lambda r: tuple(map(str, r))
        assert sorted(map(key, frame.collect())) == sorted(map(key, want)) and want, q
