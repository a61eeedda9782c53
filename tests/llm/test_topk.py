"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import topk


def brute(rows, k, step=20):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, w) in enumerate(kept):
        if q % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, x)), c) for m, (c, x) in enumerate(kept) if m != n)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=20, **more):
    frame = spark.createDataFrame([(i, v, "q", 1.0) for i, v in rows], "vec_id bigint, embedding array<float>, id string, score double")
    return sorted(map(tuple, topk.top_k(frame, F.col("id") % 20 == 0, k=k, **more).collect()))


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 40, "query_components": 36}])
def test_against_brute_force(spark, sizes):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=12) * (rng.random(12) < 0.4)).astype(np.float32).tolist()) for i in range(220)]
    rows += [(300 + i, rows[3][1]) for i in range(60)]  # many equal scores
    assert run(spark, rows, **sizes) == brute(rows, 20)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]),
            (5, [-0.01, 0.0]), (6, [2.0]), (7, []), (7, [3.0, 1.0]), (20, [0.0, 0.0]), (20, [0.0, 0.0]), (40, [1e6, -1e6])]
    assert run(spark, rows) == brute(rows, 20)


def test_rows_of_one_id_are_candidates_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.75, 0.0]), (1, [0.5, 0.0]), (20, [1.0, 0.0]), (20, [0.25, 0.0])]
    got = run(spark, rows)
    assert got == brute(rows, 20) and [r[1:] for r in got if r[0] == 0][:3] == [(1, 20, 4096), (2, 1, 3072), (3, 1, 2048)]


def test_fewer_candidates_than_k_and_none(spark):
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []
    assert run(spark, [(0, [1.0]), (1, [1.0])]) == [(0, 1, 1, 4096)]


def test_oracle_sql(spark):
    import duckdb

    from ledgerloom.llm import queries
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{sf}/embeddings.parquet')")
    want = con.execute("select query_id, rank, vec_id, score from (" + queries.ORACLE_SQL["op10_topk"] + ")").fetchall()
    got = queries.op10_topk(spark, sf).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want) and want
