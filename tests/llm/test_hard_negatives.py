"""Hard negatives against brute force on Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives as hn


def brute(rows, step=100, k=5):
    kept = []
    for i, v, l in rows:
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (l + 1) % 10 if i % 7 == 0 else l))
    out = []
    for n, (a, w, l) in enumerate(kept):
        if a % step:
            continue
        scored = [(-sum(p * q for p, q in zip(w, x)), i, m) for j, (i, x, m) in enumerate(kept) if j != n]
        for ps, pi, _ in sorted(s for s in scored if s[2] == l)[:k]:
            window = sorted(s for s in scored if s[2] != l and 80 * -ps <= 100 * -s[0] <= 100 * -ps)[:k]
            out += [(a, pi, r + 1, ni, -ps, -ns) for r, (ns, ni, _) in enumerate(window)]
    return sorted(out)


def run(spark, rows, kind="float", **more):
    frame = spark.createDataFrame([(i, v, l, "q", 1.0, "k") for i, v, l in rows],
                                  f"vec_id bigint, embedding array<{kind}>, label int, id string, score double, key string")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, hn.mine(frame, F.col("id") % 100 == 0, label, **more).collect()))


@pytest.mark.parametrize("more", [{}, {"block_components": 40}])
def test_against_brute_force(spark, more):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 24))
    rows = [(i, (centre[i % 6] + 0.3 * rng.normal(size=24)).astype(np.float32).tolist(), int(rng.integers(4))) for i in range(0, 1500, 2)]
    rows += [(2001 + i, rows[50][1], i % 3) for i in range(90)]  # many equal scores
    want = brute(rows)
    assert len(want) > 100 and run(spark, rows, **more) == want


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.5], 1), (100, None, 1), (2, [float("nan"), 1.0], 1), (3, [float("inf"), 1.0], 2), (4, [None, 1.0], 1), (None, [1.0, 1.0], 2),
            (5, [0.9, 0.5], 2), (6, [2.0], 1), (8, [], 1), (9, [1.0, 0.5], None), (11, [1.0, 0.4], 1), (11, [1.0, 0.4], 1), (12, [0.95, 0.5], 3),
            (200, [1.0, 0.4], 1), (200, [1.0, 0.4], 1), (300, [-1.0, -1.0], 4), (13, [0.0, 0.0], 4), (400, [0.0, 0.0], 4)]
    assert run(spark, rows) == brute(rows) and run(spark, rows)


def test_nothing(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0], 1)]) == [] and run(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []


def test_large_components(spark):
    rows = [(100 * i, [3e6 * (i + 1), -2e6], i % 2) for i in range(4)] + [(1 + i, [3e6 + i, 1e5 * i], i % 3) for i in range(40)]
    assert run(spark, rows, "double") == brute_double(rows)


def brute_double(rows):
    saved = np.float32
    np.float32 = float
    try:
        return brute(rows)
    finally:
        np.float32 = saved


@pytest.mark.parametrize("dims,size", [(1, 3), (64, 200), (700, 5000), (3, 2**20), (130, 2**40)])
def test_exact_products(dims, size):
    rng = np.random.default_rng(dims)
    a, b = (rng.integers(-size, size + 1, size=(9, dims)) for _ in range(2))
    a[0], b[0], b[1] = size, size, -size
    moduli = hn.primes(dims * size * size, dims)
    got = hn.Residues(a.astype(np.float64), moduli).scores(hn.Residues(b.astype(np.float64), moduli), slice(0, 9))
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    half = max(moduli) // 2
    assert half * half * min(dims, hn.DIMS_AT_ONCE) < hn.EXACT
