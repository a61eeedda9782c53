"""The inverted multi-index against all pairs."""

import numpy as np
import pytest

from helpers import components_of
from ledgerloom.llm import multi_index


def brute(rows, threshold=0.93):
    n = len(rows)
    near = np.zeros((n, n), dtype=bool)
    good = [v is not None and l is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
            for _, v, l in rows]
    for a in range(n):
        for b in range(a):
            if good[a] and good[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], dtype=np.float32).astype(float), np.array(rows[b][1], dtype=np.float32).astype(float)
                near[a, b] = near[b, a] = x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold
    root = components_of(near)
    least = {}
    for (i, *_), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return near, sorted(((i, int(near[k].sum()), least.get(r), i is not None and i == least.get(r))
                         for k, ((i, *_), r) in enumerate(zip(rows, root))), key=str)


def run(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, l, 1, "n") for i, v, l in rows],
                                  "vec_id bigint, embedding array<float>, label int, node int, id string")
    return sorted(map(tuple, multi_index.near_duplicates(frame, **more).collect()), key=str)


@pytest.mark.parametrize("blocks", [2048, 8])
def test_groups_and_odd_vectors(spark, blocks):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(12):
        centre = rng.normal(size=16)
        rows += [(len(rows) + k, (centre + 0.02 * rng.normal(size=16)).tolist(), g % 3) for k in range(1 + g * 3)]
    n = len(rows)
    rows += [(n + k, rows[50][1], rows[50][2]) for k in range(30)]  # copies of one vector
    rows += [(n + 40, None, 1), (n + 41, [0.0] * 16, 1), (n + 42, [float("nan")] + [1.0] * 15, 1), (n + 43, [None] + [1.0] * 15, 1),
             (n + 44, rows[50][1], None), (n + 45, [1.0, 2.0], 1), (n + 46, [2.0, 4.0], 1), (None, rows[50][1], rows[50][2]),
             (n + 47, (np.array(rows[50][1]) * 3).tolist(), rows[50][2]), (n + 48, [], 1), (3, rows[3][1], rows[3][2])]
    assert run(spark, rows, block_rows=blocks) == brute(rows)[1]


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(300):
        x = rng.normal(size=32)
        x /= np.linalg.norm(x)
        aside = rng.normal(size=32)
        aside -= aside @ x * x
        aside /= np.linalg.norm(aside)
        rows += [(2 * k, x.tolist(), 0), (2 * k + 1, (0.935 * x + np.sqrt(1 - 0.935**2) * aside).tolist(), 0)]
    near, _ = brute(rows)
    got = sum(r[1] for r in run(spark, rows))
    assert near.sum() >= 600 and 0.9 * near.sum() <= got <= near.sum()


def test_multi_sequence_gives_cells_by_distance():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    sums = [a[i] + b[j] for i, j in multi_index.multi_sequence(a, b)]
    assert len(sums) == 35 and np.allclose(sums, np.sort((a[:, None] + b[None]).ravel()))


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 2)]) == [(1, 0, 1, True)]


def test_ranks_in_slices_equal_whole_ones(monkeypatch):
    rng = np.random.default_rng(3)
    index = multi_index.Index(rng.normal(size=(400, 8)), 12, 0.93, 0.9)
    rows, partners = rng.normal(size=(100, 8)), rng.normal(size=(100, 8))
    want = []
    for row, partner in zip(rows, partners):
        (one, two), (x, y) = index.grid(row[None]), index.grid(partner[None])
        sums = one[0][:, None] + two[0][None, :]
        want.append(int((sums < sums[x[0].argmin(), y[0].argmin()]).sum()))
    for held in (1 << 22, 300, 1):
        monkeypatch.setattr(multi_index, "RANKED", held)
        assert index.rank(rows, partners).tolist() == want
