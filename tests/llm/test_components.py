"""Connected components against a plain search."""

import numpy as np
import pytest

from helpers import components_of
from ledgerloom.llm.components import Forest, components


@pytest.mark.parametrize("kind", ["random", "chain", "star", "none"])
def test_components(spark, kind):
    rng = np.random.default_rng(5)
    links = {"random": [tuple(map(int, p)) for p in rng.integers(0, 60, (45, 2))], "chain": [(i, i + 1) for i in range(40)],
             "star": [(50, i) for i in range(50)] + [(50, 3)], "none": []}[kind]
    frame = spark.createDataFrame([*links, (7, None), (None, 7), (8, 8)], "a bigint, b bigint")
    near = np.zeros((61, 61), dtype=bool)
    for a, b in links:
        near[a, b] = near[b, a] = True
    root = components_of(near)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(map(tuple, components(frame).collect())) == sorted((x, int(root[x])) for x in linked)


def test_forest():
    rng = np.random.default_rng(1)
    near = rng.random((50, 50)) < 0.02
    near |= near.T
    forest = Forest(50)
    a, b = np.nonzero(near)
    for part in range(0, len(a), 7):
        forest.add(a[part:part + 7], b[part:part + 7])
    assert (forest.root == components_of(near)).all()
    node, root = forest.links()
    assert len(node) == (forest.root != np.arange(50)).sum() and (forest.root[node] == root).all()
