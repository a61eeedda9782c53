"""Near-duplicate vectors by an inverted multi-index.

Method: two codebooks, one for each half of the vectors, are fitted apart;
their product grid has codes x codes cells, and every vector lies in the cell
of its nearest centroids. A vector visits cells in the order of the summed
distances of its halves (multi-sequence traversal: a queue over the two sorted
lists of centroids) and stops after the number of cells that reached the
target recall on a sample. Vectors of visited cells are verified by their
exact cosine.

Equal vectors form one class first. Cells are split into blocks of bounded
size on both sides; a block returns a count for each of its vectors and one
link for each linked vector, never all pairs of a group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, pick, sampled
from ledgerloom.llm.components import Forest, components

#: Rows (about) of the sample that fits the codebooks and the stopping rule.
SAMPLE_ROWS = 20_000
#: Rows that a cell should hold, and the most centroids of a codebook.
CELL_ROWS, MOST_CODES = 128, 256
#: Rows (about) of either side of a block.
BLOCK_ROWS = 2_048
#: Numbers (about) that ranking the cells of sampled rows holds at a time.
RANKED = 1 << 22
#: Share of the sample's hardest partners (at the very threshold, in any
#: direction) that traversal must find.
TARGET_RECALL = 0.98


def fit_codebook(rows: np.ndarray, codes: int, turns: int = 15, seed: int = 0) -> np.ndarray:
    """Centroids by Lloyd's algorithm."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), codes, replace=False)]
    for _ in range(turns):
        nearest = distances(rows, centres).argmin(axis=1)
        size = np.bincount(nearest, minlength=codes)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, rows)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows**2).sum(axis=1)[:, None] - 2 * np.einsum("ij,kj->ik", rows, centres) + (centres**2).sum(axis=1)


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cells of the product grid by rising sum of the two distances."""
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    first, second = first.tolist(), second.tolist()
    queue, taken = [(first[a[0]] + second[b[0]], 0, 0)], {}
    while queue:
        _, i, j = heapq.heappop(queue)
        yield a[i], b[j]
        # a cell is queued once both of its predecessors were given
        taken[i, j] = True
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in taken):
            heapq.heappush(queue, (first[a[i + 1]] + second[b[j]], i + 1, j))
        if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in taken):
            heapq.heappush(queue, (first[a[i]] + second[b[j + 1]], i, j + 1))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that
    neither very large nor very small components overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def halves(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = (rows.shape[1] + 1) // 2
    return rows[:, :middle], rows[:, middle:]


class Index:
    """Codebooks and the number of cells to visit, for vectors of one width."""

    def __init__(self, sample: np.ndarray, codes: int, threshold: float, recall: float):
        sample = unit(sample)
        codes = max(1, min(codes, len(np.unique(sample, axis=0)) // 4))
        self.books = [fit_codebook(h, codes) for h in halves(sample)]
        self.codes = codes
        self.visits = codes * codes
        if sample.shape[1] > 1:
            # partners at the threshold in a random direction
            probes = sample[:2000]
            rng = np.random.default_rng(1)
            aside = rng.normal(size=probes.shape)
            aside -= (aside * probes).sum(axis=1, keepdims=True) * probes
            aside /= np.maximum(np.sqrt((aside**2).sum(axis=1, keepdims=True)), 1e-12)
            partners = threshold * probes + np.sqrt(1 - threshold**2) * aside
            rank = np.minimum(self.rank(probes, partners), self.rank(partners, probes))
            self.visits = int(np.quantile(rank, recall, method="higher")) + 1

    def grid(self, rows: np.ndarray) -> list[np.ndarray]:
        return [distances(h, book) for h, book in zip(halves(rows), self.books)]

    def rank(self, rows: np.ndarray, partners: np.ndarray) -> np.ndarray:
        """How many cells a row visits before its partner's cell."""
        one, two = self.grid(rows)
        x, y = [side.argmin(axis=1) for side in self.grid(partners)]
        every = np.arange(len(rows))
        least = one[every, x] + two[every, y]
        # a slice of rows at a time: the grid of cells may be large
        out, step = np.empty(len(rows), dtype=np.int64), max(1, RANKED // self.codes**2)
        for k in range(0, len(rows), step):
            at = slice(k, k + step)
            out[at] = ((one[at, :, None] + two[at, None, :]) < least[at, None, None]).sum(axis=(1, 2))
        return out

    def cells(self, rows: np.ndarray) -> list[list[int]]:
        """The cells that each row visits, its own first."""
        out = []
        for one, two in zip(*self.grid(unit(rows))):
            walk = multi_sequence(one, two)
            out.append([i * self.codes + j for (i, j), _ in zip(walk, range(self.visits))])
        return out


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values])


def compare(probes: pd.DataFrame, inside: pd.DataFrame, cell: int, threshold: float,
            rows_at_once: int = 256) -> pd.DataFrame:
    """Links between the block's probes and the vectors inside the cell.

    Two vectors that visit each other's cells meet twice; the meeting where
    the probe's node is the smaller one counts.
    """
    nodes = pd.unique(np.concatenate([probes["node"].to_numpy(), inside["node"].to_numpy()]))
    at = pd.Series(np.arange(len(nodes)), index=nodes)
    p, q = at[probes["node"]].to_numpy(), at[inside["node"]].to_numpy()
    probe_cell = np.array([v[0] for v in probes["visits"]])
    visits = np.stack([np.asarray(v) for v in inside["visits"]])
    p_copies, q_copies = probes["copies"].to_numpy(), inside["copies"].to_numpy()
    a, b = unit(_matrix(probes["v"])), unit(_matrix(inside["v"]))
    forest, linked = Forest(len(nodes)), np.zeros(len(nodes), dtype=np.int64)
    for start in range(0, len(a), rows_at_once):
        rows = slice(start, start + rows_at_once)
        i, j = np.nonzero(np.einsum("ij,kj->ik", a[rows], b, optimize=True) >= threshold)
        i = i + start
        other = nodes[p[i]] != nodes[q[j]]
        i, j = i[other], j[other]
        for part in range(0, len(i), 100_000):
            x, y = i[part:part + 100_000], j[part:part + 100_000]
            mutual = (visits[y] == probe_cell[x][:, None]).any(axis=1)
            own = ~mutual | (nodes[p[x]] < nodes[q[y]])
            x, y = x[own], y[own]
            np.add.at(linked, p[x], q_copies[y])
            np.add.at(linked, q[y], p_copies[x])
            forest.add(p[x], q[y])
    some = np.flatnonzero(linked)
    return pd.DataFrame({"node": nodes[some], "root": nodes[forest.root[some]], "n": linked[some]})


def near_duplicates(df: DataFrame, threshold: float = 0.93, recall: float = TARGET_RECALL,
                    id_column: str = "vec_id", vector_column: str = "embedding",
                    label_column: str = "label", sample_rows: int = SAMPLE_ROWS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links and components of vectors with equal labels.

    Returns ``id_column``, n_links (other vectors linked directly),
    component_id (smallest id reachable, itself included) and kept (the id is
    the component's), a row for each input row. Vectors that are null, zero or
    hold a null or non-finite component, and those with a null label, link
    with nothing; neither do vectors of different widths. Rows that repeat a
    vector link with each other. Null ids stay null, are no component_id
    unless a component has no other, and are not kept. Tables without rows
    give no rows. Links have a cosine of at least ``threshold`` in double
    precision; those that traversal does not meet are missed (about one in
    fifty of the hardest at the default recall, see ``Index``).

    The codebooks are fitted on a sample of about ``sample_rows`` distinct
    vectors of the commonest width; other widths have one cell each. Every
    vector is indexed.
    """
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    rows = pick(df, id=id_column, v=vector_column, label=label_column).withColumn("v", F.col("v").cast("array<double>"))
    good = (F.col("label").isNotNull() & F.col("v").isNotNull()
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    classes = materialize(
        rows.where("good").groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()).withColumn("width", F.size("v")), "classes")

    sizes = classes.groupBy("width").agg(F.count("*").alias("n"), F.max("copies")).orderBy(F.desc("n"), "width").limit(1).collect()
    width, index = 0, None
    if sizes:
        width, n = sizes[0]["width"], sizes[0]["n"]
        largest = classes.where(F.col("width") == width).groupBy("label").count().agg(F.max("count")).first()[0]
        share = min(1.0, sample_rows / n)
        sample = classes.where(F.col("width") == width).where(sampled(share, "v")).select("v").toPandas()["v"]
        codes = min(MOST_CODES, max(1, round((largest / CELL_ROWS) ** 0.5)))
        index = Index(_matrix(sample), codes, threshold, recall) if len(sample) else None
    shared = spark.sparkContext.broadcast((width, index))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value
        for batch in batches:
            v = batch.column("v").to_pylist()
            visits: list[list[int]] = [[0]] * len(v)
            fit = [i for i, x in enumerate(v) if table is not None and len(x) == known]
            if fit:
                for i, cells in zip(fit, table.cells(np.array([v[i] for i in fit]))):
                    visits[i] = cells
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(visits, pa.list_(pa.int32()))],
                                             names=["node", "label", "width", "v", "copies", "visits"])

    label_kind = df.schema[label_column].dataType.simpleString()
    coded = materialize(classes.select("node", "label", "width", "v", "copies").mapInArrow(
        place, f"node bigint, label {label_kind}, width int, v array<double>, copies bigint, visits array<int>"), "coded")

    # Blocks: a cell's vectors and its probes are split by hash into parts of
    # about block_rows; each part of one meets each part of the other.
    cell = ["label", "width", "cell"]
    parts = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / block_rows)).cast("int")
    probing = coded.select("*", F.explode("visits").alias("cell"))
    counts = materialize(
        probing.groupBy(*cell).agg(F.count("*").alias("probes"), F.count_if(F.col("visits")[0] == F.col("cell")).alias("rows"))
        .select(*cell, parts("probes").alias("probe_parts"), parts("rows").alias("row_parts")), "cells")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    keep = [*cell, "node", "v", "copies", "visits"]
    left = probing.join(counts, cell).select(*keep, F.lit(True).alias("probe"), part("probe_parts").alias("p"),
                                             every("row_parts").alias("r"))
    right = (coded.withColumn("cell", F.col("visits")[0]).join(counts, cell)
             .select(*keep, F.lit(False).alias("probe"), every("probe_parts").alias("p"), part("row_parts").alias("r")))

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        probes, inside = block[block["probe"]], block[~block["probe"]]
        if not len(probes) or not len(inside):
            return pd.DataFrame({"node": np.zeros(0, np.int64), "root": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        return compare(probes, inside, int(block["cell"].iloc[0]), threshold)

    met = materialize(left.unionByName(right).groupBy(*cell, "p", "r")
                      .applyInPandas(meet, "node bigint, root bigint, n bigint"), "met")
    links = met.groupBy("node").agg(F.sum("n").alias("links"))
    roots = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = materialize(classes.select("node", "least").join(roots, "node"), "linked")
    smallest = materialize(linked.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    joined = linked.join(smallest, "root").select("node", "component_id")
    resolved = materialize(
        classes.join(links, "node", "left").join(joined, "node", "left")
        .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component_id", "least").alias("component_id")), "resolved")

    linking = rows.where("good").join(resolved, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linking.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", F.col("component_id").cast(kind).alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
