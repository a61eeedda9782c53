"""Hard-negative mining with exact scores from a residue number system.

Method: vectors become whole numbers. Their matrices are reduced modulo
several small primes, centred round zero, and multiplied in float32, where
every sum of products stays below 2^24 and is therefore exact. The products'
residues give the signed score back by Chinese remaindering (mixed digits, one
prime at a time). There are as many primes as the largest possible score
needs. A window on the scores, drawn from each positive's score, then selects
the negatives.

Anchors are read in blocks of a bounded number of components, one block after
another; each is broadcast and every task runs it against its own candidates,
batch by batch, keeping the best few for each anchor as it goes. A task hands
on its answers once, so they grow with anchors x tasks, and no candidate is
moved at all. Each block's answers are a written table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.best import Best, in_blocks
from ledgerloom.llm.common import materialize, name

#: Components (anchors x dimensions) of a block that is broadcast, 8 bytes each.
BLOCK_COMPONENTS = 1 << 21
#: Scores that are held at the same time.
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 128, 2048
#: Dimensions that one float32 product adds up; primes stay below 2^24 / that.
DIMS_AT_ONCE = 64
#: float32 holds every whole number up to here.
EXACT = 1 << 24


def primes(largest: int, dims: int) -> list[int]:
    """Primes whose product exceeds twice ``largest``, from the highest for
    which ``dims`` products of centred residues stay exact in float32."""
    top = 2 * int((EXACT / max(1, min(dims, DIMS_AT_ONCE))) ** 0.5)
    out, product, n = [], 1, top - 1 | 1
    while product <= 2 * largest + 1:
        n -= 2
        if all(n % d for d in range(3, int(n ** 0.5) + 1, 2)):
            out.append(n)
            product *= n
    return out


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """The whole numbers of ``matrix`` (float64) modulo ``prime``, centred."""
    r = np.fmod(matrix, prime)  # exact for floating-point whole numbers
    half = prime // 2
    r[r > half] -= prime
    r[r < -half] += prime
    return r.astype(np.float32)


class Residues:
    """A matrix as its residue matrices."""

    def __init__(self, matrix: np.ndarray, moduli: list[int]):
        self.moduli, self.rows = moduli, len(matrix)
        self.parts = [residues(matrix, p) for p in moduli]

    def take(self, rows: np.ndarray) -> Residues:
        out = Residues(np.zeros((0, 0)), [])
        out.moduli, out.rows, out.parts = self.moduli, len(rows), [part[rows] for part in self.parts]
        return out

    def scores(self, other: Residues, rows: slice) -> np.ndarray:
        """Exact inner products of ``rows`` with all rows of ``other``: int64,
        or Python integers where 64 bits may not hold them."""
        product = reduce(lambda a, b: a * b, self.moduli, 1)
        kind = np.int64 if product < 2**62 else object
        digits: list[np.ndarray] = []
        for p, a, b in zip(self.moduli, self.parts, other.parts):
            r = np.zeros((len(a[rows]), other.rows), dtype=np.int64)
            for at in range(0, a.shape[1], DIMS_AT_ONCE):
                r += (a[rows, at:at + DIMS_AT_ONCE] @ b[:, at:at + DIMS_AT_ONCE].T).astype(np.int64)
            # the next digit of the number written to the bases of the moduli
            known, base = np.zeros_like(r), 1
            for q, d in zip(self.moduli, digits):
                known += d * (base % p)
                base *= q
            digits.append((r - known) * pow(base % p, -1, p) % p)
        total, base = np.zeros((len(self.parts[0][rows]), other.rows), dtype=kind), 1
        for q, d in zip(self.moduli, digits):
            total += d.astype(kind) * base
            base *= q
        return np.where(total > product // 2, total - product, total)


def matrix(column: pa.Array, scale: int, dims: int) -> np.ndarray:
    """floor(scale * x) of a list column as float64 rows of ``dims`` components, shorter ones padded by zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < lengths[:, None]] = np.floor(flat * scale)
    return out


def clipped(scores: np.ndarray) -> np.ndarray:
    """Scores as int64; what 64 bits cannot hold stops at their ends."""
    return scores if scores.dtype != object else np.clip(scores, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def _answers(found: Iterator[Best]) -> Iterator[pa.RecordBatch]:
    for best in found:
        yield pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.id), pa.array(best.score)], names=["slot", "id", "score"])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_AT_ONCE):
            yield whole.slice(at, ROWS_AT_ONCE)


def _column(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


def positives_of(block, moduli: list[int], scale: int, k: int):
    """A task's best ``k`` rows of the anchor's own label, for each anchor (slot)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        anchors = Residues(held["vectors"], moduli)
        parts = [(slice(at, min(at + ANCHORS_AT_ONCE, anchors.rows)), Best(k)) for at in range(0, anchors.rows, ANCHORS_AT_ONCE)]
        for batch in _batches(batches):
            rows = Residues(matrix(batch.column("v"), scale, held["vectors"].shape[1]), moduli)
            labels, ids, keys = _column(batch, "label"), _column(batch, "id"), _column(batch, "key")
            for some, best in parts:
                own = np.flatnonzero(np.isin(labels, held["label"][some]))
                score = clipped(anchors.scores(rows.take(own), some))
                good = (labels[own] == held["label"][some, None]) & (keys[own] != held["key"][some, None])
                good &= score >= best.least(range(some.start, some.stop))[:, None]
                a, r = np.nonzero(good)
                best.add(a + some.start, score[a, r], ids[own[r]])
        yield from _answers(best for _, best in parts)
    return run


def negatives_of(block, moduli: list[int], scale: int, k: int):
    """A task's best ``k`` rows of other labels within each positive's window
    (slot: the positive's place in the block's list)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        anchors, of = Residues(held["vectors"], moduli), held["slot_anchor"]
        parts = []
        for at in range(0, anchors.rows, ANCHORS_AT_ONCE):
            first, last = (int(x) for x in np.searchsorted(of, [at, at + ANCHORS_AT_ONCE]))
            if first < last:
                parts.append((slice(at, min(at + ANCHORS_AT_ONCE, anchors.rows)), slice(first, last), Best(k)))
        for batch in _batches(batches):
            rows = Residues(matrix(batch.column("v"), scale, held["vectors"].shape[1]), moduli)
            labels, ids = _column(batch, "label"), _column(batch, "id")
            for some, slots, best in parts:
                mine = of[slots] - some.start
                score = clipped(anchors.scores(rows, some))[mine]
                good = (labels != held["label"][some, None])[mine]
                good &= (score >= held["from"][slots, None]) & (score <= held["to"][slots, None])
                good &= score >= best.least(range(slots.start, slots.stop))[:, None]
                s, r = np.nonzero(good)
                best.add(s + slots.start, score[s, r], ids[r])
        yield from _answers(best for *_, best in parts)
    return run


def _best_rows(partial: DataFrame, k: int, *keys: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(df: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding",
         block_components: int = BLOCK_COMPONENTS) -> DataFrame:
    """The hardest negatives of each anchor and positive.

    ``is_anchor``: condition on the id, here called ``id``; ``label``: each
    row's label, from the columns of ``df``. A score is the integer inner
    product of floor(scale * x). An anchor's positives are its ``positives``
    best other rows of the same label; the negatives of a positive are the
    ``negatives`` best rows of another label whose score is from ``low`` to
    ``high`` hundredths of the positive's. Higher scores come first, ties go to
    the smaller id. Returns anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part; shorter vectors count as padded with zeros; a repeated id is
    a row of its own each time (as an anchor it gives its rows each time, and
    its other rows may be its positives). Scores beyond 64 bits stop at their
    ends. Anchors without positives or negatives give no rows, nor do empty
    tables.
    """
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    good = F.forall(name(vector_column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < float("inf")))
    rows = materialize(df.select(name(id_column).cast("long").alias("id"), label.cast("long").alias("label"), name(vector_column).alias("v"))
                       .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(good)
                       .withColumn("key", F.monotonically_increasing_id()), "vectors")
    size = F.array_max(F.transform("v", lambda x: F.abs(x).cast("double")))
    known = rows.agg(F.max(F.size("v")).alias("dims"), F.max(size).alias("largest"), F.count_if(is_anchor).alias("anchors")).first()
    dims = known["dims"] or 1
    largest = int(np.ceil(float(known["largest"] or 0.0) * scale)) + 1
    moduli = primes(dims * largest * largest, dims)
    per_block = max(1, block_components // dims)
    blocks = -(-known["anchors"] // per_block)
    # few enough tasks that their answers, which are handed on once for each, stay few
    candidates = rows.coalesce(2 * spark.sparkContext.defaultParallelism)
    answer, found = "slot long, id long, score long", None
    for table in in_blocks(rows.where(is_anchor), blocks, per_block, ["label", "key"]):
        held = {"vectors": matrix(table.column("v").combine_chunks(), scale, dims), "label": table.column("label").to_numpy(),
                "key": table.column("key").to_numpy()}
        ids = table.column("id").to_numpy()
        sent = spark.sparkContext.broadcast(held)
        near = _best_rows(candidates.mapInArrow(positives_of(sent, moduli, scale, positives), answer), positives, "slot")
        near = near.orderBy("slot", "rank").toArrow()  # at most ``positives`` rows for each anchor of the block
        of, score = near.column("slot").to_numpy(), near.column("score").to_numpy()
        if not len(of):
            continue
        # whole scores n with low * score <= 100 * n <= high * score
        held |= {"slot_anchor": of, "from": np.array([-(-low * int(s) // 100) for s in score], dtype=np.int64),
                 "to": np.array([high * int(s) // 100 for s in score], dtype=np.int64)}
        sent = spark.sparkContext.broadcast(held)
        slots = spark.createDataFrame(pa.table({
            "slot": np.arange(len(of)), "anchor_id": ids[of], "positive_id": near.column("id").to_numpy(), "positive_score": score}))
        hard = _best_rows(candidates.mapInArrow(negatives_of(sent, moduli, scale, negatives), answer), negatives, "slot")
        part = materialize(hard.join(slots, "slot").select(
            F.col("anchor_id").cast(kind).alias("anchor_id"), F.col("positive_id").cast(kind).alias("positive_id"), "rank",
            F.col("id").cast(kind).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "hard_negatives")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, "
                                         "positive_score long, negative_score long")
    return found
