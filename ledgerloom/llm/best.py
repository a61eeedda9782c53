"""Best rows of many queries at once, and queries in bounded blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import scratch


class Best:
    """The best ``k`` of each slot seen so far: higher scores, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self.slot, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.floor: dict[int, int] = {}

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ident = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.id, ident])
        order = np.lexsort((ident, -score, slot))
        slot, score, ident = slot[order], score[order], ident[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ident[keep]
        full = place == self.k - 1
        self.floor = dict(zip(slot[full].tolist(), score[full].tolist()))

    def least(self, slots: range) -> np.ndarray:
        """The score that a new row of each slot has to reach."""
        return np.array([self.floor.get(s, -(2**63)) for s in slots], dtype=np.int64)


def in_blocks(rows: DataFrame, blocks: int, most: int, order: list[str]) -> Iterator[pa.Table]:
    """``rows`` (with a unique ``key``) as tables of at most ``most`` rows,
    sorted by ``order``: dealt by hash to ``blocks`` stored parts of about that
    many, each read when its turn comes."""
    spark = rows.sparkSession
    stored = scratch(spark, "blocks")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(max(1, blocks))))
    dealt.repartition("block").write.partitionBy("block").parquet(stored)
    for b in range(blocks):
        whole = spark.read.schema(dealt.schema).parquet(stored).where(F.col("block") == b).toArrow()
        whole = whole.sort_by([(c, "ascending") for c in order])
        for at in range(0, whole.num_rows, most):
            yield whole.slice(at, most)
