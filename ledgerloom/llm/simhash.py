"""Near-duplicate documents by SimHash and tiled exact comparison.

Method: every document gets a 64-bit fingerprint of its word shingles.
Distinct fingerprints are dealt into tiles of one population count each; a
pair of tiles is compared by numpy exclusive-or and bit counts unless their
population counts differ by more than the radius (two fingerprints differ in
at least that many bits). Inside a pair of tiles the fingerprints are sorted
by the count of their low half, and blocks of rows only meet the run of rows
whose two half counts are near enough. No pair within the radius is missed.

A pair of tiles returns one link for each fingerprint that it links, so that
a large group of near copies never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, pick, text_slices
from ledgerloom.llm.components import Forest, components
from ledgerloom.llm.xxh64 import xxh64

BITS, SEED = 64, 42
#: Shingles that are hashed at the same time.
SHINGLES_AT_ONCE = 200_000
#: A tile has a share of the distinct fingerprints, within these bounds: small
#: tiles give more tasks, large ones are copied to fewer partners.
TILE_SHARE, LEAST_TILE, MOST_TILE = 32, 4_096, 65_536
#: Fingerprints of one side that meet a run of the other at the same time.
ROWS_AT_ONCE = 64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# the bits of a byte, each in a byte of its own
_LANES = np.array([sum((v >> b & 1) << (8 * b) for b in range(8)) for v in range(256)], dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """Fingerprints (uint64) of a string array without nulls."""
    n = len(texts)
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = texts.buffers()[2]
    low = int(ends[0]) if n else 0
    data = _LOWER[np.frombuffer(raw, dtype=np.uint8)[low:int(ends[-1])]] if raw is not None and n else np.zeros(0, np.uint8)
    ends = ends - low
    out = np.zeros(n, dtype=np.uint64)
    if not len(data):
        return out
    space = _SPACE[data]
    # document borders cut words as white space does
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[ends] = True
    begins = ~space & (edge[:-1] | np.concatenate([[True], space[:-1]]))
    stops = ~space & (edge[1:] | np.concatenate([space[1:], [True]]))
    first, last = np.flatnonzero(begins), np.flatnonzero(stops)
    if not len(first):
        return out
    # words with one space between them: a kept space follows each word
    keep = ~space
    keep[1:] |= stops[:-1] & space[1:]
    place = np.cumsum(keep) - 1
    packed = data[keep]
    packed[space[keep]] = 0x20
    word_start, word_end = place[first], place[last] + 1
    words = np.diff(np.searchsorted(first, ends))
    at = np.cumsum(words) - words
    shingles = np.where(words >= shingle, words - shingle + 1, (words > 0).astype(np.int64))
    width = np.minimum(words, shingle)
    total = int(shingles.sum())
    doc_end = np.cumsum(shingles)
    ones = np.zeros((n, BITS), dtype=np.int64)
    for a in range(0, total, SHINGLES_AT_ONCE):
        index = np.arange(a, min(total, a + SHINGLES_AT_ONCE))
        doc = np.searchsorted(doc_end, index, side="right")
        word = at[doc] + index - (doc_end[doc] - shingles[doc])
        begin = word_start[word]
        h = xxh64(packed, begin, word_end[word + width[doc] - 1] - begin, SEED)
        # eight counters to a word: a run of 255 shingles cannot overflow one
        run = (index - (doc_end[doc] - shingles[doc])) % 255 == 0
        run[0] = True
        starts = np.flatnonzero(run)
        octets = h.astype("<u8").view(np.uint8).reshape(-1, 8)
        sums = np.stack([np.add.reduceat(_LANES[octets[:, k]], starts) for k in range(8)], axis=1)
        np.add.at(ones, doc[starts], sums.astype("<u8").view(np.uint8).reshape(-1, BITS))
    major = (2 * ones > shingles[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(n)


def fingerprints(df: DataFrame, shingle: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and ``fp`` (bigint with the fingerprint's bits) for each row.

    Texts are lower-cased in A-Z; words are runs of bytes other than ASCII
    white space; shingles are ``shingle`` words joined by single spaces,
    repeats included (a text with fewer words has its whole sequence as its
    only shingle). A bit is set when it is set in over half of the shingles'
    XXH64 hashes. Null, empty and blank texts have fingerprint zero. Working
    memory follows the longest text, not the table.
    """
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text", 1 << 20):
                found = fingerprints_of(batch.column("text"), shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(found.view(np.int64))], names=["id", "fp"])

    picked = pick(df, id=id_column, text=text_column).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    return picked.mapInArrow(run, f"id {kind}, fp bigint")


def near(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in a, in b) of the pairs within the radius, in runs."""
    half = np.uint64(0xFFFFFFFF)
    order_a, order_b = (np.argsort(np.bitwise_count(x & half), kind="stable") for x in (a, b))
    a, b = a[order_a], b[order_b]
    low_a, low_b = (np.bitwise_count(x & half).astype(np.int64) for x in (a, b))
    count_a, count_b = (int(np.bitwise_count(x[0])) if len(x) else 0 for x in (a, b))
    # |low - low'| + |(count - low) - (count' - low')| <= radius
    apart = count_b - count_a
    lo, hi = (apart - radius + 1) // 2, (apart + radius) // 2
    for at in range(0, len(a), ROWS_AT_ONCE):
        rows = a[at:at + ROWS_AT_ONCE]
        some = low_a[at:at + ROWS_AT_ONCE]
        left = np.searchsorted(low_b, some[0] + lo, side="left")
        right = np.searchsorted(low_b, some[-1] + hi, side="right")
        if left < right:
            hit = np.bitwise_count(rows[:, None] ^ b[None, left:right]) <= radius
            if hit.any():
                i, j = np.nonzero(hit)
                yield order_a[at + i], order_b[left + j]


def near_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) that join exactly
    those which reach each other by steps of at most ``radius`` bits."""
    counted = distinct.select("fp", F.bit_count("fp").alias("ones"))
    rows = [0] * (BITS + 1)
    for r in counted.groupBy("ones").count().collect():  # at most 65 rows
        rows[r["ones"]] = r["count"]
    size = min(MOST_TILE, max(LEAST_TILE, sum(rows) // TILE_SHARE))
    tiles = [-(-n // size) for n in rows]
    base = [sum(tiles[:k]) for k in range(BITS + 2)]
    table = lambda values: F.array(*[F.lit(int(v)) for v in values])
    low = table(base[max(0, k - radius)] for k in range(BITS + 1))
    high = table(base[min(BITS, k + radius) + 1] - 1 for k in range(BITS + 1))

    chunk = F.pmod(F.xxhash64("fp"), F.greatest(F.get(table(tiles), F.col("ones")), F.lit(1))).cast("int")
    tiled = (counted.withColumn("tile", F.get(table(base), F.col("ones")) + chunk)
             .groupBy("tile", "ones").agg(F.collect_list("fp").alias("fps")))  # a tile's rows are bounded
    paired = tiled.select(
        F.explode(F.sequence(F.get(low, F.col("ones")), F.get(high, F.col("ones")))).alias("other"), "tile", "fps",
    ).select(F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "tile", "fps")

    def compare(pair: pd.DataFrame) -> pd.DataFrame:
        pair = pair.sort_values("tile")
        sides = [np.asarray(x, dtype=np.int64).view(np.uint64) for x in pair["fps"]]
        a, b = sides[0], sides[-1]
        nodes = np.concatenate(sides)
        shift = len(a) if len(sides) > 1 else 0
        forest = Forest(len(nodes))
        for i, j in near(a, b, radius):
            forest.add(i, shift + j)
        node, root = forest.links()
        return pd.DataFrame({"a": nodes[node].view(np.int64), "b": nodes[root].view(np.int64)})

    return paired.groupBy("left", "right").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(df: DataFrame, shingle: int = 4, radius: int = 4,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each document with its fingerprint and the smallest id that it reaches.

    Documents link when their fingerprints differ in at most ``radius`` bits.
    Returns ``id_column``, fingerprint (16 lower-case hex digits) and
    component_id, a row for each input row; rows that repeat share a
    fingerprint. Null ids stay null and are never a component_id unless a
    component has no other. Null and empty texts have fingerprint zero and
    link like any other. Tables without rows give no rows.
    """
    coded = materialize(fingerprints(df, shingle, id_column, text_column), "fingerprints")
    classes = materialize(coded.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(near_links(classes.select("fp"), radius))
    linked = materialize(classes.join(roots, classes["fp"] == roots["node"]).select("fp", "root", "least"), "linked")
    smallest = materialize(linked.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    joined = linked.join(smallest, "root").select("fp", "component_id")
    resolved = materialize(classes.join(joined, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")), "resolved")
    return coded.join(resolved, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
