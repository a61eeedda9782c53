"""Packing of documents into training sequences by cutting stock.

Method: a document's tokens are cut into pieces of the full capacity and one
tail. The tails' histogram of lengths, in units of a few tokens, is the
demand of a cutting-stock linear program; column generation prices patterns by
a knapsack dynamic program (``cutting_stock``). Patterns are used a whole
number of times, and every pattern takes the pieces of a length by their rank:
the n-th piece of a length goes to the pattern copy that holds places up to n.

Spark does the per-document work. The driver sees one count for each length
(at most ``capacity``). Ranks come from counters inside the tasks that
write the pieces and prefix sums of (task, length) counts, so that no task
gathers all pieces of a length.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm import cutting_stock
from ledgerloom.llm.bpe import WORDS, Vocabulary, read_spec
from ledgerloom.llm.common import materialize, pick, text_slices

#: Runs of white space that are taken out of a text before the pattern sees it.
LONG_BLANKS = regex.compile(r"\s{1000,}")
#: Tokens for each unit of the linear program's lengths: the largest of these
#: whose rounding wastes at most this share of all tokens, as long as there
#: are no more lengths than the program takes.
UNITS, LEAST_WASTE, MOST_LENGTHS = (8, 4, 2, 1), 0.01, 256


class Merges:
    """Ids of whole texts by tiktoken's merges under a tokenizers vocabulary.

    In such a vocabulary a merged string's id grows with its merge rank, so
    the ids are those of the tokenizers library (the tests compare both),
    which takes about three times as long. The pattern's look-ahead costs
    tiktoken stack for each character of a run of white space, so all but the
    last character of a long run, one word of the pattern, are taken out first.
    """

    def __init__(self, spec: str):
        vocabulary = Vocabulary(spec)
        self.special, self.split = vocabulary.special, vocabulary.split_special
        ranks = {v: k for k, v in vocabulary.strings.items() if k not in self.special.values()}
        self.coded = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.one_word = tiktoken.Encoding("run", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def ordinary(self, text: str) -> bytes:
        if not LONG_BLANKS.search(text):
            return array("I", self.coded.encode_ordinary(text)).tobytes()
        ids, at = array("I"), 0
        for run in LONG_BLANKS.finditer(text):
            # at the end of the text the whole run is one word
            end = run.end() - (run.end() < len(text))
            ids.extend(self.coded.encode_ordinary(text[at:run.start()]))
            ids.extend(self.one_word.encode_ordinary(text[run.start():end]))
            at = end
        ids.extend(self.coded.encode_ordinary(text[at:]))
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers; special-token strings take their own id."""
        if self.split is None or not any(s in text for s in self.special):
            return self.ordinary(text)
        return b"".join(array("I", [self.special[part]]).tobytes() if part in self.special else self.ordinary(part)
                        for part in self.split.split(text))


_MERGES: dict[bytes, Merges] = {}


def worker_merges(spec: str) -> Merges:
    """One for each vocabulary in a Python worker."""
    key = hashlib.sha1(spec.encode()).digest()
    if key not in _MERGES:
        _MERGES[key] = Merges(spec)
    return _MERGES[key]


def pieces(df: DataFrame, tokenizer_path: str, capacity: int, end_id: int | None,
           id_column: str, text_column: str) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, and its
    task and rank among the task's pieces of that length."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    kind = df.schema[id_column].dataType.simpleString()
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_merges(spec.value)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for whole in batches:
            for batch in text_slices(whole, "text"):
                row, start, length, crc, total = [], [], [], [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    for at in range(0, n, capacity):
                        part = ids[4 * at:4 * (at + capacity)]
                        row.append(i), start.append(at), length.append(len(part) // 4)
                        crc.append(zlib.crc32(part)), total.append(n)
                lengths = np.array(length, dtype=np.int64)
                rank = np.zeros(len(lengths), dtype=np.int64)
                order = np.argsort(lengths, kind="stable")
                distinct, first, count = np.unique(lengths[order], return_index=True, return_counts=True)
                for u, f, c in zip(distinct, first, count):
                    rank[order[f:f + c]] = seen[u] + np.arange(c)
                    seen[u] += c
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(lengths), pa.array(crc, pa.int64()), pa.array(total, pa.int64()),
                     pa.array(np.full(len(row), task, dtype=np.int64)), pa.array(rank)],
                    names=["id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank"])

    picked = pick(df, id=id_column, text=text_column).withColumn("text", F.col("text").cast("string"))
    return picked.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "task long, rank long")


def choose_unit(lengths: dict[int, int], capacity: int) -> int:
    """The unit for a histogram of lengths, by the rule at ``UNITS``."""
    total = sum(k * n for k, n in lengths.items())
    fitting = [u for u in UNITS if capacity % u == 0]
    for unit in fitting:
        rounded = {-(-k // unit) for k in lengths}
        if len(rounded) > MOST_LENGTHS:
            return fitting[max(0, fitting.index(unit) - 1)]
        if sum((-k % unit) * n for k, n in lengths.items()) <= LEAST_WASTE * total:
            return unit
    return fitting[-1]


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int | None = 0,
         id_column: str = "doc_id", text_column: str = "text", gap: float = 0.002) -> DataFrame:
    """Pieces of all documents with the sequence and the offset they go to.

    Returns ``id_column``, start, length, ids_crc32, doc_tokens, sequence_id,
    offset: every id of a document (its text's ids, then ``end_id``) lies in
    exactly one piece, pieces of a sequence follow each other from offset 0,
    and a sequence holds at most ``capacity`` ids. A null or empty text has
    only ``end_id`` (no piece if that is None); repeated rows are packed each;
    a null id stays null; long texts give many full pieces. Tables without
    rows give no rows.
    """
    spark = df.sparkSession
    cut = materialize(pieces(df, tokenizer_path, capacity, end_id, id_column, text_column), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    unit = choose_unit(lengths, capacity)
    demand: dict[int, int] = {}
    for k, n in lengths.items():
        demand[-(-k // unit)] = demand.get(-(-k // unit), 0) + n
    units = F.ceil(F.col("length") / unit).cast("long")
    earlier = W.partitionBy(units).orderBy("length", "task")
    before = counts.select("task", "length", (F.sum("n").over(earlier) - F.col("n")).alias("before"))

    # At most one pattern for each length in use and one for each piece that
    # rounding leaves (fewer than the lengths times their copies): some
    # thousand rows for any corpus.
    slots, sequence, served = [], 0, dict.fromkeys(demand, 0)
    for times, copies in cutting_stock.patterns(demand, capacity // unit, gap):
        place = 0
        for size, per in sorted(copies.items(), reverse=True):
            slots.append((size, served[size], served[size] + times * per, per, sequence, place))
            served[size] += times * per
            place += per
        sequence += times
    plan = spark.createDataFrame(
        slots, "units long, from_rank long, to_rank long, per long, from_sequence long, from_place long")

    ranked = (cut.join(before, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
              .withColumn("units", units))
    placed = ranked.join(F.broadcast(plan), "units").where("rank >= from_rank and rank < to_rank").select(
        F.col("id").alias(id_column), "start", "length", "ids_crc32", "doc_tokens",
        F.expr("from_sequence + (rank - from_rank) div per").alias("sequence_id"),
        F.expr("from_place + (rank - from_rank) % per").alias("place"),
        (F.col("units") == capacity // unit).alias("alone"))
    # A pattern whose single length is the full capacity holds one piece.
    window = W.partitionBy("sequence_id").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    alone = placed.where("alone").withColumn("offset", F.lit(0).cast("long"))
    shared = placed.where("not alone").withColumn("offset", F.coalesce(F.sum("length").over(window), F.lit(0)))
    return alone.unionByName(shared).drop("place", "alone")
