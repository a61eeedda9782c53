"""Exact top-k search over integer vectors, term at a time.

Method: a block of vectors becomes postings: for each component (term) the
rows where it is not zero and their weights. A query is a sparse row; for each
of its terms the term's postings, weighted, are added into the query's dense
score array over the block. Partition selection keeps the block's k best, and
the answers of the blocks are merged.

Queries are read in blocks of a bounded number of components, one block after
another; each is broadcast, and every task runs it against its own candidates,
block by block, merging as it goes. A task hands on its answers once, so they
grow with queries x tasks, and no candidate is moved at all. The answers of
each block of queries are a written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.best import Best, in_blocks
from ledgerloom.llm.common import materialize, name

#: Components (queries x dimensions) of a block of queries, 8 bytes each.
QUERY_COMPONENTS = 1 << 21
#: Candidates of a block.
BLOCK_ROWS = 8_192
#: Score arrays that are filled at the same time.
QUERIES_AT_ONCE = 16


def quantise(column: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as bigint; null for a null vector
    and for one that holds a null or non-finite component."""
    as_double = F.transform(column, lambda x: x.cast("double"))
    good = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(column.isNotNull() & good, F.transform(as_double, lambda x: F.floor(x * scale)))


def postings(block: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """For each term its rows and weights; a term that most rows have is kept
    as a whole column, which is the same list with explicit zeros."""
    out = []
    for column in np.ascontiguousarray(block.T):
        rows = np.flatnonzero(column)
        out.append((slice(None), column) if 2 * len(rows) > len(column) else (rows, column[rows]))
    return out


def best(queries: np.ndarray, query_keys: np.ndarray, block: np.ndarray, ids: np.ndarray, keys: np.ndarray,
         k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's k best rows of the block: (query's place, ids, scores).
    ``ids`` ascend, so that equal scores go to the smaller id; a query's own
    row is the one of its key."""
    terms = min(queries.shape[1], block.shape[1])
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * max(terms, 1)
    kind = np.int32 if largest < 2**31 else np.int64
    listed = postings(block[:, :terms].astype(kind))
    weights = queries[:, :terms].astype(kind)
    n, own = len(ids), dict(zip(keys.tolist(), range(len(keys))))
    position = np.arange(n, dtype=np.int64)
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        some = weights[at:at + QUERIES_AT_ONCE]
        scores = np.zeros((len(some), n), dtype=kind)
        product = np.empty(n, dtype=kind)
        for term, (rows, values) in enumerate(listed):
            for q in np.flatnonzero(some[:, term]):
                if isinstance(rows, slice):
                    scores[q] += np.multiply(values, some[q, term], out=product)
                else:
                    scores[q, rows] += values * some[q, term]
        for q, row in enumerate(scores):
            skip = own.get(int(query_keys[at + q]), -1)
            wanted = min(k + (skip >= 0), n)
            # the wanted-th score bounds the answer; among equals the order decides
            bound = np.partition(row, n - wanted)[n - wanted]
            keep = position[row >= bound]
            keep = keep[keep != skip]
            keep = keep[np.lexsort((keep, -row[keep].astype(np.int64)))][:k]
            if len(keep):
                yield at + q, ids[keep], row[keep].astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), dtype=np.int64)
    out[np.arange(dims) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _search(sent, k: int, block_rows: int):
    """A task's k best of its candidates for each query (slot) of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, query_keys = sent.value
        found = Best(k)
        for whole in batches:
            for at in range(0, whole.num_rows, block_rows):
                part = whole.slice(at, block_rows)
                ids, keys = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
                order = np.argsort(ids, kind="stable")
                block = _matrix(part.column("v"), queries.shape[1])[order]
                answers = list(best(queries, query_keys, block, ids[order], keys[order], k))
                if answers:
                    found.add(np.repeat([a[0] for a in answers], [len(a[1]) for a in answers]),
                              np.concatenate([a[2] for a in answers]), np.concatenate([a[1] for a in answers]))
        yield pa.RecordBatch.from_arrays([pa.array(found.slot), pa.array(found.id), pa.array(found.score)], names=["slot", "id", "score"])
    return run


def top_k(df: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
          vector_column: str = "embedding", scale: int = 64,
          block_rows: int = BLOCK_ROWS, query_components: int = QUERY_COMPONENTS) -> DataFrame:
    """The k rows with the highest integer inner product for each query row.

    ``is_query``: condition on the id column, here called ``id``. Returns
    query_id, rank (from 1), ``id_column``, score; ties go to the smaller id,
    and a query with fewer candidates returns all. Rows with a null id, a null
    vector or a null or non-finite component take no part; a repeated id is a
    row of its own each time (as a query it gives its answer each time, in
    which its other rows may stand); shorter vectors count as padded with
    zeros. Components are taken to fit 31 bits after scaling. Empty tables
    give no rows.
    """
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    rows = materialize(df.select(name(id_column).cast("long").alias("id"), quantise(name(vector_column), scale).alias("v"))
                       .where("id is not null and v is not null").withColumn("key", F.monotonically_increasing_id()), "vectors")
    known = rows.agg(F.count_if(is_query).alias("queries"), F.max(F.size("v")).alias("dims")).first()
    dims = max(1, known["dims"] or 0)
    per_block = max(1, query_components // dims)
    # few enough tasks that their answers, which are handed on once for each, stay few
    candidates = rows.coalesce(2 * spark.sparkContext.defaultParallelism)
    order = W.partitionBy("slot").orderBy(F.desc("score"), F.asc("id"))
    found = None
    for table in in_blocks(rows.where(is_query), -(-known["queries"] // per_block), per_block, ["key"]):
        sent = spark.sparkContext.broadcast((_matrix(table.column("v").combine_chunks(), dims), table.column("key").to_numpy()))
        slots = spark.createDataFrame(pa.table({"slot": np.arange(table.num_rows), "query_id": table.column("id").to_numpy()}))
        partial = candidates.mapInArrow(_search(sent, k, block_rows), "slot long, id long, score long")
        ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        part = materialize(ranked.join(slots, "slot").select(
            F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("id").cast(kind).alias(id_column), "score"), "top_k")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], f"query_id {kind}, rank int, `{id_column}` {kind}, score long")
