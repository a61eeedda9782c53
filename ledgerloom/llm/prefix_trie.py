"""A trie of conversation prefixes, screened by a count-min sketch.

Method: a turn is a digest of its role and text, and a prefix is a digest that
each further turn extends, so texts are read once and never moved. Every task
counts its prefixes in a count-min sketch; the sketches are added up and what
they leave unproven is sent to all tasks as bits. A prefix whose estimate is
one is proved to have one member, and so has every longer prefix of that
conversation: this tail is a row per turn made where it lies. Only prefixes
that may be shared are shuffled, by their digest, and grouped exactly.

Every node belongs to its smallest member, which owns the nodes of its path
from some depth on. What a subtree holds is therefore a sum over the members
of a node, of numbers that each conversation knows once the depth is known:
no recursion over the levels, and sums are added up before the shuffle, so the
root and very common beginnings cost one row per task.

A conversation of any number of turns is numbered by ``rank_in_groups`` and
digested in runs of ``RUN_TURNS``; digests of runs are joined by arithmetic
modulo a prime, so no task needs a long conversation whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.ranking import rank_in_groups
from ledgerloom.llm.common import materialize, name
from ledgerloom.llm.mixing import word_count

#: Prefix digests are polynomials in ``BASE`` over the turns' digests, modulo this prime.
PRIME, BASE = 2**127 - 1, 0x5851F42D4C957F2D14057B7EF767814F % (2**127 - 1)
#: Turns that one task digests of a conversation at a time.
RUN_TURNS = 1 << 20
#: Rows of the sketch, its cells a prefix, and the most cells of a row (a byte
#: each while counting, a bit when sent). With far more prefixes than the
#: largest sketch has cells fewer are proven and more are grouped exactly.
SKETCH_ROWS, CELLS_PER_PREFIX, LEAST_CELLS, MOST_CELLS = 3, 4, 1 << 12, 1 << 26
#: Cells that are added up at a time.
SEGMENT = 1 << 15
#: Bytes of ids that one row hands on when a node's list of ends is hashed.
CHUNK_BYTES = 1 << 14

NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---- turns and prefixes ----------------------------------------------------

def turn_code(role: Column, text: Column) -> Column:
    """128 bits for a turn; role and text are told apart by the role's length."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))


def rebuilt(turns: DataFrame, group: int, heads: int, hot_turns: int | None = None) -> DataFrame:
    """Conversations with the first turns of their group's first one.

    ``turns``: conv_id, turn, code, words. Conversation c starts with the
    first h turns of conversation c - c mod ``group``, where h is the CRC-32 of
    its decimal id modulo ``heads``, and goes on with its own turns after its
    first h. Returns conv_id, p, code, words: p ascends along the conversation.
    """
    h = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")), F.lit(heads))
    more = {} if hot_turns is None else {"hot_group_rows": hot_turns}
    own = rank_in_groups(turns, ["conv_id"], [("turn", False), ("code", False)], "p", **more).drop("turn")
    own = materialize(own, "numbered_turns")
    ids = turns.select("conv_id").distinct().withColumn("h", h).where("h > 0")
    ids = ids.withColumn("donor", F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(group)))
    first = own.where(F.col("p") < heads).where(F.pmod("conv_id", F.lit(group)) == 0).withColumnRenamed("conv_id", "donor")
    # at most group x heads rows for a donor
    given = ids.join(first, "donor").where("p <= h")
    return own.where(F.col("p") > h).select("conv_id", "p", "code", "words").unionByName(given.select("conv_id", "p", "code", "words"))


PREFIXES = "conv_id long, run long, depth long, digest binary, upto long, words long, last boolean"


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix digests within each (conversation, run) of sorted rows."""
    at, depth, state, upto = None, 0, 0, 0
    held: list | None = None  # the last row, until the next one tells whether its run goes on

    def batch(rows: list) -> pa.RecordBatch:
        c, r, d, g, u, w, e = zip(*rows) if rows else [()] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()), pa.array(r, pa.int64()), pa.array(d, pa.int64()), pa.array(g, pa.binary()),
             pa.array(u, pa.int64()), pa.array(w, pa.int64()), pa.array(e, pa.bool_())],
            names=["conv_id", "run", "depth", "digest", "upto", "words", "last"])

    for b in batches:
        out = []
        for conv, run, code, words in zip(*(b.column(x).to_pylist() for x in ("conv_id", "run", "code", "words"))):
            if (conv, run) != at:
                if held:
                    out.append((*held, True))
                at, depth, state, upto = (conv, run), 0, 0, 0
            elif held:
                out.append((*held, False))
            depth, upto = depth + 1, upto + words
            state = (state * BASE + int.from_bytes(code, "big") + 1) % PRIME
            held = [conv, run, depth, state.to_bytes(16, "big"), upto, words]
        yield batch(out)
    if held:
        yield batch([(*held, True)])


def _before_runs(pdf: pd.DataFrame) -> pd.DataFrame:
    """What lies before each run of one long conversation (a row per run)."""
    pdf = pdf.sort_values("run")
    depth, upto, state, out = 0, 0, 0, []
    for run, d, g, u in zip(pdf["run"], pdf["depth"], pdf["digest"], pdf["upto"]):
        out.append((pdf["conv_id"].iloc[0], run, depth, state.to_bytes(16, "big"), upto, run == pdf["run"].iloc[-1]))
        depth, upto, state = depth + d, upto + u, (state * pow(BASE, int(d), PRIME) + int.from_bytes(g, "big")) % PRIME
    return pd.DataFrame(out, columns=["conv_id", "run", "depth0", "digest0", "upto0", "end"])


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        digests = [((int.from_bytes(g0, "big") * pow(BASE, d, PRIME) + int.from_bytes(g, "big")) % PRIME).to_bytes(16, "big")
                   for g0, d, g in zip(*(b.column(x).to_pylist() for x in ("digest0", "depth", "digest")))]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(digests, pa.binary()), b.column("row")], names=["conv_id", "digest", "row"])


def prefixes(turns: DataFrame, run_turns: int = RUN_TURNS) -> DataFrame:
    """A row per conversation and prefix: conv_id, depth, digest, upto (words of
    the whole prefix), words (of its last turn), last; sorted by conversation
    and depth inside each file."""
    runs = turns.withColumn("run", F.floor((F.col("p") - 1) / run_turns).cast("long"))
    local = (runs.repartition("conv_id", "run").sortWithinPartitions("conv_id", "run", "p").select("conv_id", "run", "code", "words")
             .mapInArrow(_digest_runs, PREFIXES))
    local = materialize(local, "prefixes")
    columns = ["conv_id", "depth", "digest", "upto", "words", "last"]
    if local.where("run > 0").isEmpty():
        return local.select(*columns)
    totals = local.where("last")
    long = totals.where("run > 0").select("conv_id").distinct()
    before = (totals.join(long, "conv_id", "left_semi").select("conv_id", "run", "depth", "digest", "upto")
              .groupBy("conv_id").applyInPandas(_before_runs, "conv_id long, run long, depth0 long, digest0 binary, upto0 long, end boolean"))
    before = materialize(before, "runs_before")
    joined = local.join(before, ["conv_id", "run"], "left").withColumn("row", F.struct(
        (F.col("depth") + F.coalesce("depth0", F.lit(0))).alias("depth"), (F.col("upto") + F.coalesce("upto0", F.lit(0))).alias("upto"),
        "words", (F.col("last") & F.coalesce("end", F.lit(True))).alias("last")))
    zero = F.lit(bytes(16))
    whole = joined.select("conv_id", F.coalesce("digest0", zero).alias("digest0"), "depth", "digest", "row").mapInArrow(
        _join_runs, "conv_id long, digest binary, row struct<depth:long,upto:long,words:long,last:boolean>")
    whole = whole.select("conv_id", "row.*", "digest")
    return materialize(whole.repartition("conv_id", F.floor(F.col("depth") / run_turns)).sortWithinPartitions("conv_id", "depth")
                       .select(*columns), "prefixes")


# ---- count-min screening ---------------------------------------------------

def _cells(digests: pa.Array, rows: int, width: int) -> list[np.ndarray]:
    """The cell of each digest in each row of the sketch (digests are evenly spread numbers)."""
    raw = np.frombuffer(b"".join(digests.to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, 2)
    odd = raw[:, 1] | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((raw[:, 0] + np.uint64(i) * odd) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(width) for i in range(rows)]


def _count(rows: int, width: int):
    """A task's sketch, cell counts up to 2, as segments with anything in them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((rows, width), dtype=np.uint8)
        for b in batches:
            if b.num_rows:
                for row, cells in zip(counts, _cells(b.column("digest"), rows, width)):
                    cell, n = np.unique(cells, return_counts=True)
                    row[cell] = np.minimum(2, row[cell] + np.minimum(n, 2))
        flat = counts.reshape(-1)
        for at in range(0, len(flat), SEGMENT):
            part = flat[at:at + SEGMENT]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at // SEGMENT], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["segment", "cells"])
    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of sorted segments, as bits: whether a cell has more than one."""
    at, total = None, None

    def bits() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())], names=["segment", "bits"])

    for b in batches:
        for segment, cells in zip(b.column("segment").to_pylist(), b.column("cells").to_pylist()):
            part = np.frombuffer(cells, dtype=np.uint8)
            if segment != at:
                if at is not None:
                    yield bits()
                at, total = segment, part.copy()
            else:
                total = np.minimum(2, total + part)
    if at is not None:
        yield bits()


def _screen(sent, rows: int, width: int):
    """Marks each prefix: 0 maybe shared, 1 the first proven one of its
    conversation in this run of rows, 2 after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.frombuffer(sent.value, dtype=np.uint8)
        conv, proven = None, False
        for b in batches:
            if not b.num_rows:
                continue
            single = np.zeros(b.num_rows, dtype=bool)
            for i, cells in enumerate(_cells(b.column("digest"), rows, width)):
                place = cells + np.uint64(i * width)
                single |= (many[(place >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8) & 1) == 0
            kinds = np.zeros(b.num_rows, dtype=np.int32)
            for i, c in enumerate(b.column("conv_id").to_pylist()):
                if c != conv:
                    conv, proven = c, False
                kinds[i] = 2 if proven else int(single[i])
                proven = proven or bool(single[i])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kinds)], names=[*b.schema.names, "kind"])
    return run


def screen(rows: DataFrame, sketch_rows: int = SKETCH_ROWS, most_cells: int = MOST_CELLS) -> DataFrame:
    """``rows`` of prefixes with ``kind``: 0 may be shared; 1 is proved to have
    one member; 2 lies on the same conversation after such a one."""
    spark = rows.sparkSession
    width = LEAST_CELLS
    while width < min(most_cells, CELLS_PER_PREFIX * rows.count()):
        width *= 2
    parts = rows.select("digest").mapInArrow(_count(sketch_rows, width), "segment long, cells binary")
    summed = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_add_up, "segment long, bits binary")
    bits = bytearray(sketch_rows * width // 8)  # bounded by MOST_CELLS
    for r in summed.toLocalIterator():
        at = r["segment"] * SEGMENT // 8
        bits[at:at + len(r["bits"])] = r["bits"]
    sent = spark.sparkContext.broadcast(bytes(bits))
    return rows.mapInArrow(_screen(sent, sketch_rows, width), rows.withColumn("kind", F.lit(0)).schema)


# ---- nodes -----------------------------------------------------------------

def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of a node, comma-joined, a bounded number of bytes a row."""
    at, first, ids, size = None, None, [], 0
    for b in batches:
        out = []
        for digest, conv in zip(b.column("digest").to_pylist(), b.column("conv_id").to_pylist()):
            if ids and (digest != at or size >= CHUNK_BYTES):
                out.append((at, first, ",".join(ids)))
                ids, size = [], 0
            if not ids:
                at, first = digest, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield _chunks(out)
    if ids:
        yield _chunks([(at, first, ",".join(ids))])


def _chunks(rows: list) -> pa.RecordBatch:
    d, f, t = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array(f, pa.int64()), pa.array(t, pa.string())], names=["digest", "first", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over a node's chunks in their order, one chunk after another."""
    at, state = None, None

    def done(rows: list) -> pa.RecordBatch:
        d, h = zip(*rows) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array(h, pa.string())], names=["digest", "ends_sha256"])

    for b in batches:
        out = []
        for digest, ids in zip(b.column("digest").to_pylist(), b.column("ids").to_pylist()):
            if digest != at:
                if at is not None:
                    out.append((at, state.hexdigest()))
                at, state = digest, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield done(out)
    if at is not None:
        yield done([(at, state.hexdigest())])


def list_digests(ends: DataFrame) -> DataFrame:
    """``ends`` (digest, conv_id) -> digest, ends_sha256. Ids are joined where
    ranges of them lie, so a node with very many ends reaches its hashing task
    as a few chunks, which that task reads one at a time."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (ends.repartitionByRange(parts, "digest", "conv_id").sortWithinPartitions("digest", "conv_id")
              .mapInArrow(_join_ids, "digest binary, first long, ids string"))
    return (chunks.repartition("digest").sortWithinPartitions("digest", "first").select("digest", "ids")
            .mapInArrow(_hash_ids, "digest binary, ends_sha256 string"))


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(df: DataFrame, group: int = 20, heads: int = 4, id_column: str = "conv_id", turn_column: str = "turn",
         role_column: str = "role", text_column: str = "text", run_turns: int = RUN_TURNS, hot_turns: int | None = None,
         most_cells: int = MOST_CELLS) -> DataFrame:
    """The nodes of the trie of rebuilt conversations (see ``rebuilt``).

    Returns a row for each distinct sequence of first turns and the root:
    conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn_column``, null first; turns of equal number by
    their digest, so every run agrees; repeated rows are turns of their own. A
    null role or text is empty. Rows without a conversation id belong to none
    and take no part. A conversation without turns is a member of the root
    alone. No rows give no nodes.
    """
    spark = df.sparkSession
    role, text = (F.coalesce(name(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    turns = materialize(df.select(name(id_column).cast("long").alias("conv_id"), name(turn_column).alias("turn"), turn_code(role, text).alias("code"),
                                  word_count(text).alias("words")).where("conv_id is not null"), "turns")
    everyone = turns.agg(F.min("conv_id").alias("first"), F.count_distinct("conv_id").alias("n")).first()
    if everyone["first"] is None:
        return spark.createDataFrame([], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in NODE))
    root = everyone["first"]
    marked = materialize(screen(prefixes(rebuilt(turns, group, heads, hot_turns), run_turns), most_cells=most_cells), "screened")
    maybe = marked.where("kind = 0")

    # what each conversation owns: its path from the depth on at which it is the smallest member
    owners = materialize(maybe.groupBy("digest").agg(F.min("conv_id").alias("owner"), F.min("last").alias("leaf")), "owners")
    met = maybe.join(owners, "digest").select(
        "conv_id", F.when(F.col("owner") < F.col("conv_id"), F.struct("depth", "owner", "upto")).alias("foreign"),
        ((F.col("owner") == F.col("conv_id")) & F.col("last") & F.col("leaf")).alias("leaf"))
    alone = marked.where("depth = 1 or (kind > 0 and last)").select(
        "conv_id", F.lit(None).cast(met.schema["foreign"].dataType).alias("foreign"), ((F.col("kind") > 0) & F.col("last")).alias("leaf"))
    info = met.unionByName(alone).groupBy("conv_id").agg(F.max("foreign").alias("foreign"), F.max("leaf").alias("leaf"))
    info = materialize(info.select(
        "conv_id", F.coalesce("foreign.depth", F.lit(0)).alias("shared"), F.coalesce("foreign.owner", F.lit(root)).alias("above"),
        F.coalesce("foreign.upto", F.lit(0)).alias("shared_words"), F.col("leaf").cast("long").alias("leaf")), "owned")

    # possibly shared prefixes: exact groups
    parent = F.when(F.col("depth") > F.col("shared") + 1, F.col("conv_id")).when(F.col("depth") == F.col("shared") + 1, F.col("above"))
    child = (~F.col("last") & (F.col("shared") <= F.col("depth"))).cast("long")
    saved = F.when(F.col("depth") <= F.col("shared"), F.col("shared_words") - F.col("upto") + F.col("words")).otherwise(0)
    groups = maybe.join(info, "conv_id").select("digest", "depth", "conv_id", parent.alias("parent"), child.alias("child"), "leaf", saved.alias("saved"))
    groups = groups.groupBy("digest", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.min(F.struct("conv_id", "parent")).alias("top"), F.count("*").alias("n_convs"),
        F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    digests = list_digests(maybe.where("last").select("digest", "conv_id"))
    groups = groups.join(digests, "digest", "left").select(
        "conv_id", "depth", F.col("top.parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))

    # proven singletons: a row where the prefix lies; the first of a tail asks for its parent
    one = [F.lit(1).cast("long").alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
           F.lit(0).cast("long").alias("saved_tokens"),
           F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(NO_ENDS)).alias("ends_sha256")]
    tails = marked.where("kind = 2").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *one)
    tops = marked.where("kind = 1").join(info, "conv_id").select("conv_id", "depth", parent.alias("parent_conv_id"), *one)

    # the root
    turnless = turns.select("conv_id").distinct().join(info.select("conv_id"), "conv_id", "left_anti")
    top = info.agg(F.count_if(F.col("shared") == 0).alias("n_children"), F.sum("leaf").alias("leaves"), F.sum("shared_words").alias("saved"))
    no_ends = top.withColumn("ends", F.lit(None).cast("string"))
    root_ends = list_digests(turnless.select(F.lit(bytes(16)).alias("digest"), "conv_id")).select(
        *[F.lit(None).cast("long").alias(c) for c in top.columns], F.col("ends_sha256").alias("ends"))
    roots = no_ends.unionByName(root_ends).agg(*[F.max(c).alias(c) for c in no_ends.columns]).select(
        F.lit(root).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(everyone["n"]).cast("long").alias("n_convs"), "n_children",
        F.greatest(F.coalesce("leaves", F.lit(0)), F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
    return groups.unionByName(tails).unionByName(tops).unionByName(roots)
