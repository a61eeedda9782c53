"""Mixing sources to target weights by hash-threshold histograms.

Method: every document has a place, a hash of its id and text. For each source
and copy (first, second, ... use of a document) there is a budget of tokens;
the documents below a threshold of places fill it. Tokens are summed by source
and bucket of places, the bucket in which the budget runs out is the boundary,
and only the boundary buckets' rows are summed again by the next digits of the
place, until a boundary holds one row. The thresholds of a source are nested:
a smaller budget takes a subset of what a larger one takes. The last step
compares places with thresholds; nothing is sorted by place.

Everything is built from DataFrame functions. Sums by bucket are added up
before the shuffle, so a source with a third of all rows costs one row per
task and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, name

#: Tokens of a text: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
#: Hexadecimal digits of a document's place (60 bits, never negative) and of one level.
DIGITS, LEVEL_DIGITS = 15, 3


def word_count(text: Column) -> Column:
    """Number of tokens; 0 for null. Every token becomes one letter, blanks go."""
    return F.coalesce(F.char_length(F.translate(F.regexp_replace(text, WORD, "x"), BLANKS, "")), F.lit(0)).cast("long")


def place(*values: Column) -> Column:
    """The first ``DIGITS`` hexadecimal digits of an MD5 over the values."""
    parts = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, DIGITS), 16, 10).cast("long")


def source_order(sources: DataFrame) -> DataFrame:
    """``sources`` (one row each: source, source_size) with ``position`` from 0
    by code point, null last.

    Rows are dealt by ranges, numbered inside each, and moved up by the counts
    of the earlier ranges, so no task sees all sources.
    """
    order = [F.col("source").asc_nulls_last()]
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(sources.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "sources")
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    # a row for each range: at most the number of shuffle partitions
    before = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return dealt.withColumn("inside", inside).join(F.broadcast(before), "part").select(
        "source", "source_size", (F.col("before") + F.col("inside") - 1).alias("position"))


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3) -> DataFrame:
    """``sources`` (source, source_size, position) with weight and target.

    The weights repeat over the positions. All tokens are shared by weight;
    a target stops at ``epochs`` times its source's size and the excess is
    shared again among the others by weight, until none is above. Each round
    is one sum over the sources; a round adds a source to the capped ones, or
    is the last.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int")).cast("decimal(20,0)")
    cap = (F.lit(epochs) * F.col("source_size")).cast("decimal(20,0)")
    listed = materialize(sources.withColumn("weight", weight).withColumn("cap", cap), "weighted_sources")
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    rest, over, capped = total, None, F.lit(False)
    while True:
        got = listed.agg(F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)).alias("taken"),
                         F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("over")).first()
        if (total - int(got["taken"]), int(got["over"])) == (rest, over):
            break
        rest, over = total - int(got["taken"]), int(got["over"])
        # target >= cap, in whole numbers: rest * weight / over >= cap
        capped = F.col("cap") * F.lit(over).cast("decimal(18,0)") <= F.lit(rest).cast("decimal(20,0)") * F.col("weight").cast("decimal(18,0)")
    shared = F.lit(float(rest)) * F.col("weight").cast("double") / F.lit(float(over or 1))
    return listed.select("source", "source_size", "position", "weight",
                         F.when(capped, F.col("cap").cast("double")).otherwise(shared).alias("target"))


def same_source(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def digits(level: int) -> Column:
    """The bucket of a row at a level: its place's digits first, then those of
    a hash of its number (one to one, so that no two rows stay together)."""
    bits, levels = 4 * LEVEL_DIGITS, DIGITS // LEVEL_DIGITS
    if level < levels:
        shifted = F.shiftright("place", bits * (levels - 1 - level))
    else:
        shifted = F.shiftrightunsigned(F.xxhash64("row"), max(0, 64 - bits * (level - levels + 1)))
    return shifted.bitwiseAND((1 << bits) - 1)


def boundaries(sums: DataFrame) -> DataFrame:
    """The bucket in which each budget runs out, and what is left of it there."""
    upto = F.sum("tokens").over(W.partitionBy("source", "copy").orderBy("bucket"))
    return (sums.withColumn("upto", upto).where("upto >= rest and upto - tokens < rest")
            .select("source", "copy", "bucket", "rows", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("rest")))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """The place at which each budget of a source runs out.

    ``rows``: source, size, place, row (a number that no two rows share).
    ``budgets``: source, copy, rest, with 0 < rest < the source's size; the
    budgets of a source share its histogram and their thresholds are nested.
    Returns source, copy, place, row, rest: rows of the source before (place,
    hash of row) lie wholly in the budget, and that row gives ``rest`` of its
    tokens. Rows without tokens take no part.
    """
    sums = F.sum("size").alias("tokens"), F.count("*").alias("rows")
    keyed = rows.where("size > 0").withColumn("bucket", digits(0))
    histogram = keyed.groupBy("source", "bucket").agg(*sums)
    open_ = materialize(budgets, "budgets")
    edge = materialize(boundaries(histogram.join(open_, same_source(histogram, open_)).select(
        open_["source"], "copy", "rest", "bucket", "tokens", "rows")), "boundaries")
    near = keyed.join(edge, same_source(keyed, edge) & (keyed["bucket"] == edge["bucket"]))
    found, level = None, 0
    while True:
        # the boundary buckets' rows alone go on
        near = materialize(near.select(edge["source"], edge["copy"], edge["rest"], "rows", "size", "place", "row"), "near")
        single = near.where("rows = 1").drop("rows", "size")
        found = single if found is None else found.unionByName(single)
        if edge.where("rows > 1").isEmpty():
            return materialize(found, "thresholds")
        level += 1
        keyed = near.where("rows > 1").drop("rows").withColumn("bucket", digits(level))
        edge = materialize(boundaries(keyed.groupBy("source", "copy", "rest", "bucket").agg(*sums)), "boundaries")
        keyed = keyed.drop("rest")
        near = keyed.join(edge, same_source(keyed, edge) & (keyed["copy"] == edge["copy"]) & (keyed["bucket"] == edge["bucket"]))


def mix(df: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, id_column: str = "doc_id",
        text_column: str = "text", source_column: str = "source") -> DataFrame:
    """How many tokens of each document a mix of the sources takes.

    Returns ``id_column``, source, size, source_size, target, taken for every
    row. A source's target is taken as whole copies of all its documents and,
    in the copy where the budget runs out, of the documents below a threshold
    of places; the document at the threshold gives its first tokens, so the
    taken tokens of a source are the whole part of its target. A rerun takes
    the same documents: places depend on id and text alone, and rows that are
    alike in both are told apart by their number in the table as written. Null ids stay null; null and empty
    texts have size 0 and are never taken; a null source is a source, the last;
    repeated rows each count; no rows give no rows.
    """
    rows = materialize(df.select(
        name(id_column).alias("id"), name(source_column).cast("string").alias("source"), word_count(name(text_column)).alias("size"),
        place(name(id_column), name(text_column)).alias("place"), F.monotonically_increasing_id().alias("row")), "sized")
    sources = targets(source_order(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), weights, epochs)
    whole = F.floor("target").cast("long")
    part = F.greatest(F.least(whole - F.col("copy") * F.col("source_size"), F.col("source_size")), F.lit(0))
    budgets = (sources.select("source", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("copy"))
               .withColumn("rest", part).where("rest > 0 and rest < source_size").select("source", "copy", "rest"))
    # earlier copies are whole and later ones empty: a source has one threshold at most
    cut = thresholds(rows, budgets).select(F.col("source").alias("cut"), F.col("place").alias("cut_place"), F.col("row").alias("cut_row"), "rest")
    times = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(0)
    plan = materialize(sources.join(cut, F.col("source").eqNullSafe(F.col("cut")) & F.col("rest").isNotNull(), "left").select(
        F.col("source").alias("of"), "source_size", "target", times.alias("times"), "cut_place", "cut_row", "rest"), "mix_plan")
    flip = F.lit(-(1 << 63))  # hashes compare as unsigned numbers, like their digits
    below = (F.col("place") < F.col("cut_place")) | ((F.col("place") == F.col("cut_place")) & (
        F.xxhash64("row").bitwiseXOR(flip) < F.xxhash64("cut_row").bitwiseXOR(flip)))
    last = F.when(F.col("row") == F.col("cut_row"), F.col("rest")).when(below, F.col("size")).otherwise(0)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target",
        (F.col("times") * F.col("size") + last).cast("long").alias("taken"))
