"""A training-data pipeline over ``documents``.

``STAGES`` lists its steps: each takes (spark, docs, sf_dir) and returns what
it keeps of ``docs``, with the columns of documents; the last one returns the
packed pieces. ``run`` writes each step's rows as Parquet and reads them back
for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import language, packing, secret_scan, simhash, toxicity
from ledgerloom.llm.common import materialize, read, ship
from ledgerloom.llm.queries import TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go. Null and empty texts
    are judged as texts without words, repeated rows each alike; null ids teach
    nothing; an empty table stays empty; further columns stay."""
    ship(spark)
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def with_keys(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, written once, and the key's name: ids
    may be null or repeat."""
    key = "row"
    while key in docs.columns:
        key += "_"
    return materialize(docs.withColumn(key, F.monotonically_increasing_id()), label), key


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go; the others carry the
    identified one. Every row has its own verdict, repeated ones and those of
    null ids too; null, empty and letterless texts go."""
    ship(spark)
    keyed, key = with_keys(docs, "documents_to_identify")
    found = language.identify(keyed, "text", F.col("lang"), F.col("source"), keep=(key,)).where("accepted")
    joined = keyed.join(found.select(F.col(key).alias("judged"), F.col("lang").alias("identified")), F.col(key) == F.col("judged"))
    return joined.select(*[F.col("identified").alias(c) if c == "lang" else keyed[c] for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one of the smallest id
    (any id before none). Ids that are null or repeat make no copies."""
    ship(spark)
    keyed, key = with_keys(docs, "documents_to_compare")
    groups = simhash.near_duplicates(keyed, shingle=4, radius=4, id_column=key).select(key, "component_id")
    ids = keyed.select(F.col(key).alias("own"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key).alias("place"))
    first = groups.join(ids, F.col(key) == F.col("own")).groupBy("component_id").agg(F.min("place").alias("place"))
    return keyed.join(first.select(F.col(f"place.{key}").alias(key)), key, "left_semi").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; all documents stay, repeated
    rows and null ids too. Null and empty texts stay as they are, and n_chars
    follows the text (null for a null one)."""
    ship(spark)
    return secret_scan.redact(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as sequences of 1024 tokens, a row per piece. A
    null or empty text is its end id alone; repeated rows are packed each; a
    null id stays null; an empty table gives no pieces."""
    ship(spark)
    return packing.pack(docs, TOKENIZER, capacity=1024, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("SimHash near-dedup", drop_near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack_documents),
]

#: Trained models and tokenizing have no SQL form; tests hold each stage
#: against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the rows that the one before kept."""
    docs = read(spark, sf_dir, "documents")
    for step, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), step.replace(" ", "_"))
    return docs
