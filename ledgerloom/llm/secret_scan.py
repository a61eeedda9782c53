"""Secret scans: candidates by pattern, false positives out by a random forest.

Method: a pattern takes every string that might be a credential (long runs
with a digit, quoted assigned values, private key blocks). Each candidate gets
features of its length, its character transitions, the share of it that a
dictionary covers, the path of its document and the words beside it. A random
forest, trained from labelled findings, gives the chance that it is a secret.

DataFrame functions only. A text is split once into what lies between the
candidates and the candidates, so that places and neighbours come from the
same two arrays.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, name, sampled

#: Findings (about) of the table that take part in training, by a hash.
TRAINING_FINDINGS = 20_000
#: Documents that hold a word of the dictionary, in a table of any size.
LEAST_DOCUMENTS = 2
TREES, DEPTH = 30, 7
#: Chance from which a finding is a secret.
LEAST_CHANCE = 0.5
MASK = "[SECRET]"

_RUN = r"[A-Za-z0-9_+/~.\-]"
CANDIDATE = (
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[^-]*+(?:-{1,4}+[^-]++){0,1000}+-----END [A-Z ]{0,30}PRIVATE KEY-----"
    rf"|(?<!{_RUN})(?=[A-Za-z_+/~.\-]*+[0-9]){_RUN}{{11,}}[A-Za-z0-9]={{0,2}}"
    r"|(?<=[=:] ?[\"'])[^\s\"']{8,}+(?=[\"'])"
)
SECRET_WORDS = (r"(?i)(token|secret|passw(or)?d|passwd|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key"
                r"|client[_-]?secret|signing[_-]?key|encryption[_-]?key)")
OTHER_WORDS = (r"(?i)(uuid|guid|hash|sha-?\d*|md5|commit|checksum|digest|revision|build|version|isbn|phone|order|invoice"
               r"|serial|card|account|ticket|address|host|date|example|sample|dummy|placeholder|fake)")
PROVIDER = (r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_[A-Za-z0-9_]{40,}|xox[abprs]-[A-Za-z0-9-]{10,}"
            r"|sk_(live|test)_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9_-]{20,}|AIza[0-9A-Za-z_-]{35}|glpat-[A-Za-z0-9_-]{18,}|npm_[A-Za-z0-9]{30,}"
            r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*)$")
PLACEHOLDER = r"(?i)(example|sample|changeme|placeholder|your[_-]|dummy|x{5,}|0{6,}|1234567|abcdef|\.\.\.|<|\{)"
TEST_PATH = r"(?i)(test|example|sample|fixture|mock|docs?/|readme)"


def _share(pattern: str, of: str = "candidate") -> Column:
    return F.regexp_count(F.col(of), F.lit(pattern)) / F.greatest(F.length(of), F.lit(1))


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def feature_columns() -> dict[str, Column]:
    """Features of a finding (candidate, before, after, path, covered)."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    # the word that names the value: the last ones before it
    near = F.regexp_extract(before, r"([A-Za-z][A-Za-z0-9_-]*)[^A-Za-z0-9]*$", 1)
    return {
        "length": F.length(c).cast("double"),
        "digits": _share("[0-9]"),
        "upper": _share("[A-Z]"),
        "lower": _share("[a-z]"),
        "marks": _share("[^A-Za-z0-9]"),
        "letter_digit": _share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"),
        "case_change": _share("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "vowel_change": _share("(?i)(?<=[aeiou])(?=[bcdfghjklmnpqrstvwxyz])|(?<=[bcdfghjklmnpqrstvwxyz])(?=[aeiou])"),
        "repeats": _share(r"(.)\1"),
        "variety": F.size(F.array_distinct(F.split(c, ""))) / F.greatest(F.length(c), F.lit(1)),
        "hex": _flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "only_digits": _flag(c.rlike("^[0-9.+-]+$")),
        "dictionary": F.col("covered") / F.greatest(F.length(c), F.lit(1)),
        "provider": _flag(c.rlike(PROVIDER)),
        "placeholder": _flag(c.rlike(PLACEHOLDER)),
        "address": _flag(c.rlike(r"^([a-z0-9-]+\.)+[a-z]{2,}$|^\d{1,3}(\.\d{1,3}){3}$|^(https?|www)")),
        "uuid": _flag(c.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")),
        "test_path": _flag(F.col("path").rlike(TEST_PATH)),
        "near_secret_word": _flag(near.rlike(SECRET_WORDS)),
        "secret_word": _flag(before.rlike(SECRET_WORDS)),
        "other_word": _flag(near.rlike(OTHER_WORDS)),
        "assigned": _flag(before.rlike(r"[=:]\s*[\"']?\s*$")),
        "quoted": _flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "at_sign": _flag(before.rlike("@$")),
    }


def findings(df: DataFrame, text_column: str, path_column: str | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each candidate: the columns ``keep``, at (its number in the
    text), start (code points before it), candidate, before, after, path."""
    text = name(text_column).cast("string")
    parts = df.select(*[name(k) for k in keep], F.monotonically_increasing_id().alias("row_"),
                      (name(path_column).cast("string") if path_column else F.lit(None).cast("string")).alias("path"),
                      F.split(text, CANDIDATE, -1).alias("between_"),
                      F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found_")).where("size(found_) > 0")
    pairs = F.transform("found_", lambda c, i: F.struct(
        c.alias("candidate"), F.get("between_", i).alias("left"), F.get("between_", i + 1).alias("right")))
    rows = parts.select(*[name(k) for k in keep], "row_", "path", F.posexplode(pairs).alias("at", "x")).select(
        *[name(k) for k in keep], "row_", "path", "at", F.length("x.left").alias("left_"), F.col("x.candidate").alias("candidate"),
        F.right("x.left", F.lit(60)).alias("before"), F.left("x.right", F.lit(20)).alias("after"))
    earlier = W.partitionBy("row_").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    start = F.sum(F.col("left_") + F.length("candidate")).over(earlier) - F.length("candidate")
    return rows.withColumn("start", start).select(*[name(k) for k in keep], "at", "start", "candidate", "before", "after", "path")


def dictionary(df: DataFrame, text_column: str) -> DataFrame:
    """The words (column w) of four letters and more, outside of runs with a
    digit (what candidates consist of), in ``LEAST_DOCUMENTS`` of all texts."""
    text = F.lower(name(text_column).cast("string"))
    rest = F.regexp_replace(text, r"(?<![a-z0-9_+/~.\-])[a-z_+/~.\-]*+[0-9][a-z0-9_+/~.\-]*+", " ")
    words = df.select(F.explode(F.array_distinct(F.regexp_extract_all(rest, F.lit(r"([a-z]{4,})"), F.lit(1)))).alias("w"))
    return materialize(words.groupBy("w").count().where(F.col("count") >= LEAST_DOCUMENTS).select("w"), "dictionary")


def with_coverage(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` (candidate) with covered: the letters of each candidate's words
    that are in the dictionary ``words``."""
    numbered = materialize(rows.withColumn("number_", F.monotonically_increasing_id()), "numbered")
    parts = numbered.select("number_", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(r"([a-z]{4,})"), F.lit(1))).alias("w"))
    # the words that candidates have meet the dictionary first: few rows, no hot key
    met = materialize(parts.select("w").distinct().join(words, "w", "left_semi"), "words_met")
    covered = parts.join(met, "w").groupBy("number_").agg(F.sum(F.length("w")).alias("covered"))
    return numbered.join(covered, "number_", "left").withColumn("covered", F.coalesce("covered", F.lit(0))).drop("number_")


def labelled(rows: DataFrame) -> DataFrame:
    """Findings whose label is beyond doubt, with ``label`` (1: secret).

    Secrets: strings of a provider's own form, and mixed strings assigned to a
    name that says so. No secrets: placeholders, addresses, plain numbers,
    words, and whatever no such name stands beside.
    """
    mixed = (F.col("length") >= 8) & (F.col("digits") > 0.05) & (F.col("variety") >= 0.2) & (F.col("dictionary") < 0.5)
    plain = (F.col("address") + F.col("only_digits") + F.col("placeholder") + F.col("uuid")) > 0
    named = (F.col("near_secret_word") > 0) & (F.col("assigned") > 0)
    return rows.withColumn(
        "label", F.when(F.col("placeholder") > 0, 0).when((F.col("provider") > 0), 1)
        .when(plain, 0).when(named & mixed & (F.col("test_path") == 0), 1)
        .when((F.col("secret_word") == 0) & (F.col("assigned") == 0), 0)
        .when(F.col("other_word") > 0, 0).cast("double")).where("label is not null")


def worked_examples(spark: SparkSession) -> DataFrame:
    """Findings labelled by hand: forms of values beside names, by rule."""
    digest = lambda k: F.sha2(F.concat(F.lit(k), F.col("id").cast("string")), 256)
    mixed = F.translate(F.base64(F.unhex(digest("m"))), "=+/", "")
    values = [  # value, label when a name of a secret stands beside it, otherwise
        (F.left(digest("a"), F.lit(40)), 1, 0), (F.upper(F.left(digest("b"), F.lit(40))), 1, 0), (F.left(digest("c"), F.lit(32)), 1, 0),
        (F.left(mixed, F.lit(40)), 1, 0), (F.left(mixed, F.lit(24)), 1, 0), (F.concat(F.left(mixed, F.lit(14)), F.lit("!9")), 1, 0),
        (F.concat(F.lit("AKIA"), F.upper(F.left(digest("d"), F.lit(16)))), 1, 1), (F.concat(F.lit("ghp_"), F.left(mixed, F.lit(36))), 1, 1),
        (F.concat(F.lit("sk_live_"), F.left(mixed, F.lit(24))), 1, 1), (F.concat(F.lit("xoxb-"), F.left(digest("e"), F.lit(30))), 1, 1),
        (F.concat(F.lit("AKIA"), F.upper(F.left(digest("f"), F.lit(9))), F.lit("EXAMPLE")), 0, 0), (F.lit("xxxxxxxxxxxxxxxx1"), 0, 0),
        (F.concat(F.lit("your_token_here_"), F.col("id").cast("string")), 0, 0), (F.lit("1234567890123456"), 0, 0),
        (F.concat(F.lit("host"), F.col("id").cast("string"), F.lit(".example.com")), 0, 0),
        (F.concat_ws(".", F.col("id") % 200, F.lit(17), F.col("id") % 250, F.lit(173)), 0, 0),
        (F.lpad((F.col("id") * 7919 + 4000000000000000).cast("string"), 16, "4"), 0, 0),
        (F.concat_ws("-", F.left(digest("g"), F.lit(8)), F.substring(digest("g"), 9, 4), F.lit("4abc"), F.lit("8def"), F.left(digest("h"), F.lit(12))), 0, 0),
        (F.concat(F.lit("chapter-"), F.col("id").cast("string"), F.lit("-introduction")), 0, 0),
    ]
    places = [  # before, after, names a secret
        ('the token = "', '" and', 1), ("password: ", " then", 1), ('"api_key": "', '",', 1), ("export SECRET_KEY=", "\n", 1),
        ("Authorization: Bearer ", "\n", 1), ("client_secret='", "'", 1), ("auth_token=", "&", 1),
        ("commit ", " by", 0), ("see the page of ", " and", 0), ('sha256: "', '"', 0), ("order number ", " was", 0),
        ('"id": "', '",', 0), ("mail 3@", " or", 0), ("checksum = ", "\n", 0), ("of the words ", ".", 0),
    ]
    made = materialize(spark.range(4).select(F.explode(F.array(*[
        F.struct(v.cast("string").alias("candidate"), F.lit(yes).alias("yes"), F.lit(no).alias("no"))
        for v, yes, no in values])).alias("v")).select("v.*"), "values")
    beside = F.array(*[F.struct(F.lit(b).alias("before"), F.lit(a).alias("after"), F.lit(n == 1).alias("names")) for b, a, n in places])
    return made.withColumn("p", F.explode(beside)).select(
        "candidate", "p.before", "p.after", F.lit("src1").alias("path"),
        F.when(F.col("p.names"), F.col("yes")).otherwise(F.col("no")).cast("double").alias("label"))


def fit(spark: SparkSession, rows: DataFrame, columns: dict[str, Column], words: DataFrame) -> PipelineModel:
    """The forest from the worked examples (with the dictionary ``words``) and
    a sample of the table's own labelled findings (``rows`` with features)."""
    own = labelled(rows)
    n = own.count()
    share = min(1.0, TRAINING_FINDINGS / max(n, 1))
    sample = own.where(sampled(share, "candidate", "before"))
    inputs = list(columns)
    examples = materialize(with_coverage(worked_examples(spark), words), "examples").withColumns(columns)
    data = materialize(sample.select(*inputs, "label").unionByName(examples.select(*inputs, "label")), "labelled_findings")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
                                    featureSubsetStrategy="sqrt", seed=7)
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"), forest]).fit(data)


def score(df: DataFrame, text_column: str = "text", path_column: str | None = "source", keep: tuple[str, ...] = ("doc_id",),
          sample_of: DataFrame | None = None) -> DataFrame:
    """Every candidate of every whole text with its chance of being a secret.

    Returns the columns ``keep``, at, start, candidate, before, after, path,
    chance and is_secret (chance >= 0.5). Null and empty texts have no
    candidates; a null path says nothing; rows that repeat give their findings
    again; tables without rows give no rows. Extra columns of the input are
    not read. ``sample_of``: the texts whose words, all of them, are the
    dictionary (default ``df``).
    """
    spark = df.sparkSession
    held = [f"keep_{i}" for i in range(len(keep))]
    words = dictionary(df if sample_of is None else sample_of, text_column)
    columns = feature_columns()
    own = df.select(*[name(c).alias(h) for c, h in zip(keep, held)], name(text_column).alias("text"),
                    (name(path_column) if path_column else F.lit(None).cast("string")).alias("source"))
    rows = materialize(with_coverage(findings(own, "text", "source", tuple(held)), words).withColumns(columns), "findings")
    model = fit(spark, rows, columns, words)
    scored = model.transform(rows).withColumn("chance", vector_to_array("probability")[1])
    return scored.select(*[F.col(h).alias(c) for h, c in zip(held, keep)], "at", "start", "candidate", "before", "after", "path",
                         "chance", (F.col("chance") >= LEAST_CHANCE).alias("is_secret"))


def redact(df: DataFrame, text_column: str = "text", path_column: str | None = "source") -> DataFrame:
    """``df`` with every secret of ``text_column`` replaced by ``MASK``.

    Only texts with candidates are written, split and joined again. All rows and columns stay, in the input's column order; texts without a
    secret are unchanged, null texts stay null.
    """
    text = name(text_column).cast("string")
    has = F.coalesce(F.regexp_count(text, F.lit(CANDIDATE)) > 0, F.lit(False))
    own = lambda stem: next(x for k in range(len(df.columns) + 1) if (x := stem + "_" * (k + 1)) not in df.columns)
    row, between, found, flags = map(own, ("row", "between", "found", "flags"))
    some = materialize(
        df.where(has).withColumn(row, F.monotonically_increasing_id()).withColumn(between, F.split(text, CANDIDATE, -1))
        .withColumn(found, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))), "texts_with_findings")
    verdicts = score(some, text_column, path_column, (row,), sample_of=df)
    listed = materialize(
        verdicts.groupBy(F.col(row).alias("key")).agg(F.transform(
            F.array_sort(F.collect_list(F.struct("at", "is_secret"))), lambda x: x["is_secret"]).alias(flags)), "verdicts")
    parts = F.transform(found, lambda c, i: F.concat(
        F.get(between, i), F.when(F.get(flags, i), F.lit(MASK)).otherwise(c)))
    masked = F.concat(F.array_join(parts, ""), F.element_at(between, -1))
    marked = some.join(listed, F.col(row) == F.col("key")).withColumn(text_column, masked)
    return marked.select(*[name(c) for c in df.columns]).unionByName(df.where(~has).select(*[name(c) for c in df.columns]))
