"""Language identification by Bayesian evidence fusion.

Method: the posterior of a text's language combines
- the likelihood of its byte trigrams under a model of each language,
- the language its markup (or metadata) declares, weighted by how often such
  a declaration goes with each language,
- the prior of its host. Host priors are smoothed hierarchically: the counts
  of all texts, then of the address suffix, then of the host, each level
  taking the level above as its prior.

The counts are grouped aggregations over all texts. Only the trigram model is
fitted on a sample of the texts that declare a language, taken language by
language, so that a rare one has as many texts as it can give.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, pick, text_slices

#: Texts (about) of each language that fit its trigram model, taken by a hash.
SAMPLE_ROWS = 20_000
#: Texts that must declare a language (a single declaration is a slip), in a table of any size.
LEAST_TEXTS = 2
#: Hash buckets of the trigrams.
BUCKETS = 1 << 17
#: Numbers that working arrays hold (about).
HELD = 1 << 21
#: Trigrams of one text depend on each other: they count as so many at most.
EFFECTIVE_GRAMS = 40.0
#: Weight of the level above, in texts, in each level's counts.
PRIOR_TEXTS = 20.0
#: A text is accepted when its best language has this share of the posterior
#: and explains its trigrams better than chance by this many nats each.
LEAST_CONFIDENCE, LEAST_GAIN = 0.5, 0.5

TAGS = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_LETTER = np.zeros(256, dtype=np.uint8)
for _b in range(256):
    _c = chr(_b).lower()
    # ASCII letters in lower case, all bytes of other scripts as they are
    _LETTER[_b] = ord(_c) if _b < 128 and _c.isalpha() else _b if _b >= 128 else 32


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of a text's letters (runs of others are one gap)."""
    data = _LETTER[np.frombuffer(b" " + text.encode() + b" ", dtype=np.uint8)]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    data = data[keep].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, dtype=np.uint32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(15)


def plain(text: str, markup: bool) -> str:
    return TAGS.sub(" ", text) if markup else text


def declared_language(column: Column) -> Column:
    """The primary subtag (en of en-GB), null when there is none."""
    return F.nullif(F.lower(F.regexp_extract(column.cast("string"), r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1)), F.lit(""))


def markup_language(html: Column) -> Column:
    return declared_language(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1))


def host_of(address: Column) -> Column:
    """The host of a url, or the whole of an address that is no url."""
    rest = F.regexp_replace(F.lower(F.trim(address.cast("string"))), r"^[a-z][a-z0-9+.-]*://", "")
    return F.nullif(F.regexp_extract(rest, r"^([^/?#:]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.nullif(F.regexp_extract(host, r"\.([a-z0-9-]+)$", 1), F.lit(""))


class Trigrams:
    """Log likelihoods of trigrams by language, from the counts ``n`` of
    (language's position, bucket); a trigram that a language lacks counts 0.5."""

    def __init__(self, languages: list[str], language: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.languages = languages
        order = np.argsort(bucket, kind="stable")
        # the entries of bucket b are those from starts[b] to starts[b + 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))])
        self.sizes = np.diff(self.starts)
        self.language = language[order].astype(np.int32)
        self.above = np.log(2.0 * n[order] + 1.0).astype(np.float32)  # over a missing trigram
        self.missing = np.log(0.5 / (np.bincount(language, weights=n, minlength=len(languages)) + 0.5 * BUCKETS))

    def evidence(self, text: str) -> tuple[list[float], float]:
        """Tempered log likelihood of each language, and the best one's gain
        over chance per trigram (0.0 where a text has no letters)."""
        grams = trigrams(text)
        letters, k = len(grams), len(self.languages)
        if not letters or not k:
            return [0.0] * k, 0.0
        found, times = np.unique(grams, return_counts=True)
        found = found.astype(np.int64)
        total = np.zeros(k)
        step = max(1, HELD // k)
        for at in range(0, len(found), step):
            first, size = self.starts[found[at:at + step]], self.sizes[found[at:at + step]]
            entry = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
            total += np.bincount(self.language[entry], weights=self.above[entry] * np.repeat(times[at:at + step], size), minlength=k)
        mean = self.missing + total / letters
        return (mean * min(letters, EFFECTIVE_GRAMS)).tolist(), float(mean.max() + np.log(BUCKETS))


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trigrams:
    """The trigram model of every language that ``LEAST_TEXTS`` of the rows
    (key, text, markup, declared) declare, from about ``sample_rows`` texts of
    each. Tags have two or three letters, which bounds their number."""
    known = rows.where("declared is not null and text is not null")
    found = materialize(known.groupBy("declared").count().where(F.col("count") >= LEAST_TEXTS), "languages")
    languages = sorted(r["declared"] for r in found.collect())
    if not languages:
        none = np.zeros(0, dtype=np.int64)
        return Trigrams([], none, none, none)
    # each language's share of all 64-bit values, in a table of any size
    taken = found.select("declared", (F.lit(float(sample_rows)) / F.col("count") * 2.0**64 - 2.0**63).alias("below"))
    sample = known.join(F.broadcast(taken), "declared").where(F.xxhash64("key").cast("double") <= F.col("below"))
    place = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array((pairs // BUCKETS).astype(np.int32)), pa.array((pairs % BUCKETS).astype(np.int32)), pa.array(n.astype(np.int64))],
                names=["language", "bucket", "n"])

        for batch in batches:
            for text, markup, lang in zip(*(batch.column(c).to_pylist() for c in ("text", "markup", "declared"))):
                held.append(trigrams(plain(text, markup)).astype(np.int64) + place[lang] * BUCKETS)
                size += len(held[-1])
                if size > HELD:
                    yield out()
                    size = 0
        yield out()

    summed = (sample.select("text", "markup", "declared").mapInArrow(count, "language int, bucket int, n bigint")
              .groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas())  # trigrams that occur, by language
    return Trigrams(languages, *(summed[c].to_numpy() for c in ("language", "bucket", "n")))


def _softmax(logs: np.ndarray) -> np.ndarray:
    powers = np.exp(logs - logs.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel(), pa.float64()))


def _rows(batch: pa.RecordBatch, column: str, k: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _short(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows that have about ``HELD`` numbers, k each."""
    step = max(1, HELD // max(k, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    """The arrays ``own`` summed by ``keys``, entry by entry, as c, and their sum, as texts."""
    each = rows.select(*keys, F.posexplode("own").alias("at", "x")).groupBy(*keys, "at").agg(F.sum("x").alias("x"))
    whole = each.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("c"), F.sum("x").alias("texts"))  # as long as own
    return whole.withColumn("c", F.transform("c", lambda e: e["x"]))


def _smooth(above: Column) -> Column:
    """The sums of a level with the level above (shares) as so many texts."""
    return F.transform(F.arrays_zip(F.col("c"), above.alias("s")),
                       lambda x: (x["c"] + PRIOR_TEXTS * x["s"]) / (F.col("texts") + PRIOR_TEXTS))


def identify(df: DataFrame, text_column: str, declared: Column, address: Column, markup: Column | bool = False,
             keep: tuple[str, ...] = (), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The language of every text.

    ``declared`` and ``address`` are columns of ``df`` (a language tag or
    null; a url, a source or null); ``markup`` tells whether the text holds
    tags. Returns the columns ``keep``, then declared, host, lang (null when
    no language is known at all), confidence (its share of the posterior),
    gain (nats per trigram over chance) and accepted, a row for each input
    row. Missing evidence says nothing. A null, empty or letterless text has
    gain 0 and is not accepted. Of languages with equal posteriors the first by
    name is taken. Rows that repeat count each. Tables without
    rows give no rows. Texts are read whole.
    """
    held = [f"keep_{i}" for i in range(len(keep))]
    base = df.select(*[F.col(f"`{c}`").alias(h) for c, h in zip(keep, held)], F.col(f"`{text_column}`").alias("text"),
                     declared_language(declared).alias("declared"), host_of(address).alias("host"),
                     (F.lit(markup) if isinstance(markup, bool) else markup).alias("markup"))
    base = base.withColumn("key", F.struct("text", "host"))
    model = fit(base, sample_rows)
    languages, k = model.languages, len(model.languages)
    shared = df.sparkSession.sparkContext.broadcast(model)  # as large as its trigrams

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for whole in batches:
            for batch in _short(text_slices(whole, "text"), k):
                found = [table.evidence(plain(t or "", m)) for t, m in
                         zip(batch.column("text").to_pylist(), batch.column("markup").to_pylist())]
                rest = [c for c in batch.schema.names if c not in ("text", "markup")]
                logs, gain = np.array([f[0] for f in found]).reshape(len(found), k), np.array([f[1] for f in found])
                # texts without letters are no evidence for their host's language
                own = np.where(gain[:, None] != 0, _softmax(logs), 0.0) if k else logs
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), _lists(logs), pa.array(gain), _lists(own)],
                                                 names=[*rest, "logs", "gain", "own"])

    rows = base.drop("key")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("text", "markup"))
    seen = rows.mapInArrow(read, f"{schema}, logs array<double>, gain double, own array<double>")
    if not k:
        return seen.select(*[F.col(h).alias(c) for h, c in zip(held, keep)], "declared", "host",
                           F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), "gain",
                           F.lit(False).alias("accepted"))
    seen = materialize(seen.withColumn("suffix", suffix_of(F.col("host"))), "language_evidence")

    # Grouped counts (soft: shares of each language), summed before the shuffle.
    total = _sums(seen).first()
    total = [x + 1.0 for x in total["c"]] if total and total["c"] else [1.0] * k
    top = F.array(*[F.lit(x / sum(total)) for x in total])
    by_suffix = materialize(_sums(seen.where("suffix is not null"), "suffix").select("suffix", _smooth(top).alias("suffix_prior")), "suffix_priors")
    by_host = materialize(
        _sums(seen.where("host is not null"), "host", "suffix")
        .join(by_suffix, "suffix", "left")
        .select("host", _smooth(F.coalesce("suffix_prior", top)).alias("host_prior")), "host_priors")
    # P(declaration | language), up to a factor that all languages share: the
    # language's share among the texts that declare it, over its share in all.
    by_tag = materialize(
        _sums(seen.where("declared is not null"), "declared")
        .select("declared", F.transform(F.arrays_zip(_smooth(top).alias("s"), top.alias("t")),
                                        lambda x: F.log(x["s"] / x["t"])).alias("says")), "declarations")

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(languages, dtype=object)
        for batch in _short(batches, k):
            posterior = _softmax(_rows(batch, "logs", k) + np.log(_rows(batch, "prior", k)) + _rows(batch, "says", k))
            best = posterior.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in passed), pa.array(names[best], pa.string()), pa.array(posterior.max(axis=1))],
                names=[*passed, "lang", "confidence"])

    passed = [*held, "declared", "host", "gain"]
    joined = seen.join(by_host, "host", "left").join(by_tag, "declared", "left").select(
        *passed, "logs", F.coalesce("host_prior", top).alias("prior"), F.coalesce("says", F.array_repeat(F.lit(0.0), k)).alias("says"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields if f.name in passed)
    fused = joined.mapInArrow(fuse, f"{schema}, lang string, confidence double")
    return fused.select(*[F.col(h).alias(c) for h, c in zip(held, keep)], "declared", "host", "lang", "confidence", "gain",
                        ((F.col("confidence") >= LEAST_CONFIDENCE) & (F.col("gain") >= LEAST_GAIN)).alias("accepted"))
