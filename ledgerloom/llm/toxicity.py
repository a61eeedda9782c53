"""Toxicity by weak supervision.

Method: many voters look at a text: one for each lexicon entry (a word, or the
beginning of words), one for each pattern, and one that votes clean when no
entry occurs. A generative label model, fitted by expectation maximisation,
estimates how often each voter speaks for toxic and for clean texts; voters
that agree more than the label explains are correlated, and share their
weight. A linear classifier is then trained on the posterior labels and scores
every text.

The lexicon is a few known insults and entries that the labelled training rows
single out. Scores use the text alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import exp, log, log1p
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import held_out_bucket, materialize, name, pick, sampled, text_slices

#: Labelled rows (about) that train the models, taken by a hash.
TRAINING_ROWS = 20_000
#: Beginnings of words that may become entries.
PREFIXES = (4, 5, 6)
#: An entry's labels must differ from the others' by this likelihood ratio
#: statistic, and this share of its texts must be toxic.
LEAST_G2, LEAST_SHARE = 20.0, 0.75
#: What it must reach in either half of the training texts by itself, near
#: copies lying in one half: a word of one group of copies is no entry.
HALF_G2 = 5.0
#: Words whose shingles tell near copies.
SHINGLE = 5
KNOWN = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown")

WORD = re.compile(r"[^\W\d_]+")
# Patterns on the text as it stands; some speak for clean texts.
PATTERNS = {
    "insult after you": re.compile(r"\b(?:you|you're|your) (?:are )?(?:an? )?(?:{})".format("|".join(KNOWN)), re.I),
    "shouting": re.compile(r"(?:\b[A-Z]{4,}\b\W+){4}"),
    "many marks": re.compile(r"[!?]{2,}"),
    "censored word": re.compile(r"\b[a-zA-Z][*#@$%]{2,}[a-zA-Z]\b"),
    "threat": re.compile(r"\b(?:kill|hate|hurt|destroy) (?:you|them|him|her)\b", re.I),
}


@dataclass(frozen=True)
class Lexicon:
    """Whole words, and beginnings of longer words by their length."""

    words: tuple[str, ...]
    prefixes: tuple[str, ...]

    @property
    def voters(self) -> list[str]:
        return [*self.words, *(p + "-" for p in self.prefixes), *PATTERNS, "no entry"]

    @cached_property
    def _places(self) -> tuple[dict[str, int], dict[str, int], frozenset[int]]:
        n = len(self.words)
        return ({w: k for k, w in enumerate(self.words)}, {p: n + k for k, p in enumerate(self.prefixes)},
                frozenset(len(p) for p in self.prefixes))

    def votes(self, text: str) -> dict[int, int]:
        """How often each voter that speaks does (``no entry``: once)."""
        words, prefixes, lengths = self._places
        heard: dict[int, int] = {}
        for w, n in Counter(WORD.findall(text.lower())).items():
            if (at := words.get(w)) is not None:
                heard[at] = heard.get(at, 0) + n
            for k in lengths:
                if len(w) > k and (at := prefixes.get(w[:k])) is not None:
                    heard[at] = heard.get(at, 0) + n
        first = len(words) + len(prefixes)
        silent = not heard
        for k, p in enumerate(PATTERNS.values()):
            if n := sum(1 for _ in p.finditer(text)):
                heard[first + k] = n
        if silent:
            heard[first + len(PATTERNS)] = 1
        return heard


@dataclass
class Votes:
    """The votes of many texts, sparse: voter ``voter[i]`` speaks ``times[i]``
    times in row ``row[i]``; a row stands for ``weight`` texts."""

    row: np.ndarray
    voter: np.ndarray
    times: np.ndarray
    weight: np.ndarray
    voters: int

    @classmethod
    def of(cls, votes: Votes | np.ndarray) -> Votes:
        """A matrix with a row for each text and a column for each voter."""
        if isinstance(votes, Votes):
            return votes
        row, voter = np.nonzero(votes)
        return cls(row, voter, votes[row, voter].astype(float), np.ones(len(votes)), votes.shape[1])

    def with_voter(self, spoke: np.ndarray) -> Votes:
        """One more voter, who speaks in the rows where ``spoke``."""
        more = np.flatnonzero(spoke)
        return Votes(np.concatenate([self.row, more]), np.concatenate([self.voter, np.full(len(more), self.voters)]),
                     np.concatenate([self.times, np.ones(len(more))]), self.weight, self.voters + 1)

    def by_voter(self, rows: np.ndarray, values=1.0) -> np.ndarray:
        """Sums over each voter's rows."""
        return np.bincount(self.voter, weights=rows[self.row] * values, minlength=self.voters)

    def by_row(self, voters: np.ndarray, values=1.0) -> np.ndarray:
        """Sums over each row's voters."""
        return np.bincount(self.row, weights=voters[self.voter] * values, minlength=len(self.weight))

    def together(self) -> np.ndarray:
        """Texts in which each pair of voters speaks."""
        out = np.zeros((self.voters, self.voters))
        order = np.argsort(self.row, kind="stable")
        ends = np.searchsorted(self.row[order], np.arange(len(self.weight) + 1))
        for r, weight in enumerate(self.weight):
            who = self.voter[order[ends[r]:ends[r + 1]]]
            out[np.ix_(who, who)] += weight
        return out


def terms(text: str) -> set[str]:
    """The distinct words of a text, and beginnings (ending in -)."""
    words = set(WORD.findall(text.lower()))
    return {w for w in words if len(w) > 2} | {w[:k] + "-" for w in words for k in PREFIXES if len(w) > k}


def g2(n1: np.ndarray, n0: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Likelihood ratio statistic of a term's texts against all texts."""
    n, base = n1 + n0, toxic / (toxic + clean)
    part = lambda o, e: np.where(o > 0, o * np.log(np.maximum(o, 1) / np.maximum(e, 1e-12)), 0.0)
    return 2 * (part(n1, n * base) + part(n0, n * (1 - base)))


def near_key(text: str) -> int:
    """The least hash of the text's shingles, which near copies mostly share."""
    words = text.lower().split()
    return min(crc32(" ".join(words[k:k + SHINGLE]).encode()) for k in range(max(1, len(words) - SHINGLE + 1)))


def learn_lexicon(counts, toxic: np.ndarray, clean: np.ndarray) -> Lexicon:
    """The known entries and all that pass the tests. ``counts``: frame of term
    and, for either half, the texts of each label that hold it (n1_0, n0_0,
    n1_1, n0_1); ``toxic`` and ``clean``: all texts of either half."""
    known = [w for w in KNOWN]
    if not toxic.all() or not clean.all() or not len(counts):
        return Lexicon(tuple(known), ())
    good, n1, n0 = np.ones(len(counts), dtype=bool), 0.0, 0.0
    for half in (0, 1):
        a, b = counts[f"n1_{half}"].to_numpy(float), counts[f"n0_{half}"].to_numpy(float)
        good &= (g2(a, b, toxic[half], clean[half]) >= HALF_G2) & (a >= LEAST_SHARE * (a + b))
        n1, n0 = n1 + a, n0 + b
    score = g2(n1, n0, toxic.sum(), clean.sum())
    good &= score >= LEAST_G2
    rows = sorted(zip(-score[good], counts["term"][good], n1[good], n0[good]), key=lambda r: (r[0], r[1]))
    words, prefixes = {w: None for w in known}, {}
    begun = {w[:k] for w in words for k in PREFIXES}  # beginnings of chosen words
    for _, term, *_ in rows:
        stem = term.rstrip("-")
        # a longer entry says nothing that a chosen beginning of it does not
        if stem in known or any(stem[:k] in prefixes for k in PREFIXES):
            continue
        if not term.endswith("-"):
            words[stem] = None
            begun.update(stem[:k] for k in PREFIXES)
        elif stem not in begun:
            prefixes[stem] = None
    return Lexicon(tuple(words), tuple(prefixes))


@dataclass
class LabelModel:
    """P(voter speaks | label) with a weight for each voter that its
    correlations with other voters, given the label, lower."""

    prior: float
    speaks: np.ndarray  # 2 x voters
    weight: np.ndarray

    def posterior(self, votes: Votes | np.ndarray) -> np.ndarray:
        votes = Votes.of(votes)
        yes = self.weight * np.log(self.speaks[1] / self.speaks[0])
        no = self.weight * np.log((1 - self.speaks[1]) / (1 - self.speaks[0]))
        odds = log(self.prior / (1 - self.prior)) + no.sum() + votes.by_row(yes - no)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_label_model(votes: Votes | np.ndarray, start: np.ndarray, turns: int = 25) -> LabelModel:
    """Expectation maximisation from first guesses ``start`` of P(toxic).

    What the label leaves over of a vote is the vote less p * d + s, where s is
    how often the voter speaks for clean texts and d how much oftener for toxic
    ones; the residuals' products are sums of a few vectors' products, so no
    matrix of texts by voters is ever made.
    """
    votes = Votes.of(votes)
    n, total = votes.weight, votes.weight.sum()
    together, spoken = votes.together(), votes.by_voter(votes.weight)
    p = np.clip(start, 0.02, 0.98)
    for _ in range(turns):
        toxic = votes.by_voter(n * p)
        mass, square = (n * p).sum(), (n * p * p).sum()
        speaks = np.clip((np.stack([spoken - toxic, toxic]) + 0.5) / (np.array([[total - mass], [mass]]) + 1.0), 1e-4, 1 - 1e-4)
        s, d = speaks[0], speaks[1] - speaks[0]
        # correlation that the label leaves over
        left = together - np.outer(toxic, d) - np.outer(d, toxic) - np.outer(spoken, s) - np.outer(s, spoken)
        left += square * np.outer(d, d) + mass * (np.outer(d, s) + np.outer(s, d)) + total * np.outer(s, s)
        scale = np.sqrt(np.maximum(np.diag(left), 0) / total) + 1e-9
        share = left / total / np.outer(scale, scale)
        np.fill_diagonal(share, 0)
        weight = 1 / (1 + np.where(share > 0.1, share, 0).sum(axis=1))
        model = LabelModel(float(np.clip(mass / total, 0.001, 0.999)), speaks, weight)
        p = model.posterior(votes)
    return model


@dataclass
class Classifier:
    """``weights``: bias, whether and (log) how often each voter speaks, and (log) how often all entries together do."""

    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str) -> float:
        heard, entries = self.lexicon.votes(text), len(self.lexicon.words) + len(self.lexicon.prefixes)
        w, n = self.weights, entries + len(PATTERNS) + 1
        z = w[0] + w[-1] * log1p(sum(k for v, k in heard.items() if v < entries))
        for v, k in heard.items():
            z += w[1 + v] + w[1 + n + v] * log1p(k)
        return 1 / (1 + exp(-max(-40.0, min(40.0, float(z)))))


def train_classifier(lexicon: Lexicon, votes: Votes, target: np.ndarray, turns: int = 500, decay: float = 1e-3) -> Classifier:
    v, share = votes.voters, votes.weight / votes.weight.sum()
    often = np.log1p(votes.times)
    is_entry = (votes.voter < v - len(PATTERNS) - 1).astype(float)
    entries = np.log1p(votes.by_row(np.ones(v), votes.times * is_entry))
    w, speed = np.zeros(2 + 2 * v), np.zeros(2 + 2 * v)
    for turn in range(turns):
        z = w[0] + votes.by_row(w[1:1 + v]) + votes.by_row(w[1 + v:-1], often) + w[-1] * entries
        miss = share * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target)
        slope = np.concatenate([[miss.sum()], votes.by_voter(miss), votes.by_voter(miss, often), [(miss * entries).sum()]])
        slope[1:] += decay * w[1:]
        speed = 0.9 * speed + 0.1 * slope**2
        w = w - 0.1 * (1 - turn / turns) * slope / np.sqrt(speed + 1e-12)
    return Classifier(lexicon, w)


def fit(rows: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> Classifier:
    """The classifier from ``rows`` (id, text, held_out) and ``labels`` (id,
    toxic). Held-out rows and labels are never read into it. An id with
    several labels counts as toxic when half of them are."""
    known = (labels.where("id is not null and toxic is not null").groupBy("id")
             .agg((F.avg(F.col("toxic").cast("double")) >= 0.5).cast("int").alias("toxic"))
             .where(held_out_bucket(F.col("id")) != 0))
    n = known.count()
    if not n:
        return Classifier(Lexicon(KNOWN, ()), _without_labels(Lexicon(KNOWN, ())))
    share = min(1.0, training_rows / n)
    taken = known.where(sampled(share, "id"))
    # about training_rows ids, whatever the table's size: the texts stay in place
    sample = materialize(rows.where(~F.col("held_out")).join(F.broadcast(taken), "id").select("text", "toxic"), "labelled_texts")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [near_key(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=["text", "toxic", "near"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {(label, half): Counter() for label in (0, 1) for half in (0, 1)}

        def out() -> pa.RecordBatch:
            names = sorted(set().union(*found.values()))
            batch = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([found[label, half][t] for t in names], pa.int64()) for label, half in found)],
                names=["term", *(f"n{label}_{half}" for label, half in found)])
            for c in found.values():
                c.clear()
            return batch

        for batch in batches:
            for text, toxic, near in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "near"))):
                found[toxic, near % 2].update(terms(text or ""))
                found[toxic, near % 2][""] += 1  # the texts themselves
                if sum(map(len, found.values())) > 300_000:
                    yield out()
        yield out()

    # near copies with one label are one text when entries are sought
    apart = (sample.mapInArrow(keyed, "text string, toxic int, near bigint").groupBy("near", "toxic")
             .agg(F.min("text").alias("text")))
    each = ["n0_0", "n0_1", "n1_0", "n1_1"]
    counted = apart.mapInArrow(count, "term string, " + ", ".join(f"{c} bigint" for c in each)).groupBy("term").agg(
        *[F.sum(c).alias(c) for c in each])
    # what fails by its share of toxic texts stays on the executors
    passes = " and ".join(f"n1_{h} >= 1 and n1_{h} >= 3 * n0_{h}" for h in (0, 1))
    counts = counted.where(f"term = '' or ({passes})").toPandas()
    texts = counts[counts["term"] == ""]
    toxic, clean = (texts[[f"n{label}_0", f"n{label}_1"]].to_numpy(float).sum(axis=0) for label in (1, 0))
    lexicon = learn_lexicon(counts[counts["term"] != ""].reset_index(drop=True), toxic, clean)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heard = [sorted(lexicon.votes(t or "").items()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[v for v, _ in h] for h in heard], pa.list_(pa.int32())),
                 pa.array([[n for _, n in h] for h in heard], pa.list_(pa.int32())), batch.column("toxic")],
                names=["voters", "times", "toxic"])

    if not toxic.any() or not clean.any():
        return Classifier(lexicon, _without_labels(lexicon))
    # equal votes are one row: training_rows of them at most
    seen = (sample.mapInArrow(vote, "voters array<int>, times array<int>, toxic int").groupBy("voters", "times", "toxic")
            .agg(F.count(F.lit(1)).alias("n")).collect())
    seen.sort(key=lambda r: (r["voters"], r["times"], r["toxic"]))
    votes = Votes(np.repeat(np.arange(len(seen)), [len(r["voters"]) for r in seen]),
                  np.array([v for r in seen for v in r["voters"]], dtype=np.int64),
                  np.array([t for r in seen for t in r["times"]], dtype=float),
                  np.array([r["n"] for r in seen], dtype=float), len(lexicon.voters))
    given = np.array([r["toxic"] for r in seen])
    # the given label is a voter among the others: it has an accuracy, too
    judged = votes.with_voter(given > 0)
    model = fit_label_model(judged, np.where(given > 0, 0.9, 0.1))
    return train_classifier(lexicon, votes, model.posterior(judged))


def _without_labels(lexicon: Lexicon) -> np.ndarray:
    """Weights where no labels tell more: any entry makes a text toxic."""
    n = len(lexicon.voters)
    w = np.zeros(2 + 2 * n)
    w[0], w[-1] = -2.0, 4.0
    return w


def score(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          toxic_column: str = "toxic", training_rows: int = TRAINING_ROWS) -> DataFrame:
    """Every whole text's toxicity.

    ``labels`` has ``id_column`` and ``toxic_column`` (0 or 1; null rows are
    ignored). Returns ``id_column``, held_out (crc32 of the id as text, modulo
    5, is 0; such rows teach nothing), score (0 to 1) and predicted (score >=
    0.5), a row for each input row. Null and empty texts score like texts
    without any word; a null id stays null. Without labels of both kinds the
    known entries decide. Tables without rows give no rows. Texts are read
    whole; the models have a bounded size.
    """
    kind = df.schema[id_column].dataType.simpleString()
    rows = pick(df, id=id_column, text=text_column).withColumn("held_out", held_out_bucket(F.col("id")) == 0)
    known = labels.select(name(id_column).alias("id"), name(toxic_column).alias("toxic"))
    model = df.sparkSession.sparkContext.broadcast(fit(rows, known, training_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = model.value
        for whole in batches:
            for batch in text_slices(whole, "text"):
                found = [classifier.score(t or "") for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("held_out"), pa.array(found, pa.float64())],
                    names=["id", "held_out", "score"])

    return (rows.mapInArrow(run, f"id {kind}, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumnRenamed("id", id_column))


def keep_clean(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               toxic_column: str = "toxic", training_rows: int = TRAINING_ROWS) -> DataFrame:
    """The rows of ``df`` whose text is not predicted toxic (as ``score``
    predicts it), with all of its columns, in one pass without a shuffle."""
    rows = pick(df, id=id_column, text=text_column).withColumn("held_out", held_out_bucket(F.col("id")) == 0)
    known = labels.select(name(id_column).alias("id"), name(toxic_column).alias("toxic"))
    model = df.sparkSession.sparkContext.broadcast(fit(rows, known, training_rows))
    at = df.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = model.value
        for whole in batches:
            for batch in text_slices(whole, whole.schema.names[at]):
                clean = [classifier.score(t or "") < 0.5 for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

    return df.mapInArrow(run, df.schema)
