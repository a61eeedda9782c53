"""Weak supervision for toxicity: label model, held-out accuracy."""

import zlib

import numpy as np
import pytest

from helpers import documents
from ledgerloom.llm import toxicity
from ledgerloom.llm.common import read


def labels(spark, rows):
    return spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id bigint, toxic int, text string")


def made(n=600, seed=0):
    """Texts whose toxic ones hold words with the beginning 'zorba'."""
    rng = np.random.default_rng(seed)
    rows, marks = [], []
    for i in range(n):
        words = [f"{a}{b}" for a, b in zip(rng.choice(["wal", "ner", "ots", "ima"], 40), rng.choice(["do", "ku", "pe", "ri"], 40))]
        toxic = int(i % 5 == 1)
        if toxic:
            for _ in range(3):
                words[rng.integers(40)] = "zorba" + rng.choice(["do", "ku", "pe", "ri", "mil", "xa"])
        rows.append((i, " ".join(words)))
        marks.append((i, toxic if rng.random() > 0.03 else 1 - toxic))
    return rows, marks, [int(i % 5 == 1) for i in range(n)]


def test_learns_beginnings_and_holds_rows_out(spark):
    rows, marks, truth = made()
    got = {r["doc_id"]: r for r in toxicity.score(documents(spark, rows), labels(spark, marks)).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_held_out_labels_teach_nothing(spark):
    rows, marks, _ = made(200)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in marks]
    one, two = ({r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, rows), labels(spark, m)).collect()}
                for m in (marks, flipped))
    assert one == two


def test_odd_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "you are an idiot"), (3, "you are an idiot and a moron"), (3, "fine words")])
    got = sorted((str(r["doc_id"]), r["predicted"]) for r in toxicity.score(docs, labels(spark, [(None, 1), (1, None), (4, 1)])).collect())
    assert got == [("1", 0), ("2", 0), ("3", 0), ("3", 1), ("None", 1)]
    assert toxicity.score(docs.where("false"), labels(spark, [])).collect() == []
    clean = toxicity.keep_clean(docs, labels(spark, []))
    assert clean.columns == docs.columns and sorted(str(r["text"]) for r in clean.collect()) == ["", "None", "fine words"]


def test_table_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    marks = {r["doc_id"]: r["toxic"] for r in read(spark, sf, "labels").collect()}
    got = [r for r in toxicity.score(read(spark, sf, "documents"), read(spark, sf, "labels")).collect()
           if r["held_out"] and r["doc_id"] in marks]
    toxic = [r["predicted"] for r in got if marks[r["doc_id"]]]
    clean = [r["predicted"] for r in got if not marks[r["doc_id"]]]
    assert np.mean(toxic) >= 0.8 and np.mean(clean) <= 0.01


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(1)
    y = rng.random(6000) < 0.3
    rates = [(0.9, 0.05), (0.7, 0.1), (0.6, 0.02), (0.5, 0.3)]
    spoke = np.stack([np.where(y, rng.random(6000) < a, rng.random(6000) < b) for a, b in rates], axis=1)
    spoke = np.concatenate([spoke, spoke[:, 3:], spoke[:, 3:]], axis=1)  # copies of the worst voter
    model = toxicity.fit_label_model(spoke, np.clip(spoke[:, :3].mean(axis=1), 0.1, 0.9))
    assert np.allclose(model.speaks[1][:3], [0.9, 0.7, 0.6], atol=0.06) and np.allclose(model.speaks[0][:3], [0.05, 0.1, 0.02], atol=0.04)
    assert (model.weight[3:] < 0.5).all() and (model.weight[:3] > 0.8).all()
    assert np.mean((model.posterior(spoke) >= 0.5) == y) > 0.93


@pytest.mark.parametrize("n1, n0", [(0, 0), (5, 0), (0, 5)])
def test_statistic_is_finite(n1, n0):
    assert np.isfinite(toxicity.g2(np.array([n1 * 1.0]), np.array([n0 * 1.0]), 10, 90)).all()


def pseudo(k, length=8):
    """A word of letters alone, another for each k; no two share a beginning."""
    out, k = "", (k * 7919 + 1) % 26**5
    for _ in range(length):
        out += chr(97 + k % 26)
        k = k // 26 + 31 * (k % 7)
    return out


def test_every_telling_word_becomes_an_entry():
    import pandas as pd
    words = sorted({pseudo(k)[:6] + "qx" for k in range(400)})
    counts = pd.DataFrame({"term": words, "n1_0": 20, "n0_0": 0, "n1_1": 20, "n0_1": 1})
    found = toxicity.learn_lexicon(counts, np.array([500.0, 500.0]), np.array([5000.0, 5000.0]))
    assert set(words) <= set(found.words) and len(words) > 200
    one_half = counts.assign(n1_0=0)
    assert toxicity.learn_lexicon(one_half, np.array([500.0, 500.0]), np.array([5000.0, 5000.0])).words == toxicity.KNOWN


def test_words_of_one_group_of_copies_are_no_entries(spark):
    rows, marks, _ = made(900)
    group = [(5000 + i, "umbrella lantern " * 20 + "zorbaxa umbrella pavilion quorum") for i in range(60)]
    marks += [(i, 1) for i, _ in group]
    df = documents(spark, rows + group)
    from pyspark.sql import functions as F
    held = toxicity.held_out_bucket(F.col("id")) == 0
    model = toxicity.fit(toxicity.pick(df, id="doc_id", text="text").withColumn("held_out", held),
                         labels(spark, marks).select(F.col("doc_id").alias("id"), "toxic"))
    entries = " ".join([*model.lexicon.words, *model.lexicon.prefixes])
    assert "zorb" in entries and not any(w[:4] in entries for w in ("umbrella", "lantern", "pavilion", "quorum"))


def test_near_copies_share_a_key():
    rng = np.random.default_rng(4)
    words = [pseudo(k) for k in range(200)]
    same = 0
    for _ in range(100):
        changed = list(words)
        changed[rng.integers(200)] = "other"
        same += toxicity.near_key(" ".join(changed)) == toxicity.near_key(" ".join(words))
    assert same >= 85
    assert toxicity.near_key("") == toxicity.near_key(" ") != toxicity.near_key("one two")


def test_sparse_votes_equal_dense_ones():
    rng = np.random.default_rng(5)
    dense = rng.poisson(0.3, size=(300, 9))
    weight = rng.integers(1, 5, 300).astype(float)
    votes = toxicity.Votes.of(dense)
    votes.weight = weight
    spoke = (dense > 0).astype(float)
    assert np.allclose(votes.together(), (spoke * weight[:, None]).T @ spoke)
    assert np.allclose(votes.by_voter(weight), weight @ spoke) and np.allclose(votes.by_row(np.arange(9.0)), spoke @ np.arange(9.0))
    assert np.allclose(votes.with_voter(dense[:, 0] > 0).by_row(np.ones(10)), spoke.sum(axis=1) + spoke[:, 0])


def test_label_model_equals_residuals_of_whole_matrices():
    """One turn of expectation maximisation on the repeated rows themselves."""
    rng = np.random.default_rng(6)
    dense = rng.random((60, 5)) < 0.4
    dense[:, 4] = dense[:, 3]
    times = rng.integers(1, 4, 60)
    start = rng.uniform(0.1, 0.9, 60)
    votes = toxicity.Votes.of(dense)
    votes.weight = times.astype(float)
    got = toxicity.fit_label_model(votes, start, turns=1)
    spoke, p = np.repeat(dense, times, axis=0).astype(float), np.repeat(start, times)
    speaks = np.stack([((1 - p) @ spoke + 0.5) / ((1 - p).sum() + 1), (p @ spoke + 0.5) / (p.sum() + 1)])
    rest = spoke - (p[:, None] * speaks[1] + (1 - p)[:, None] * speaks[0])
    scale = np.sqrt((rest**2).mean(axis=0))
    share = rest.T @ rest / len(rest) / np.outer(scale, scale)
    np.fill_diagonal(share, 0)
    assert np.allclose(got.speaks, speaks)
    assert np.allclose(got.weight, 1 / (1 + np.where(share > 0.1, share, 0).sum(axis=1)), atol=1e-6)
    odds = np.log(got.prior / (1 - got.prior)) + (np.where(dense, np.log(speaks[1] / speaks[0]), np.log((1 - speaks[1]) / (1 - speaks[0])))
                                                  * got.weight).sum(axis=1)
    assert np.allclose(got.posterior(votes), 1 / (1 + np.exp(-odds)))


def test_scores_equal_votes_times_weights():
    """The score of a text recomputed voter by voter from its words."""
    lexicon = toxicity.Lexicon(("idiot", "grumble"), ("zorba", "idio"))
    n = len(lexicon.voters)
    weights = np.random.default_rng(7).normal(size=2 + 2 * n)
    model = toxicity.Classifier(lexicon, weights)
    for text in ("", "fine words", "You idiot!! zorbaku zorba ZORBAxa grumble idiots", "I hate you " * 3, "no entry " * 100_000 + "idiot"):
        words = toxicity.WORD.findall(text.lower())
        counts = [words.count("idiot"), words.count("grumble"), sum(w.startswith("zorba") and w != "zorba" for w in words),
                  sum(w.startswith("idio") and w != "idio" for w in words)]
        all_votes = [*counts, *(len(p.findall(text)) for p in toxicity.PATTERNS.values()), int(not any(counts))]
        x = [1.0, *(float(v > 0) for v in all_votes), *np.log1p(all_votes), np.log1p(sum(counts))]
        assert abs(model.score(text) - 1 / (1 + np.exp(-np.clip(np.dot(x, weights), -40, 40)))) < 1e-9
