"""Packing: every id once, gapless sequences, little padding."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers import documents
from ledgerloom.llm import cutting_stock, packing
from ledgerloom.llm.common import read
from ledgerloom.llm.queries import TOKENIZER


def check(pieces, texts, capacity=1024):
    """Pieces (rows) against the library's ids of the texts; returns the padding's share."""
    reference = Tokenizer.from_file(TOKENIZER)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids)) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    used = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == used.get(p["sequence_id"], 0)
        used[p["sequence_id"]] = p["offset"] + p["length"]
    assert not used or max(used.values()) <= capacity
    return 1 - sum(used.values()) / (capacity * len(used)) if used else 0


def test_odd_documents(spark):
    texts = {0: "", 1: None, 2: "one", 3: "word " * 5000, 4: "same text", 5: "same text", 6: "x<|endoftext|>  y", None: "no id"}
    check(packing.pack(documents(spark, list(texts.items())), TOKENIZER).collect(), texts)


def test_a_length_that_a_third_of_all_rows_share(spark):
    texts = {i: "the same words" if i % 3 else "other words of " + "another length " * (i % 40) for i in range(300)}
    assert check(packing.pack(documents(spark, list(texts.items())).repartition(7), TOKENIZER).collect(), texts) < 0.15


def test_little_padding_on_the_table(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert check(packing.pack(docs, TOKENIZER).collect(), texts) < 0.02


def test_repeated_rows_are_packed_each(spark):
    rows = packing.pack(documents(spark, [(1, "a b c")] * 3), TOKENIZER).collect()
    assert len(rows) == 3 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 3


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), TOKENIZER).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_the_demand_exactly(seed):
    rng = np.random.default_rng(seed)
    demand = {int(k): int(rng.integers(0, 500)) for k in rng.choice(np.arange(1, 129), 40, replace=False)}
    found = cutting_stock.patterns(demand, 128)
    held = {}
    for times, copies in found:
        assert sum(k * c for k, c in copies.items()) <= 128
        for k, c in copies.items():
            held[k] = held.get(k, 0) + times * c
    assert held == {k: v for k, v in demand.items() if v}


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(3)
    length, value = np.array([3, 4, 7, 9]), rng.random(4)
    best = max(sum(c * v for c, v in zip(copies, value)) for copies in np.ndindex(8, 6, 4, 3)
               if sum(c * n for c, n in zip(copies, length)) <= 22)
    got, copies = cutting_stock.knapsack(value, length, 22)
    assert np.isclose(got, best) and np.isclose(copies @ value, best) and copies @ length <= 22


def test_linear_program_reaches_a_known_optimum():
    # 6 + 4, 5 + 5, 3 + 3 + 4: no waste is possible
    demand = {6: 10, 4: 20, 5: 20, 3: 20}
    _, _, used = cutting_stock.solve(demand, 10, gap=1e-9)
    assert np.isclose(used.sum(), (60 + 80 + 100 + 60) / 10)


def test_long_runs_of_white_space(spark):
    texts = {0: "word" + " " * 3_000_000 + "word", 1: "\n" * 1_200_000, 2: "a" + "\n \t" * 400_000 + "b", 3: " " * 1000 + "x" + " " * 1001,
             4: "é" + "\u3000" * 5000 + " y", 5: " \x1c" * 4000 + "z", 6: "<|endoftext|>" + " " * 2000 + "<|endoftext|>x"}
    check(packing.pack(documents(spark, list(texts.items())), TOKENIZER).collect(), texts)
