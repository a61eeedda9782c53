"""The trie of rebuilt conversations against plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from ledgerloom.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, kind int, run int, p int, code string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, 2, 3, "c") for r in rows], SCHEMA)


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [turn[2:] for turn in sorted(v, key=lambda z: z[:2])] for c, v in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    nodes = {}
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            nodes.setdefault(paths[c][:d], []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = (len(nodes[p]) - 1) * words(p) + sum(saved[k] for k in kids.get(p, []))
    return sorted((m[0], len(p), nodes[p[:-1]][0] if p else -1, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if paths[c] == p).encode()).hexdigest()) for p, m in nodes.items())


def run(spark, rows, **more):
    out = prefix_trie.trie(frame(spark, rows), **more)
    assert out.columns == prefix_trie.NODE
    return sorted(tuple(-1 if x is None else x for x in r) for r in out.collect())


def conversations(n, seed=1):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(rng.choices("ab", k=rng.choice([1, 1, 2, 4])))))
    return rows


@pytest.mark.parametrize("more", [{}, {"most_cells": 1}, {"run_turns": 2, "hot_turns": 4}])
def test_against_plain_python(spark, more):
    rows = conversations(400)
    rows += [(c, t, "user", f"alike {t}") for c in range(1000, 1300) for t in range(4)]  # many equal conversations
    assert run(spark, rows, **more) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", ""), (1, 3, "user", "x y z\x1c"), (21, 0, "user", "q"),
            (45, 5, "user", "late"), (-3, 0, "a", "b"), (-3, 1, "ab", ""), (-20, 0, "a", "b"), (7, 1, "user", "same"), (7, 1, "user", "same"),
            (7, 1, "user", "same"), (7, 1, "user", "same"), (60, 0, "user", "long " * 300_000), (61, 2, "u", "t")]
    assert run(spark, rows) == brute(rows)


def test_only_empty_and_no_conversations(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "user", "x")]) == []
    short = [(c, 0, "user", "x") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4]  # own turn replaced, no first conversation
    assert run(spark, short) == brute(short) and len(brute(short)) == 1


def test_one_long_conversation(spark):
    rows = [(40, t, "user", f"turn {t % 7}") for t in range(1500)] + [(41, t, "user", f"turn {t % 7}") for t in range(1400)] + [(59, 9, "u", "z")]
    assert run(spark, rows, run_turns=64, hot_turns=100) == brute(rows)


def test_ids_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 16)
    ends = spark.range(-50, 3000).selectExpr("cast(if(id % 3 = 0, 'one', 'two') as binary) as digest", "id as conv_id")
    got = {bytes(r["digest"]): r["ends_sha256"] for r in prefix_trie.list_digests(ends).collect()}
    for mark, part in ((b"one", [i for i in range(-50, 3000) if i % 3 == 0]), (b"two", [i for i in range(-50, 3000) if i % 3])):
        assert got[mark] == hashlib.sha256(",".join(map(str, part)).encode()).hexdigest()


def test_screening_proves_only_singletons_and_most_of_them(spark):
    rows = conversations(3000, seed=5) + [(c, 0, "user", f"own {c}") for c in range(5000, 9000)]
    turns = frame(spark, rows).select("conv_id", "turn", prefix_trie.turn_code(prefix_trie.F.col("role"), prefix_trie.F.col("text")).alias("code"),
                                      prefix_trie.F.lit(1).cast("long").alias("words"))
    marked = prefix_trie.screen(prefix_trie.prefixes(prefix_trie.rebuilt(turns, 20, 4))).toPandas()
    alone = marked.groupby("digest")["conv_id"].transform("size") == 1
    assert not ((marked["kind"] > 0) & ~alone).any()
    assert (marked["kind"] > 0).sum() > 0.9 * alone.sum()
