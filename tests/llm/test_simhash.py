"""SimHash near-dedup against brute force."""

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import components_of, documents
from ledgerloom.llm import simhash
from ledgerloom.llm.common import read
from ledgerloom.llm.xxh64 import xxh64


def brute(text, shingle=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ")
             .replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    shingles = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(shingles))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aB é\t\n Zzx", max_size=40), max_size=8))
def test_fingerprints(texts):
    got = simhash.fingerprints_of(pa.array(texts, pa.string()), 4)
    assert [int(x) for x in got] == [brute(t) for t in texts]


def test_long_texts_in_several_runs(monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 97)
    texts = [" ".join(f"w{i % 700}" for i in range(1500)), "a", "", " ".join("q" for _ in range(600))]
    assert [int(x) for x in simhash.fingerprints_of(pa.array(texts), 4)] == [brute(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=0, max_size=300), st.integers(0, 5))
def test_xxh64(data, shift):
    array = np.frombuffer(bytes(shift) + data, dtype=np.uint8)
    start = np.array([shift] * 40 + list(range(len(array))), dtype=np.int64)
    length = np.array([len(data)] * 40 + [len(array) - i for i in range(len(array))], dtype=np.int64)
    got = xxh64(array, start, length, 42)
    want = [xxhash.xxh64_intdigest(array[s:s + n].tobytes(), 42) for s, n in zip(start, length)]
    assert [int(x) for x in got] == want


def test_near_finds_every_pair_of_tiles():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**64, 400, dtype=np.uint64)
    flip = np.array([sum(1 << int(b) for b in rng.choice(64, k % 7, replace=False)) for k in range(400)], dtype=np.uint64)
    every = np.concatenate([base, base ^ flip])
    count = np.bitwise_count(every)
    found = set()
    for p in np.unique(count):
        for q in np.unique(count):
            if p <= q <= p + 4:
                a, b = np.flatnonzero(count == p), np.flatnonzero(count == q)
                for i, j in simhash.near(every[a], every[b], 4):
                    found |= set(zip(a[i].tolist(), b[j].tolist()))
    x, y = np.nonzero(np.bitwise_count(every[:, None] ^ every[None]) <= 4)
    assert found == {(i, j) for i, j in zip(x.tolist(), y.tolist()) if count[i] <= count[j]}


def expected(rows):
    fps = np.array([brute(t) for _, t in rows], dtype=np.uint64)
    root = components_of(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{int(f):016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, root)), key=str)


def test_components_on_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(5, long), (3, long), (3, long + " end"), (None, long), (9, None), (8, ""), (7, " \n "), (1, "a b"), (2, "A  B"),
            (4, "entirely different words stand here now"), (None, "alone without id in this table")]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_components_on_the_table(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAST_TILE", 16)  # many tiles
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
