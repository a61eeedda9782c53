"""Byte-level BPE encoding and decoding of whole texts.

Method: the symbols of a word stand in a doubly linked list; a priority queue
holds (merge rank, position) of adjacent pairs. The lowest entry is taken; it
is stale, and skipped, when its two symbols are no longer the ones it was
queued for. A merge replaces the left symbol, unlinks the right one and queues
the two new neighbouring pairs. Decoding concatenates vocabulary strings.

Words repeat, so each Python worker keeps the ids of words and of
space-separated chunks in bounded dictionaries; a miss runs the merge queue.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick, text_slices

# Fixed value: the word pattern of byte-level BPE vocabularies of this kind.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that the dictionaries of words and of chunks may hold.
CACHE_WORDS, CACHE_CHUNKS = 600_000, 150_000
#: Longer chunks are encoded without being remembered.
CACHE_CHARS = 64
_TWO_SPACES = re.compile(r"\s\s")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary string stands for.

    Printable bytes stand for themselves; the others take the code points
    from 256 on, in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Remember(dict):
    """A bounded dictionary that computes what it lacks.

    Once half of the entries are new, the others are forgotten unless they
    were asked for meanwhile: frequent keys stay.
    """

    def __init__(self, compute, entries: int):
        super().__init__()
        self.compute, self.entries, self.older = compute, entries, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= self.entries // 2:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Vocabulary:
    """Vocabulary, merges and special tokens of a tokenizers JSON file."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        self.alphabet = byte_alphabet()
        self.vocab: dict[str, int] = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.split_special = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        # rank of a pair by its left and right half; halves and result by rank
        self.pairs: list[tuple[int, int]] = []
        self.merged: list[int] = []
        self.rank: list[dict[int, int]] = [{} for _ in range(1 + max(self.vocab.values()))]
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.append((self.vocab[a], self.vocab[b]))
            self.merged.append(self.vocab[a + b])
            self.rank[self.vocab[a]].setdefault(self.vocab[b], rank)
        self.byte_id = [0] * 256
        for char, byte in self.alphabet.items():
            self.byte_id[byte] = self.vocab[char]
        self.strings: dict[int, bytes] = {i: self.to_bytes(s) for s, i in self.vocab.items()}
        self.strings |= {i: s.encode() for s, i in self.special.items()}

    def to_bytes(self, token: str) -> bytes:
        if all(c in self.alphabet for c in token):
            return bytes(self.alphabet[c] for c in token)
        return token.encode()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word by the queue of merge ranks (equal ranks go from
        left to right)."""
        symbol = list(map(self.byte_id.__getitem__, word))
        n, ranks = len(symbol), self.rank
        queue = []
        for i in range(n - 1):
            if (right := symbol[i + 1]) in (known := ranks[symbol[i]]):
                queue.append((known[right], i))
        if not queue:
            return symbol
        pairs, merged, pop, push = self.pairs, self.merged, heapq.heappop, heapq.heappush
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heapq.heapify(queue)
        while queue:
            rank, i = pop(queue)
            left, right = pairs[rank]
            if symbol[i] != left or (j := after[i]) < 0 or symbol[j] != right:
                continue  # stale
            symbol[i] = new = merged[rank]
            symbol[j] = -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (right := symbol[k]) in (known := ranks[new]):
                    push(queue, (known[right], i))
            h = before[i]
            if h >= 0 and new in (known := ranks[symbol[h]]):
                push(queue, (known[new], h))
        return [s for s in symbol if s >= 0]


class Encoder:
    """Whole texts to ids (little-endian unsigned 32-bit, as bytes)."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        find = regex.compile(WORDS).findall
        words = Remember(lambda w: struct.pack(f"<{len(ids := vocabulary.merge(w.encode()))}I", *ids), CACHE_WORDS)
        self.plain = lambda text: b"".join(map(words.__getitem__, find(text)))
        self.first = Remember(self.plain, CACHE_CHUNKS)
        self.spaced = Remember(lambda chunk: self.plain(" " + chunk), CACHE_CHUNKS)

    def ordinary(self, text: str) -> bytes:
        """No word of the pattern spans a single space that follows and
        precedes other characters: there the text may be cut into chunks,
        each with its leading space. Texts with two white-space characters in
        a row go to the pattern whole."""
        if _TWO_SPACES.search(text):
            return self.plain(text)
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.spaced.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        split = self.vocabulary.split_special
        if split is None or not any(s in text for s in self.vocabulary.special):
            return self.ordinary(text) if text else b""
        ids = []
        for part in split.split(text):
            special = self.vocabulary.special.get(part)
            ids.append(np.array([special], dtype="<u4").tobytes() if special is not None
                       else self.ordinary(part) if part else b"")
        return b"".join(ids)

    def decode(self, ids) -> str:
        return b"".join(map(self.vocabulary.strings.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[bytes, Encoder] = {}


def worker_encoder(spec: str) -> Encoder:
    """One encoder for each vocabulary in a Python worker."""
    key = hashlib.sha1(spec.encode()).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Vocabulary(spec))
    return _ENCODERS[key]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _id_lists(parts: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))


def encode(df: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of every whole text.

    Returns ``id_column`` and ``ids`` array<int>, a row for each input row
    (repeated rows repeat; a null id stays null). A null or empty text has no
    ids. Special-token strings in a text take their own id, as the tokenizers
    library does by default. Any length of text works; a worker holds a few
    MB of text at a time. The vocabulary (a few MB, a parameter) is read by
    the driver and broadcast.
    """
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(spec.value)
        for whole in batches:
            for batch in text_slices(whole, "text"):
                ids = [encoder.encode(t or "") for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("id"), _id_lists(ids)], names=["id", "ids"])

    kind = df.schema[id_column].dataType.simpleString()
    picked = pick(df, id=id_column, text=text_column).withColumn("text", F.col("text").cast("string"))
    return picked.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decode(df: DataFrame, tokenizer_path: str, ids_column: str = "ids", output: str = "decoded") -> DataFrame:
    """``df`` with ``output``: the vocabulary strings of ``ids_column``
    concatenated and read as UTF-8 (broken sequences become U+FFFD). Null ids
    give the empty text."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    columns, at = df.columns, df.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(spec.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                lists = part.column(at)
                ends, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
                text = [encoder.decode(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())],
                                                 names=[*columns, output])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{output}` string")


def digests(df: DataFrame, tokenizer_path: str) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of each document's round trip."""
    coded = decode(encode(df, tokenizer_path), tokenizer_path)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
