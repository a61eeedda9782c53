"""Byte-level BPE against the tokenizers library."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import documents
from ledgerloom.llm import bpe
from ledgerloom.llm.queries import TOKENIZER

ODD = ["", " ", "  ", "a ", " a", "a  b", "a \n b\t\tc", "don't we'll I'd", "x" * 3000 + " " + "ab" * 2000, "日本語 テスト　全角",
       "a<|endoftext|> b<|endoftext|>", " x y\u0085z\x1ca", "é😀 ñ 123 45,6", "\r\n\r\n x", "<|endoftext|>", "ﬁ ² ٣ Ⅷ"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def encoder():
    return bpe.worker_encoder(bpe.read_spec(TOKENIZER))


def ids_of(encoder, text):
    return [int.from_bytes(b[i:i + 4], "little") for b in [encoder.encode(text)] for i in range(0, len(b), 4)]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(reference, encoder, text):
    want = reference.encode(text, add_special_tokens=False).ids
    assert ids_of(encoder, text) == want
    assert encoder.decode(want) == reference.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(reference, encoder, text):
    assert ids_of(encoder, text) == reference.encode(text, add_special_tokens=False).ids
    assert encoder.decode(ids_of(encoder, text)) == text


def test_words_are_forgotten_in_two_halves():
    asked = []
    memory = bpe.Remember(lambda k: asked.append(k) or k.upper(), 4)
    for k in "ababcabdabeab":
        assert memory[k] == k.upper()
    assert asked.count("a") == asked.count("b") == 1
    assert len(memory) <= 2


def test_query_digests(spark, reference):
    rows = [*enumerate(ODD), (None, "no id"), (50, None), (0, "a repeated id")]
    got = bpe.digests(documents(spark, rows), TOKENIZER).collect()
    want = []
    for i, text in rows:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_empty_table(spark):
    assert bpe.digests(documents(spark, []), TOKENIZER).collect() == []
