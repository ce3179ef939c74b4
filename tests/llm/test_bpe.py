"""Encoding against the tiktoken library; decoding as an exact round trip."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from nestline.llm import bpe, queries
from tests.llm.helpers import documents

PATH, PATTERN = queries.VOCABULARY, public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [None, "", " ", "\n\n  x", "a" * 5000, "word " * 4000, "½²Ⅷ٣ x\x1c\x1dy", "naïve Straße 日本語 🙂🙂", "12345678901234567890",
       "<|endoftext|>", "don't WE'LL", "  z", "ab" * 300 + "é" * 300]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopqrstuvwxyz", "aeiouéèñßü ", "0123456789", " \n\t", "日本語абв", "!?*#=-"])
def test_tree_equals_library(library, alphabet):
    chosen, codec = random.Random(alphabet), bpe.codec(PATH, PATTERN)
    for _ in range(300):
        text = "".join(chosen.choice(alphabet) for _ in range(chosen.randint(1, 200)))
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_joining_any_two_encodings(library):
    chosen, codec = random.Random(3), bpe.codec(PATH, PATTERN)
    for _ in range(500):
        whole = "".join(chosen.choice("abcdehinorst") for _ in range(60)).encode()
        cut = chosen.randint(0, 60)
        assert codec.join(codec.merge(whole[:cut]), codec.merge(whole[cut:])) == codec.merge(whole)


def test_query_equals_library_on_whole_table(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, sf, "documents").collect()}
    rows = queries.QUERIES["op5_byte_level_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_odd_rows_and_clashing_columns(spark, library):
    docs = documents(spark, [(i % 3 or None, t) for i, t in enumerate(ODD + ODD)], extra=("n_tokens", "ids", "encoded", "whole_text"))
    rows = bpe.encode(docs, PATH, PATTERN, result="found").select("text", "found").collect()
    assert len(rows) == 2 * len(ODD)
    assert all(r.found == library.encode_ordinary(r.text or "") for r in rows)
    back = bpe.decode(bpe.encode(docs, PATH, PATTERN, result="found"), PATH, PATTERN, "found", "back").select("text", "back").collect()
    assert all(r.back == (r.text or "") for r in back)
    assert bpe.round_trip(docs, PATH, PATTERN, ["doc_id"]).count() == 2 * len(ODD)
    assert bpe.round_trip(docs.limit(0), PATH, PATTERN, ["doc_id"]).count() == 0
