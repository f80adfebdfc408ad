"""Byte-pair codec and token counts against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stocktrail.llm import bpe_codec, token_counts, tokenizer_files
from stocktrail.llm.queries import QUERIES, VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, "rb") as file:
        return tokenizer_files.parse(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(3)
    pool = [chr(c) for c in range(0x250)] + list("͸՘Ᲊ㎰ 　\u0085\xa0​😀̀一") + [chr(0x323B0), chr(0x11DE0)]
    pool += ["  ", " ", "\n", "\t", "'s", "'ll", "<|endoftext|>", "<|end", "a", "the", "123", " word"] * 10
    made = ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(1500)]
    return [*made, "", " ", "\n\n", "<|endoftext|>", "a" * 5000, "".join(rng.choices("abcdef", k=20_000)), " " * 3000]


def test_same_ids_as_the_library(bpe, library):
    encode, count = bpe_codec.encoder(bpe), token_counts.counter(bpe)
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        packed = encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(text[:80])
        assert count(text) == len(ids)
        assert bpe_codec.decode(bpe, packed) == library.decode(ids, skip_special_tokens=False) == text


def test_every_character_is_cut_alike(library):
    cut = library.pre_tokenizer.pre_tokenize_str
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}1{chr(c)} {chr(c)}!"
            assert [text[a:b] for _, (a, b) in cut(text)] == tokenizer_files.words(text), hex(c)


def test_pieces_are_cut_where_words_begin():
    for text in texts():
        pieces = tokenizer_files.pieces(text)
        assert "".join(pieces) == text
        assert [w for p in pieces for w in tokenizer_files.words(p)] == tokenizer_files.words(text)


def test_long_words_in_blocks_give_the_same(bpe, monkeypatch):
    word = "".join(random.Random(5).choices("abcdefgh", k=700)).encode()
    blocked = bpe_codec.encode_word(bpe, word)
    monkeypatch.setattr(bpe_codec, "LONG_WORD", 10_000)
    assert bpe_codec.encode_word(bpe, word) == blocked


def test_cache_is_bounded(bpe):
    cache = tokenizer_files.PieceCache(lambda w: token_counts.count_word(bpe, w), 0, 3)
    assert [cache[p] for p in ("one", " two", " three", " four", "one, two")] == [1, 1, 1, 1, 3]
    assert len(cache) <= 3 and len(cache.older) <= 3
    assert cache[" two"] == cache["one, two three"] - 3 == 1


def test_queries_agree_with_the_library(spark, folder, documents, library):
    codec = {r["doc_id"]: r for r in QUERIES["op3_bpe_codec"](spark, folder).collect()}
    counts = {r["doc_id"]: r for r in QUERIES["op6_token_counts"](spark, folder).collect()}
    assert codec.keys() == counts.keys() == documents.keys()
    for doc_id, text in documents.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec[doc_id]["n_tokens"] == counts[doc_id]["n_tokens"] == len(ids)
        assert codec[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert codec[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert counts[doc_id]["n_bytes"] == len(text.encode())
        assert counts[doc_id]["over_limit"] == (len(ids) > 1024)


def test_odd_rows(spark, odd_rows):
    clash = odd_rows.withColumnRenamed("extra", "N_TOKENS")
    rows = token_counts.count_tokens(clash, "text", PATH).collect()
    assert len(rows) == 7 and rows[0]["n_tokens"] == rows[1]["n_tokens"] == 7
    assert [r["n_tokens"] for r in rows if not r["text"]] == [0, 0, 0]
    encoded = bpe_codec.encode_texts(odd_rows.withColumnRenamed("extra", "ids"), "text", PATH)
    back = bpe_codec.decode_ids(encoded, "ids", PATH).collect()
    assert [r["decoded"] for r in back] == [r["text"] or "" for r in back]
    assert "N_TOKENS" not in rows[0] and encoded.columns == ["doc_id", "text", "ids"]
    assert bpe_codec.round_trip_digests(odd_rows.limit(0), "text", PATH).count() == 0
    assert token_counts.count_tokens(odd_rows.limit(0), "text", PATH).count() == 0
    assert bpe_codec.decode_ids(spark.createDataFrame([(None,)], "ids array<int>"), "ids", PATH).first()["decoded"] == ""
