"""Byte-pair encoding and decoding with a contiguous rank array."""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stocktrail.llm import tokenizer_files as tf
from stocktrail.llm.common import append_columns

CACHE = 150_000  # pieces a worker remembers in each of two generations
LONG_WORD = 400  # parts from which the rank array is kept in blocks
BLOCK = 512
_NONE = 1 << 40  # rank of a pair that does not merge


def encode_word(bpe: tf.ByteBpe, word: bytes) -> list[int]:
    """Ids of one word.

    ``parts`` are the parts between boundaries, ``ranks[i]`` is the rank of parts i and i + 1 in
    one contiguous array. The leftmost lowest rank is found by scanning, its boundary is deleted
    and the two neighbouring ranks are looked up again.
    """
    parts = [bpe.byte_ids[b] for b in word]
    rank_of, merged = bpe.ranks.get, bpe.merged
    if len(parts) > LONG_WORD:
        return _encode_long(bpe, parts)
    ranks = [rank_of(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
    while ranks:
        low = min(ranks)
        if low == _NONE:
            break
        i = ranks.index(low)
        parts[i] = merged[low]
        del parts[i + 1], ranks[i]
        if i:
            ranks[i - 1] = rank_of(parts[i - 1] << 32 | parts[i], _NONE)
        if i < len(ranks):
            ranks[i] = rank_of(parts[i] << 32 | parts[i + 1], _NONE)
    return parts


def _encode_long(bpe: tf.ByteBpe, parts: list[int]) -> list[int]:
    """The same for a long word: the array stays in place, in blocks whose minima are kept.

    A scan reads the block minima and one block instead of the whole array, and a deleted
    boundary is skipped by its neighbours instead of moving what follows.
    """
    n = len(parts)
    rank_of = bpe.ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = np.full(-(-n // BLOCK) * BLOCK, _NONE, np.int64)
    ranks[: n - 1] = [rank_of(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
    blocks = ranks.reshape(-1, BLOCK)
    lows = blocks.min(1)

    def refresh(i: int) -> None:
        right = after[i]
        ranks[i] = rank_of(parts[i] << 32 | parts[right], _NONE) if right < n else _NONE

    while True:
        block = int(lows.argmin())
        low = int(lows[block])
        if low == _NONE:
            break
        i = block * BLOCK + int(blocks[block].argmin())
        gone = after[i]
        parts[i] = bpe.merged[low]
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        ranks[gone] = _NONE
        refresh(i)
        changed = {block, gone // BLOCK}
        if before[i] >= 0:
            refresh(before[i])
            changed.add(before[i] // BLOCK)
        for b in changed:
            lows[b] = blocks[b].min()
    out, i = [], 0
    while i < n:
        out.append(parts[i])
        i = after[i]
    return out


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(bpe: tf.ByteBpe):
    """A function from a text to its ids as little-endian unsigned 32-bit integers."""

    cache = tf.PieceCache(lambda word: _packed(encode_word(bpe, word)), b"", CACHE)

    def encode(text: str) -> bytes:
        out = []
        for k, section in enumerate(tf.sections(bpe, text)):
            if k % 2:
                out.append(_packed([bpe.special[section]]))
            elif section:
                out.extend(map(cache.__getitem__, tf.pieces(section)))
        return b"".join(out)

    return encode


def decode(bpe: tf.ByteBpe, ids: bytes) -> str:
    """Text of packed ids; bytes that are not UTF-8 become the replacement character."""
    tokens = bpe.tokens
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_ENCODERS: dict[int, tuple] = {}


def _ready(shared) -> tuple:
    """Vocabulary and encoder of this worker, kept from task to task with the pieces it has seen."""
    content = shared.value
    key = hash(content)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        bpe = tf.parse(content)
        _ENCODERS[key] = bpe, encoder(bpe)
    return _ENCODERS[key]


def _lists(packed: list[bytes]) -> pa.Array:
    """Packed ids of each row as one Arrow list column."""
    ends = np.cumsum([0, *(len(ids) // 4 for ids in packed)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def encode_texts(df: DataFrame, text: str, vocabulary: str, ids: str = "ids", drop=()) -> DataFrame:
    """Add column ``ids``: array of token ids of each whole text.

    ``vocabulary`` is the path of a byte-level BPE file on the driver. Null and empty texts give
    an empty array; repeated rows are encoded alike and all kept; an existing column named
    ``ids`` is replaced, other columns pass through; an empty table gives an empty table.
    """
    shared = tf.share(df.sparkSession, vocabulary)

    def start():
        _, encode = _ready(shared)
        return lambda texts: [_lists([encode(t or "") for t in texts])]

    return append_columns(df, [text], f"`{ids}` array<int>", start, drop)


def decode_ids(df: DataFrame, ids: str, vocabulary: str, text: str = "decoded", drop=()) -> DataFrame:
    """Add column ``text`` decoded from an array of ids; a null array gives the empty text."""
    shared = tf.share(df.sparkSession, vocabulary)

    def start():
        bpe, _ = _ready(shared)
        return lambda rows: [[decode(bpe, np.array(r or [], "<u4").tobytes()) for r in rows]]

    return append_columns(df, [ids], f"`{text}` string", start, drop)


def round_trip_digests(df: DataFrame, text: str, vocabulary: str, ids: str | None = None, drop=()) -> DataFrame:
    """Encode each text, decode its ids, and add n_tokens, ids_sha256 and decoded_sha256.

    One pass; the ids leave the worker only if a column name for them is given. Rows are treated
    as in `encode_texts`; of columns that are already named like the new ones, the new ones stay.
    """
    shared = tf.share(df.sparkSession, vocabulary)

    def start():
        bpe, encode = _ready(shared)

        def work(texts: list[str | None]) -> list:
            packed = [encode(t or "") for t in texts]
            columns = [
                [len(p) // 4 for p in packed],
                [hashlib.sha256(p).hexdigest() for p in packed],
                [hashlib.sha256(decode(bpe, p).encode()).hexdigest() for p in packed],
            ]
            return [*columns, _lists(packed)] if ids else columns

        return work

    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return append_columns(df, [text], fields + (f", `{ids}` array<int>" if ids else ""), start, drop)
