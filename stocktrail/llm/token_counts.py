"""Token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from stocktrail.llm import tokenizer_files as tf
from stocktrail.llm.common import append_columns

CACHE = 150_000  # pieces a worker remembers in each of two generations


def count_word(bpe: tf.ByteBpe, word: bytes) -> int:
    """Tokens of one word: its bytes minus the merges made.

    Symbols form a linked list. The heap holds (rank, place) of adjacent pairs; an entry whose
    pair has changed meanwhile is stale and is dropped when it is popped.
    """
    n = len(word)
    if n == 1:
        return 1
    rank_of, merged = bpe.ranks.get, bpe.merged
    symbols = [bpe.byte_ids[b] for b in word]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    current = [rank_of(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
    current.append(-1)
    heap = [rank << 32 | i for i, rank in enumerate(current) if rank >= 0]
    heapify(heap)
    merges = 0
    while heap:
        entry = heappop(heap)
        rank, i = entry >> 32, entry & 0xFFFFFFFF
        if current[i] != rank:
            continue
        merges += 1
        gone = after[i]
        symbols[i] = merged[rank]
        current[gone] = -1
        right = after[i] = after[gone]
        current[i] = -1
        if right < n:
            before[right] = i
            new = rank_of(symbols[i] << 32 | symbols[right], -1)
            current[i] = new
            if new >= 0:
                heappush(heap, new << 32 | i)
        left = before[i]
        if left >= 0:
            new = rank_of(symbols[left] << 32 | symbols[i], -1)
            if new != current[left]:
                current[left] = new
                if new >= 0:
                    heappush(heap, new << 32 | left)
    return n - merges


def counter(bpe: tf.ByteBpe):
    """A function from a text to its number of tokens."""
    cache = tf.PieceCache(lambda word: count_word(bpe, word), 0, CACHE)

    def count(text: str) -> int:
        total = 0
        for k, section in enumerate(tf.sections(bpe, text)):
            if k % 2:
                total += 1
            elif section:
                total += sum(map(cache.__getitem__, tf.pieces(section)))
        return total

    return count


_COUNTERS: dict[int, object] = {}


def _ready(shared):
    """This worker's counter, kept from task to task with the pieces it has seen."""
    content = shared.value
    key = hash(content)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = counter(tf.parse(content))
    return _COUNTERS[key]


def count_tokens(df: DataFrame, text: str, vocabulary: str, limit: int = 1024, drop=()) -> DataFrame:
    """Add n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    ``vocabulary`` is the path of a byte-level BPE file on the driver. Null counts as the empty
    text: zero bytes and tokens. Repeated rows are all kept; columns that already have one of the
    three names are replaced, other columns pass through; an empty table gives an empty table.
    """
    shared = tf.share(df.sparkSession, vocabulary)

    def start():
        count = _ready(shared)

        def work(texts: list[str | None]) -> list[list]:
            tokens = [count(t or "") for t in texts]
            return [[len((t or "").encode()) for t in texts], tokens, [n > limit for n in tokens]]

        return work

    return append_columns(df, [text], "n_bytes bigint, n_tokens bigint, over_limit boolean", start, drop)
