"""Benchmark decontamination with one Aho-Corasick automaton over the words of the benchmark."""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktrail.llm.common import append_columns
from stocktrail.runtime import materialize

WINDOW = 10  # words
AUTOMATON_BYTES = 4 << 20  # benchmark text and ids one automaton is built over; more takes more scans
ANY_WORD = r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]"
FIELDS = "n_words bigint, hits array<struct<first:bigint,last:bigint>>, item_ids array<string>"

# Words are runs of digits, letters a-z and characters beyond ASCII, after A-Z is lower-cased.
_TO_WORDS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


def word_spans(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character span (end exclusive) in the original text of each (first, last) range of words."""
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[a][0], places[b][1]) for a, b in words]


class Windows:
    """The automaton: windows of every item as sequences of word numbers."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item_id, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            for at in range(max(1, len(words) - window + 1)) if words else ():
                owner = owners[tuple(words[at : at + window])]
                if item_id is not None:
                    owner.add(item_id)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, ids in owners.items():
            self.machine.add_word(words, (len(words), tuple(sorted(ids))))
        self.any = bool(owners)
        if self.any:
            self.machine.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged (first, last) word ranges of all windows that occur, and the items they are of."""
        if not self.any or not words:
            return [], set()
        number = self.numbers.get
        found, items = [], set()
        for last, (length, ids) in self.machine.iter(tuple([number(w, 0) for w in words])):
            found.append((last - length + 1, last))
            items.update(ids)
        return merge(found), items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(last, out[-1][1])
        else:
            out.append((first, last))
    return out


@lru_cache(maxsize=1)
def _machine(content: bytes, window: int) -> Windows:
    table = pa.ipc.open_stream(content).read_all()
    return Windows(list(zip(*[c.to_pylist() for c in table.columns], strict=True)), window)


def _packed(items: list) -> bytes:
    batch = pa.record_batch({"id": pa.array([r[0] for r in items], pa.string()), "text": pa.array([r[1] for r in items], pa.string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def find_contamination(
    df: DataFrame,
    text: str,
    benchmark: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
    drop=(),
) -> DataFrame:
    """Add n_words, hits, item_ids and spans for the benchmark windows that occur in each text.

    ``hits`` are merged (first, last) word ranges, ``spans`` the same as character ranges of the
    original text (end exclusive), ``item_ids`` the sorted distinct ids, as text, of items of which
    a window occurs. An item of fewer than ``window`` words is one window; null, empty or
    wordless items have none. Items with a null id mark words but are not listed. Null and empty
    texts have no words. Repeated rows and items change nothing; columns named like the new ones
    are replaced, others pass through; an empty benchmark hits nothing.

    The texts are scanned once, without a shuffle, while the benchmark fits ``automaton_bytes``.
    The benchmark's distinct items that have words are measured, text and id, before they are broadcast; a larger one
    is cut by a hash of text and id into parts that fit, each scanned with an automaton of its own. So
    a text under very many ids is spread over parts as well.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
    items = items.where(F.col("t").rlike(ANY_WORD)).distinct()
    size = items.agg(F.sum(F.octet_length("t") + F.coalesce(F.octet_length("i"), F.lit(0)) + 16)).first()[0] or 0
    shares = -(-size // automaton_bytes) or 1
    kept = [c for c in df.columns if c.lower() not in {"n_words", "hits", "item_ids", "spans"}]
    df = df.select(*kept, F.lit(None).cast("array<struct<first:bigint,last:bigint>>").alias("hits"),
                   F.lit(None).cast("array<string>").alias("item_ids"))
    for share in range(shares):
        part = items.where(F.pmod(F.xxhash64("t", "i"), F.lit(shares)) == share) if shares > 1 else items
        content = df.sparkSession.sparkContext.broadcast(_packed(part.collect()))

        def start(content=content):
            machine = _machine(content.value, window)

            def work(texts, before, ids_before):
                counts, hits, ids, spans = [], [], [], []
                for t, ranges, names in zip(texts, before, ids_before, strict=True):
                    words = words_of(t)
                    found, items_found = machine.scan(words)
                    if ranges:
                        found = merge([*found, *((r["first"], r["last"]) for r in ranges)])
                    counts.append(len(words))
                    hits.append([{"first": a, "last": b} for a, b in found])
                    ids.append(sorted(items_found.union(names or ())))
                    spans.append([{"start": a, "end": b} for a, b in word_spans(t, found)] if found else [])
                return [counts, hits, ids, spans]

            return work

        last = share == shares - 1
        df = append_columns(
            df, [text, "hits", "item_ids"], FIELDS + ", spans array<struct<start:bigint,end:bigint>>", start, drop if last else ()
        )
        if not last:
            df = materialize(df)
    return df


def hit_words() -> F.Column:
    """Number of words inside any occurrence, from the merged ranges."""
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1)
