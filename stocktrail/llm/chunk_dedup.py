"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktrail.llm.common import append_columns
from stocktrail.runtime import materialize

REACH = 16  # a cut is where the hash is largest among so many bytes to either side
HASH_BITS = 16  # of the rolling hash, which so many bytes decide
LONGEST = 1024  # bytes of a chunk at most
MIN_BYTES = 64  # bytes of equal chunks in a repeated passage, which is some 50 to 80 bytes longer itself
SPAN = 2048  # a chunk's place in one number: start x SPAN + size
CHUNK_TYPE = "doc_id bigint, text_hash bigint, span bigint, digest binary"

# Random number of each byte.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 42) % (1 << HASH_BITS) for b in range(256)], np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash h[i] = 2 h[i-1] + GEAR[byte i] in 16 bits at every byte, by doubling the window."""
    h = GEAR[data]
    width = 1
    while width < HASH_BITS:
        h[width:] += h[:-width].copy() << np.uint16(width)
        width *= 2
    return h


def _largest_before(h: np.ndarray, reach: int) -> np.ndarray:
    """Largest of the ``reach`` values before each place, by doubling."""
    best, width = h.copy(), 1
    while width * 2 <= reach:
        best[width:] = np.maximum(best[width:], best[:-width].copy())
        width *= 2
    rest = reach - width
    if rest:
        best[rest:] = np.maximum(best[rest:], best[:-rest].copy())
    out = np.zeros_like(h)
    out[1:] = best[:-1]
    return out


def cuts(data: bytes, reach: int = REACH, longest: int = LONGEST) -> list[int]:
    """Ends of the chunks of ``data``.

    A chunk ends after a byte whose rolling hash is above those of the ``reach`` bytes before and
    not below those of the ``reach`` bytes after. So a cut depends on its surroundings alone, an
    insertion moves only the cuts around it, and chunks are longer than ``reach``. A chunk that
    would be over ``longest`` is cut there, counted from its start.
    """
    if not data:
        return []
    h = gear_hashes(np.frombuffer(data, np.uint8))
    after = _largest_before(h[::-1], reach)[::-1]
    peaks = np.flatnonzero((h > _largest_before(h, reach)) & (h >= after)) + 1
    ends = np.unique(np.append(peaks[peaks > min(reach, len(data) - 1)], len(data)))
    gaps = np.diff(ends, prepend=0)
    if gaps.max() <= longest:
        return ends.tolist()
    out: list[int] = []
    start = 0
    for end in ends.tolist():
        out += [*range(start + longest, end, longest), end]
        start = end
    return out


def chunks(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_hash, span (start and size in bytes) and digest of every chunk of every text."""
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (value or "").encode()
                ends = cuts(data)
                starts = [0, *ends[:-1]]
                n = len(ends) if data else 0
                whole = xxhash.xxh3_64_intdigest(data) - (1 << 63)
                made = (
                    [doc] * n, [whole] * n,
                    [a * SPAN + b - a for a, b in zip(starts, ends, strict=False)],
                    [digest(data[a:b]) for a, b in zip(starts, ends, strict=False)],
                )
                for column, more in zip(columns, made, strict=True):
                    column.extend(more)
                if len(columns[0]) >= 50_000:
                    yield _chunk_batch(columns)
                    columns = [[], [], [], []]
            yield _chunk_batch(columns)

    return rows.mapInArrow(run, CHUNK_TYPE)


def _chunk_batch(columns: list[list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "text_hash", "span", "digest"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def repeated_passages(df: DataFrame, doc_id: str, text: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Passages that occur more than once: doc_id, text_hash, start, end, n_chunks, first_here, first_doc_id.

    A passage is a run of neighbouring chunks whose digests occur at more than one place, all of
    them for the first time (``first_here``) or all of them earlier elsewhere, and together with
    the repeated chunks next to it has at least ``min_bytes`` bytes. Places are ordered by document id (null
    last), text and position; start and end are bytes of the UTF-8 text. first_doc_id is the
    document where the passage's first chunk occurs first.

    Rows with the same id and text are one document. Null and empty texts have no passage; an
    empty table gives no rows; further columns are not used.

    Texts are cut without a shuffle. Digests are counted with partial sums, so a chunk of a third
    of all documents is one row per task; the repeated ones are a written table, so the join that follows
    shuffles both sides for itself and AQE can split such a chunk.
    """
    found = chunks(df, doc_id, text)
    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "span")
    spread = found.groupBy("digest").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    repeated = materialize(spread.where("first <> last").select("digest", "first"))
    marked = found.join(repeated, "digest").select(
        "doc_id", "text_hash", "span", (here == F.col("first")).alias("first_here"),
        F.col("first.doc_id").alias("first_doc_id"),
    )
    start = F.floor(F.col("span") / SPAN).cast("bigint")
    placed = marked.distinct().select("*", start.alias("start"), (start + F.col("span") % SPAN).alias("end"))
    in_order = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    apart = F.coalesce(F.lag("end").over(in_order) != F.col("start"), F.lit(True))
    turned = F.lag("first_here").over(in_order) != F.col("first_here")
    edges = placed.select("*", apart.alias("apart"), (apart | turned).cast("int").alias("turned"))
    numbered = edges.select(
        "*", F.sum(F.col("apart").cast("int")).over(in_order).alias("island"), F.sum("turned").over(in_order).alias("part")
    )
    length = F.sum(F.col("end") - F.col("start")).over(Window.partitionBy("doc_id", "text_hash", "island"))
    return (
        numbered.withColumn("length", length)
        .where(F.col("length") >= min_bytes)
        .groupBy("doc_id", "text_hash", "part", "first_here")
        .agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_chunks"),
            F.min_by("first_doc_id", "start").alias("first_doc_id"),
        )
        .select("doc_id", "text_hash", "start", "end", "n_chunks", "first_here", "first_doc_id")
    )


def remove_repeats(df: DataFrame, doc_id: str, text: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``df`` with every passage removed from ``text`` that occurs earlier elsewhere.

    Cuts that fall inside a character move to its end. Rows and other columns stay as they are.
    """
    later = repeated_passages(df, doc_id, text, min_bytes).where("not first_here")
    spans = materialize(
        later.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    )
    packed = df.select(F.struct("*").alias("__row"), F.col(doc_id).cast("bigint").alias("__doc"), F.col(text).alias("__text"))

    def hashed():
        return lambda texts: [[xxhash.xxh3_64_intdigest((t or "").encode()) - (1 << 63) for t in texts]]

    def cut():
        return lambda texts, rows: [[_without(t, r) for t, r in zip(texts, rows, strict=True)]]

    marked = append_columns(packed, ["__text"], "__hash bigint", hashed)
    joined = marked.join(
        spans, marked["__doc"].eqNullSafe(spans["doc_id"]) & (marked["__hash"] == spans["text_hash"]), "left"
    ).select("__row", "__text", "__spans")
    out = append_columns(joined, ["__text", "__spans"], "__text string", cut)
    return out.select(
        *[(F.col("__text") if c == text else F.col("__row").getField(c)).alias(c) for c in df.columns]
    )


def _without(text: str | None, spans: list[dict] | None) -> str | None:
    if text is None or not spans:
        return text
    data, out, at = text.encode(), [], 0

    def whole(place: int) -> int:
        while place < len(data) and data[place] & 0xC0 == 0x80:
            place += 1
        return place

    for span in sorted(spans, key=lambda s: s["start"]):
        out.append(data[at : whole(span["start"])])
        at = whole(span["end"])
    return b"".join([*out, data[at:]]).decode()
