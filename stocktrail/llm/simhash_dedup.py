"""SimHash near-duplicate classes by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktrail.llm.common import append_columns
from stocktrail.runtime import materialize

BITS = 64
CHUNK = 1 << 16  # shingles hashed at a time, whatever the length of the text
RUN_ROWS = 4096  # rows of one table slot compared directly; larger slots go by midpoints
WIDE_INDEX = 1 << 27  # fingerprints from which two segments are used instead of three


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of a text, as a signed 64-bit integer.

    Shingles of ``words`` words, repeats included, are hashed by XXH64; a bit is set if it is set
    in more than half of the hashes. A text of fewer words is one shingle; without words it is 0.
    """
    tokens = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    count = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, CHUNK):
        part = tokens[at : min(at + CHUNK, count) + words - 1]
        columns = [part[k:] for k in range(min(words, len(part)))]
        hashes = b"".join([digest(b" ".join(s), seed) for s in zip(*columns, strict=False)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count).view(">i8")[0])


def fingerprints(df: DataFrame, text: str, words: int = 4, seed: int = 42, drop=()) -> DataFrame:
    """Add column ``fp`` (bigint); null and empty texts get 0; an existing ``fp`` is replaced."""
    return append_columns(
        df, [text], "fp bigint", lambda: lambda texts: [[fingerprint(t, words, seed) for t in texts]], drop
    )


def segments(count: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment of a fingerprint."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def table_slots(fp: Column, distance: int, parts: int) -> Column:
    """Slots of the segment tables in which a fingerprint stands or looks, as an array of keys.

    With ``distance = parts * r + a``, two fingerprints within the distance agree up to r bits in
    one of the first a + 1 segments or up to r - 1 bits in one of the others. Each stands at its
    own segment value. The ball around it is enumerated upwards only, over values that have one or
    more bits besides: of two values one bit apart one looks where the other stands, of two values
    further apart both look at the value that joins their bits.
    """
    radius, extra = divmod(distance, parts)
    slots = []
    for k, (shift, width) in enumerate(segments(parts)):
        reach = radius if k <= extra else radius - 1
        if reach < 0:
            continue
        value = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
        tag = k << 40
        slots.append(value + F.lit(tag))
        ball = [1 << i for i in range(width)] if reach else []
        if reach >= 2:
            ball += [1 << i | 1 << j for i in range(width) for j in range(i)]
        if reach >= 3:
            raise ValueError("more segments are needed for this distance")
        for mask in ball:
            free = value.bitwiseAND(F.lit(mask)) == 0
            slots.append(F.when(free, value + F.lit(mask + tag)))
    return F.array_compact(F.array(*slots))


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of a signed number it would take the absolute value


def _forest(fps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join the fingerprints of one slot as their verified distances do."""
    edges, rest = [], fps
    while rest.size > 1:
        root, rest = rest[0], rest[1:]
        front = np.array([root])
        while front.size and rest.size:
            near = np.zeros(rest.size, bool)
            for at in range(0, front.size, 64):
                near |= (_differing(front[at : at + 64, None], rest) <= distance).any(0)
            front, rest = rest[near], rest[~near]
            edges.append((np.full(front.size, root), front))
    return edges


def _pairs(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within runs of equal keys; a long run gives links that span its classes."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, keys.size])
    found = []
    for at in np.flatnonzero(sizes > 16):
        found += _forest(fps[starts[at] : starts[at] + sizes[at]], distance)
    small = np.repeat(sizes <= 16, sizes)
    keys, fps = keys[small], fps[small]
    for step in range(1, 16):
        same = np.flatnonzero(keys[step:] == keys[:-step])
        if not same.size:
            break
        a, b = fps[same], fps[same + step]
        close = _differing(a, b) <= distance
        found.append((a[close], b[close]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _match_slots(distance: int, most: int):
    """Over rows (slot, fp) sorted by slot: links as (a, b); rows of larger slots as (fp, null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        held = np.empty(0, np.int64), np.empty(0, np.int64)
        over = None  # slot whose rows are passed on
        for batch in batches:
            keys = np.concatenate([held[0], batch.column(0).to_numpy()])
            fps = np.concatenate([held[1], batch.column(1).to_numpy()])
            if not keys.size:
                continue
            last = np.searchsorted(keys, keys[-1])  # its run may go on in the next batch
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[starts, keys.size])
            large = np.repeat((sizes > most) | (keys[starts] == over), sizes)
            over = keys[-1] if large[-1] else None
            if large.any():
                passed = fps[large]
                yield out(passed, pa.nulls(passed.size, pa.int64()))
            now = ~large
            now[last:] = False
            yield out(*_pairs(keys[now], fps[now], distance)) if now.any() else out([], [])
            held = (keys[last:], fps[last:]) if over is None else (keys[:0], fps[:0])
        if held[0].size:
            yield out(*_pairs(*held, distance))

    return run


def _by_midpoints(fps: DataFrame, distance: int) -> DataFrame:
    """Links among fingerprints that crowd in one slot, linear in their number.

    Two fingerprints are within 2 r bits if and only if some value is within r bits of both, so
    all that share such a midpoint are linked to the least of them, without making pairs.
    """
    if distance % 2:
        # One step less on one side: odd distances are met by midpoints and their own values.
        near, far = distance // 2, distance // 2 + 1
        return _star(fps, near, far, distance)
    return _star(fps, distance // 2, distance // 2, distance)


def _ball(fp: Column, radius: int) -> Column:
    values = F.array(fp)
    for _ in range(radius):
        values = F.array_distinct(
            F.flatten(
                F.transform(
                    values,
                    lambda v: F.concat(
                        F.array(v), F.array(*[v.bitwiseXOR(F.lit((1 << i) - (1 << 64 if i == 63 else 0))) for i in range(BITS)])
                    ),
                )
            )
        )
    return values


def _star(fps: DataFrame, near: int, far: int, distance: int) -> DataFrame:
    mids = fps.select("fp", F.explode(_ball(F.col("fp"), near)).alias("mid"))
    least = mids.groupBy("mid").agg(F.min("fp").alias("a"))
    if near == far:
        joined = mids.hint("merge").join(least.hint("merge"), "mid")  # far more rows than Spark expects
        return joined.where("a < fp").select("a", F.col("fp").alias("b"))
    wide = fps.select(F.col("fp").alias("b"), F.explode(_ball(F.col("fp"), far)).alias("mid"))
    joined = wide.hint("merge").join(least.hint("merge"), "mid")
    return joined.where((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance) & (F.col("a") != F.col("b"))).select(
        "a", "b"
    )


def links(nodes: DataFrame, distance: int = 4, run_rows: int = RUN_ROWS, parts: int | None = None) -> DataFrame:
    """Links (a, b) whose connected parts are those of all pairs of ``fp`` within ``distance``.

    ``nodes`` has distinct, non-null fingerprints. Every pair that the segment tables bring
    together is verified by its complete distance. Slots of up to ``run_rows`` rows are compared
    in place and give spanning links; the rows of a larger slot are linked by `_by_midpoints`.
    """
    if parts is None:
        parts = 2 if nodes.count() > WIDE_INDEX and distance // 2 <= 2 else max(3, distance // 3 + 1)
    entries = nodes.select(F.explode(table_slots(F.col("fp"), distance, parts)).alias("slot"), "fp")
    entries = entries.repartition("slot").sortWithinPartitions("slot", "fp")
    found = materialize(entries.mapInArrow(_match_slots(distance, run_rows), "a bigint, b bigint"))
    close = found.where("b is not null")
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    if not found.where("b is null").isEmpty():
        close = close.unionByName(_by_midpoints(crowded, distance))
    return close


def connect(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable from each node that has a link; roots are left out.

    Alternates two star steps until nothing changes: every node is tied to the least of its
    larger neighbourhood, then of its smaller one. Each step is one aggregate and one join; the
    aggregate is a written table, so that the join's other side is shuffled by itself and AQE can split the
    edges of one node.
    """
    edges = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        small_least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (
            large.join(small_least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = materialize(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def fingerprint_rows(df: DataFrame, doc_id: str, text: str, words: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and fp of every row, written once so that texts are read and hashed a single time."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    return materialize(fingerprints(rows, "__text", words, seed, drop=["__text"]))


def classes(rows: DataFrame, distance: int = 4, run_rows: int = RUN_ROWS) -> DataFrame:
    """fp, root and component_id of each distinct fingerprint of (doc_id, fp) rows.

    root is the least fingerprint of the class as a signed number, component_id its least id.
    Rows with equal fingerprints are one node, so copies cost nothing beyond one aggregate.
    """
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = connect(links(nodes.select("fp"), distance, run_rows))
    nodes = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    nodes = materialize(nodes)
    least = materialize(nodes.groupBy("root").agg(F.min("first").alias("component_id")))  # so AQE can split a class
    return materialize(nodes.join(least, "root").select("fp", "root", "component_id"))


def near_duplicate_classes(
    df: DataFrame, doc_id: str, text: str, distance: int = 4, words: int = 4, seed: int = 42, run_rows: int = RUN_ROWS
) -> DataFrame:
    """doc_id, fp and component_id of every row of ``df``.

    Rows are linked if their fingerprints differ in at most ``distance`` bits; component_id is
    the least id reachable over links, the row's own included. Null and empty texts have
    fingerprint 0 and are linked like others. A row without an id gets its class's least id, null
    if no row of the class has one. Repeated rows are all returned; further columns of ``df``
    are not; an empty table gives an empty table.
    """
    rows = fingerprint_rows(df, doc_id, text, words, seed)
    return rows.join(classes(rows, distance, run_rows), "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, doc_id: str, text: str, distance: int = 4) -> DataFrame:
    """Rows of ``df`` with one row of each near-duplicate class: that of the least id.

    Rows without an id come after all others; of repeated rows with the same id one stays. All
    columns of ``df`` pass through.
    """
    rows = fingerprint_rows(df, doc_id, text)
    of_class = rows.join(classes(rows, distance).select("fp", "root"), "fp")
    first = of_class.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("w"))
    winners = first.select(F.col("w.doc_id").alias("__id"), F.col("w.fp").alias("__wfp"))
    packed = df.select(F.struct("*").alias("__row"), F.col(doc_id).alias("__doc"), F.col(text).alias("__text"))
    marked = fingerprints(packed, "__text", drop=["__text"])
    kept = marked.join(winners, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("fp") == F.col("__wfp")))
    rank = F.row_number().over(Window.partitionBy("__id", "__wfp").orderBy(F.col("__row").getField(text)))
    return kept.withColumn("__n", rank).where("__n = 1").select("__row.*")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
