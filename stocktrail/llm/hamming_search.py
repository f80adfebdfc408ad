"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktrail.runtime import materialize, written_rows

SEGMENT_BITS = 20  # widest segment
SHELL = 1000  # slots of one segment and radius up to which all segments are looked up at once


def sign_code(vector: Column, bits: int) -> Column:
    """Sign bits of a vector as an array of 64-bit words; null unless it has ``bits`` entries.

    A bit is set for an entry above zero (NaN counts as above); a null entry gives no bit.
    """
    words = [_word(vector, at, min(bits - at, 64)) for at in range(0, bits, 64)]
    return F.when(F.size(vector) == bits, F.array(*words))


def distance(a: Column, b: Column, words: int) -> Column:
    """Differing bits of two codes of the same number of words."""
    return sum((F.bit_count(a[w].bitwiseXOR(b[w])) for w in range(1, words)), F.bit_count(a[0].bitwiseXOR(b[0])))


def _word(vector: Column, at: int, size: int) -> Column:
    """Bits ``at`` to ``at + size`` as a number, the first one lowest: one fold from the last entry to the first."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    entries = F.reverse(F.slice(vector, at + 1, size))
    return F.aggregate(entries, none, lambda word, x: F.shiftleft(word, 1).bitwiseOR(F.when(x > 0, one).otherwise(none)))


def _segments(bits: int, codes: int) -> list[tuple[int, int, int]]:
    """(word, shift, width) of each segment; about log2 of the number of codes wide, none across words."""
    width = max(1, min(SEGMENT_BITS, round(log2(max(2, codes)))))
    out = []
    for at in range(0, bits, 64):
        size = min(64, bits - at)
        parts = ceil(size / width)
        edges = [size * i // parts for i in range(parts + 1)]
        out += [(at // 64, a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return out


def _value(code: Column, segment: tuple[int, int, int]) -> Column:
    word, shift, width = segment
    return F.shiftrightunsigned(code[word], shift).bitwiseAND(F.lit((1 << width) - 1))


def _steps(parts: list[tuple[int, int, int]]) -> Iterator[tuple[int, list[int], int]]:
    """Radius, segments to look up, and the distance within which every code has been met afterwards.

    The last step of a segment's whole width meets all codes. A step is several Spark jobs, so segments are
    taken one by one only where each has many slots at this radius.
    """
    for radius in range(max(width for _, _, width in parts) + 1):
        open_parts = [i for i, (_, _, width) in enumerate(parts) if radius <= width]
        small = all(comb(parts[i][2], radius) <= SHELL for i in open_parts)
        groups = [open_parts] if small else [[i] for i in open_parts]
        done = len(parts) - len(open_parts)
        for group in groups:
            done += len(group)
            whole = any(radius == parts[i][2] for i in group)
            yield radius, group, 1 << 30 if whole else len(parts) * radius + done - 1


def _shell(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in chosen) for chosen in combinations(range(width), radius)]


def _probes(number: int, segment: tuple[int, int, int], radius: int) -> Column:
    """Slots exactly ``radius`` bits from the query's value of one segment."""
    masks = F.lit(_shell(segment[2], radius)).cast("array<bigint>")
    value = _value(F.col("code"), segment)
    return F.transform(masks, lambda m: F.struct(F.lit(number).alias("segment"), value.bitwiseXOR(m).alias("value")))


def top_k(
    base: DataFrame, queries: DataFrame, k: int, bits: int, row_id: str = "vec_id", query_id: str = "query_id", code: str = "code"
) -> DataFrame:
    """query_id, rank, vec_id and distance of the ``k`` nearest rows of ``base`` to each query.

    Codes are arrays of 64-bit words with ``bits`` bits. Order is by distance, then id, nulls last;
    repeated rows count as often as they occur. Rows without a code are no neighbours and as
    queries have none; queries with the same id are one query if their codes are equal. With
    fewer than ``k`` rows all are returned. An empty side gives no rows; further columns are not used.

    Equal codes are searched as one. In round r each segment of a query is looked up with every
    value exactly r bits away, where these are many one segment after the other. Once j segments are looked up in
    round r, a code not met differs by r + 1 bits in these and by r in the others, so every code within
    segments x r + j - 1 bits has been met and verified by its whole distance. A query is finished once its
    k-th verified distance is within that radius; only the others go on.
    """
    words = ceil(bits / 64)
    rows = base.select(F.col(row_id).alias("vec_id"), F.col(code).alias("code")).where("code is not null")
    rows = materialize(rows)
    codes = materialize(rows.groupBy("code").agg(F.least(F.count("*"), F.lit(k)).alias("n")))
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(code).alias("code")).where("code is not null")
    active = materialize(asked.distinct())
    parts = _segments(bits, codes.count())
    table = materialize(
        codes.select(
            "code", "n",
            F.posexplode(F.array(*[_value(F.col("code"), s) for s in parts])).alias("segment", "value"),
        )
    )
    query = Window.partitionBy("query_id", "asked")
    nearer = query.orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
    done: list[DataFrame] = []
    kept: DataFrame | None = None
    for radius, numbers, covered in _steps(parts):
        slots = F.concat(*[_probes(i, parts[i], radius) for i in numbers])
        looked = active.select("query_id", F.col("code").alias("asked"), F.explode(slots).alias("p"))
        # Spark takes the exploded slots for as small as the queries and would broadcast them.
        probes = looked.select("query_id", "asked", "p.segment", "p.value")
        there = table.where(F.col("segment").isin(numbers))
        met = probes.hint("merge").join(there.hint("merge"), ["segment", "value"])
        met = met.select("query_id", "asked", "code", "n", distance(F.col("asked"), F.col("code"), words).alias("distance"))
        if kept is not None:
            met = met.unionByName(kept)
        met = met.distinct().withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
        near = met.where(F.col("before") < k)  # what may be among the k nearest, ties included
        within = F.sum(F.when(F.col("distance") <= covered, F.col("n")).otherwise(0)).over(query)
        state = materialize(near.withColumn("finished", F.lit(covered >= bits) | (within >= k)).drop("before"))
        done.append(state.where("finished").drop("finished"))
        if covered >= bits:
            break
        kept = state.where("not finished").drop("finished")
        over = state.where("finished").select("query_id", F.col("asked").alias("code")).distinct()
        active = materialize(active.join(over, [active.code == over.code, active.query_id.eqNullSafe(over.query_id)], "left_anti"))
        if not written_rows(active):
            break
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    of_code = Window.partitionBy("code").orderBy(F.col("vec_id").asc_nulls_last())
    nearest_ids = rows.withColumn("i", F.row_number().over(of_code)).where(F.col("i") <= k).drop("i")
    rank = F.row_number().over(query.orderBy("distance", F.col("vec_id").asc_nulls_last()))
    return (
        found.select("query_id", "asked", "code", "distance")
        .join(nearest_ids, "code")
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("distance").cast("int").alias("distance"))
    )


def top_k_signs(base: DataFrame, queries: DataFrame, k: int, row_id: str, query_id: str, vector: str) -> DataFrame:
    """`top_k` over the sign codes of vectors of any sizes: query_id, rank, vec_id and distance.

    Vectors of different sizes are compared over the entries both have, the first ones, so every
    vector is a neighbour of every query; one without entries is at distance 0. Null vectors are
    no neighbours and as queries have none.

    Every size has up to two searches over codes of as many bits: queries of that size among
    vectors at least as long, and longer queries among vectors of that size. The nearest of all
    are the nearest of each query's searches. With one size there is one search.
    """
    size = F.size(vector).alias("size")
    rows = base.select(F.col(row_id).alias("vec_id"), F.col(vector).alias("vector"), size).where(F.col(vector).isNotNull())
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("vector"), size).where(F.col(vector).isNotNull())
    of_rows = {r["size"] for r in rows.select("size").distinct().collect()}
    of_asked = {r["size"] for r in asked.select("size").distinct().collect()}
    longest = max(of_rows | of_asked, default=0)
    if len(of_rows | of_asked) > 1:
        # Queries with the same id may differ beyond the entries that a search compares.
        whole = F.coalesce(*[sign_code(F.col("vector"), n) for n in sorted(of_asked | {longest})])
        asked = asked.withColumn("query_id", F.struct("query_id", "size", whole.alias("whole")))

    def search(base: DataFrame, queries: DataFrame, bits: int) -> DataFrame:
        code = sign_code(F.slice("vector", 1, bits), bits) if bits else F.array(F.lit(0).cast("bigint"))
        return top_k(base.withColumn("code", code), queries.withColumn("code", code), k, max(bits, 1))

    if len(of_rows | of_asked) <= 1:
        return search(rows, asked, longest)
    found: DataFrame | None = None
    for bits in sorted(of_rows | of_asked):
        pairs = []
        if bits in of_asked and max(of_rows, default=-1) >= bits:
            pairs.append((rows.where(F.col("size") >= bits), asked.where(F.col("size") == bits)))
        if bits in of_rows and max(of_asked, default=-1) > bits:
            pairs.append((rows.where(F.col("size") == bits), asked.where(F.col("size") > bits)))
        for some_rows, some_asked in pairs:
            part = search(some_rows, some_asked, bits)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = search(rows, asked, longest)
    nearest = Window.partitionBy("query_id").orderBy("distance", F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
        .select("query_id.query_id", "rank", "vec_id", "distance")
    )
