"""Mixing sources to target weights by cube-method balanced sampling of whole documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktrail.llm.common import append_columns
from stocktrail.operators.windows import number_rows
from stocktrail.runtime import materialize

BUCKET = 1024  # documents of one flight
FAN = 256  # flights whose open documents meet in the next one
HELD = 12  # open documents that are kept for the landing
COPIES = 10_000  # equal rows given out by one task at a time
LONG = 8  # mean sizes from which a document counts as very long
NEAR = 1e-9  # probabilities so close to 0 or 1 count as decided


def count_words(df: DataFrame, text: str, name: str = "size", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the number of runs of characters other than space and U+0009 to U+000D; null has none."""

    def start():
        # bytes.split() parts at exactly these six characters; one text is in memory at a time.
        return lambda texts: [[len(t.encode().split()) if t else 0 for t in texts]]

    return append_columns(df, [text], f"{name} bigint", start, drop)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Add ``place`` (from 1), ``target`` and ``rate`` (copies of each word) to one row per source.

    Sources in order of their code points, null last, get the weights in turn and share the sum of
    all sizes. A target stops at ``cap`` times the source's size; what is over is shared again by
    weight among the others until none is above. Every round is one aggregate over the sources.
    """
    placed = number_rows(sizes, [F.col("source").asc_nulls_last()], "place", distinct_order=True)
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1
    placed = materialize(placed.withColumn("weight", F.element_at(F.lit(list(weights)), turn.cast("int"))))
    exact = "decimal(38,0)"
    first = placed.agg(F.sum(F.col("source_size").cast(exact)).alias("words"), F.sum("weight").alias("weight")).first()
    words, weight, full = int(first["words"] or 0), int(first["weight"] or 0), -1
    share, capped = words, 0
    while True:
        over = F.col("weight").cast("decimal(10,0)") * _exact(share) > F.col("source_size").cast("decimal(19,0)") * _exact(cap * max(weight, 1))
        row = placed.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.sum(F.when(over, F.col("source_size").cast(exact))).alias("words"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == full:
            break
        full, capped, weight = row["n"], int(row["words"] or 0), int(row["weight"] or 0)
        share = words - cap * capped
    level = F.col("weight") * F.lit(float(share)) / F.lit(float(max(weight, 1)))
    target = F.when(over, F.col("source_size") * F.lit(float(cap))).otherwise(level)
    rate = F.when(F.col("source_size") == 0, 0.0).when(over, F.lit(float(cap))).otherwise(target / F.col("source_size"))
    return placed.withColumn("target", target).withColumn("rate", rate)


def _exact(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(28,0)")


def mix(
    df: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size",
    weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 11,
) -> DataFrame:
    """source, doc_id, size, source_size, target, copies and taken of every row of ``df``.

    A document of a source whose target is r times its size is taken floor(r) times, and once more
    with probability r - floor(r). Which ones is drawn by the cube method: in a flight, three
    open documents at a time move their probabilities along the null space of two constraints,
    the number of documents and the number of words, so both stay at their expected totals, until one
    of the three is decided. A flight ends with at most two open documents. Flights run over hashed
    buckets of a source; their open documents meet in further flights, ``FAN`` buckets at a
    time, until one is left per source. ``HELD`` documents of a source stay out of all flights, and the
    landing tries every decision of these and the last open ones for the one nearest to the
    expected words, then to the expected number of documents. ``taken`` is copies times size. What
    a source takes differs from its target by a few words, unless a document far longer than all
    others stays open to the end.

    Draws depend on ids, sizes and ``seed`` alone, not on how the table is stored, so reruns agree.
    Rows equal in source, id and size are interchangeable: they are one unit with a count, of which
    all but a fraction is decided at once. A null size counts as 0, a null source is a source of
    its own, null ids are one id. A source without words has the target 0. An empty table gives no
    rows. Further columns are not used.
    """
    rows = df.select(
        F.col(source).cast("string").alias("source"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(size).cast("bigint"), F.lit(0)).cast("bigint").alias("size"),
    )
    units = materialize(rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")))
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    buckets = F.ceil(F.col("units") / F.lit(BUCKET)).cast("int")
    targets = materialize(source_targets(sizes, weights, cap).withColumn("buckets", buckets))
    most = targets.agg(F.max("buckets")).first()[0] or 1
    mark = F.xxhash64(F.lit(seed), "doc_id", "size")
    whole = F.floor(F.col("rate") + NEAR)
    part = F.greatest(F.col("rate") - whole, F.lit(0.0)) * F.col("n")
    sure = F.floor(part + NEAR)
    left = F.greatest(part - sure, F.lit(0.0))
    of_source = targets.select(F.col("source").alias("of"), "place", "source_size", "target", "rate", "buckets")
    open_units = units.join(of_source, units["source"].eqNullSafe(F.col("of"))).select(
        "source", "doc_id", "size", "n", "place", "source_size", "target", "buckets",
        whole.cast("bigint").alias("whole"), sure.cast("bigint").alias("sure"),
        F.when(left < NEAR, 0.0).otherwise(left).alias("p"),
        mark.alias("mark"), F.pmod(mark, F.col("buckets")).cast("int").alias("bucket"),
    )
    decided: list[DataFrame] = []
    level = 0
    while True:
        flown = materialize(_fly_buckets(open_units, seed + level))
        if most == 1:
            decided.append(flown)
            break
        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        decided.append(flown.where(~is_open))
        most, level = -(-most // FAN), level + 1
        open_units = flown.where(is_open).withColumns(
            {
                "buckets": F.ceil(F.col("buckets") / F.lit(FAN)).cast("int"),
                "bucket": F.floor(F.col("bucket") / F.lit(FAN)).cast("int"),
            }
        )
    found = decided[0]
    for more in decided[1:]:
        found = found.unionByName(more)
    return _per_row(found)


def _fly_buckets(units: DataFrame, seed: int) -> DataFrame:
    """``units`` with the probabilities after one flight of every bucket, landed where it is a source's only one."""

    def fly(table: pa.Table) -> pa.Table:
        p, size = table["p"].to_numpy().copy(), table["size"].to_numpy()
        mark = table["mark"].to_numpy()
        place, bucket, last = table["place"][0].as_py(), table["bucket"][0].as_py(), table["buckets"][0].as_py() == 1
        # Very long documents first, to meet all others before the flight ends; these in random order.
        order = np.lexsort((mark, -np.where(size > LONG * size.mean(), size, 0)))
        order = order[(p[order] > 0) & (p[order] < 1)]
        held = np.zeros(0, np.int64)
        if bucket == 0:
            held = order[np.argsort(mark[order], kind="stable")[:HELD]]
            order = order[~np.isin(order, held)]
        draws = np.random.Generator(np.random.PCG64([seed, place, bucket])).random(len(order) + 1)
        values, words = p.tolist(), size.tolist()
        left = flight(values, words, order.tolist(), draws.tolist())
        if last:
            land(values, words, [*held.tolist(), *left])
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(values, pa.float64()))

    return units.groupBy("place", "bucket").applyInArrow(fly, units.schema)


def flight(p: list[float], size: list[int], order: list[int], draws: list[float]) -> list[int]:
    """Decide all but at most two of the documents in ``order``, in place; returns the open ones.

    (size b - size c, size c - size a, size a - size b) keeps the sum of a, b and c and the sum of
    their words. Of its two directions, each up to the first probability at 0 or 1, one is drawn so that
    the expectation stays.
    """
    active: list[int] = []
    draw = iter(draws)
    for k in [*order, None]:
        if k is not None:
            active.append(k)
        while len(active) == 3 or (len(active) == 2 and size[active[0]] == size[active[1]]):
            if len(active) == 3:
                a, b, c = (size[i] for i in active)
                move = [b - c, c - a, a - b]
                if not any(move):
                    move = [1, -1, 0]
            elif k is None:
                move = [1, -1]
            else:
                break
            up = min((1 - p[i]) / m if m > 0 else p[i] / -m for i, m in zip(active, move, strict=True) if m)
            down = min(p[i] / m if m > 0 else (1 - p[i]) / -m for i, m in zip(active, move, strict=True) if m)
            step = up if next(draw) * (up + down) < down else -down
            stays = []
            for i, m in zip(active, move, strict=True):
                value = p[i] + step * m
                p[i] = 0.0 if value < NEAR else 1.0 if value > 1 - NEAR else value
                if 0 < p[i] < 1:
                    stays.append(i)
            active = stays
    return active


def land(p: list[float], size: list[int], left: list[int]) -> None:
    """Decide the documents ``left``, in place: nearest to their expected words, then to their expected number."""
    if not left:
        return
    n = len(left)
    choices = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    chance, words = np.array([p[i] for i in left]), np.array([size[i] for i in left], float)
    off_words = np.abs(choices @ words - chance @ words).round(6)
    off_count = np.abs(choices.sum(1) - chance.sum()).round(6)
    best = choices[np.lexsort((off_count, off_words))[0]]
    for i, taken in zip(left, best.tolist(), strict=True):
        p[i] = float(taken)


def _per_row(units: DataFrame) -> DataFrame:
    """One row for each of the ``n`` equal rows of a unit; the first ones get the further copies."""
    more = F.col("sure") + F.col("p").cast("bigint")
    kept = ["source", "doc_id", "size", "source_size", "target"]
    single = units.where("n = 1").select(*kept, (F.col("whole") + more).alias("copies"))
    blocks = units.where("n > 1").select(
        *kept, "whole", "n", more.alias("more"),
        F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(COPIES))).alias("first"),
    )
    spread = blocks.repartition("source", "doc_id", "size", "first")
    each = F.explode(F.sequence("first", F.least(F.col("first") + COPIES, F.col("n")) - 1)).alias("i")
    several = spread.select(*kept, "whole", "more", each)
    several = several.select(*kept, (F.col("whole") + (F.col("i") < F.col("more")).cast("bigint")).alias("copies"))
    return single.unionByName(several).withColumn("taken", F.col("copies") * F.col("size"))
