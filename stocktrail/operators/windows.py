"""Ordered operators: running values, gap filling, first and last rows, numbering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import snap_zero
from ..runtime import hot_rows, materialize, with_rows_of
from .skew import BLOCK, attach_offsets, before, hot_groups, ordered_blocks, split_hot, tie_break, total_before


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key.

    Spark limits the rank below the shuffle, so each map task sends one row per key
    and the size of a key does not matter.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


POSITION_BITS = 33


def number_rows(
    df: DataFrame,
    order: list[Column],
    name: str = "receipt_no",
    parts: int | None = None,
    distinct_order: bool = False,
    narrow: DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """Number all rows of the table from 1 in the given order, without a one-task window.

    Rows are range-partitioned and sorted; the position inside the partition comes with the
    row id Spark gives there, and the partition's offset from the sizes of the ones ahead.
    The placed rows are a written table, because range borders are sampled and must not be
    drawn twice.  ``distinct_order`` promises that the order tells all rows apart; otherwise
    the other columns break ties, and exact copies are spread by their local position.

    ``narrow`` has the same rows with no more than the columns of the order and ``key``, which tells rows apart. Then
    only these are sorted, and their numbers come to the rows of ``df`` by the key, in the write of the result.
    """
    if narrow is not None:
        numbers = number_rows(narrow, order, name, parts, distinct_order).select(F.col(key).alias("_numbered"), name)
        return materialize(df.join(numbers, F.col(key).eqNullSafe(F.col("_numbered"))).drop("_numbered"))
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by, source = order, df
    if not distinct_order:
        full = [*order, *tie_break(df, [])]
        source = df.sortWithinPartitions(*full).withColumn("_copy", F.monotonically_increasing_id())
        by = [*full, F.col("_copy")]
    placed = source.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_copy")
    written = materialize(placed.withColumn("_at", F.monotonically_increasing_id()))
    block = F.shiftright("_at", POSITION_BITS)
    local = F.col("_at").bitwiseAND((1 << POSITION_BITS) - 1)
    sizes = written.groupBy(block.alias(BLOCK)).agg(F.count(F.lit(1)).alias("_rows"))
    ahead = sizes.select(BLOCK, total_before(F.col("_rows"), before([], [F.col(BLOCK)])).alias("_ahead"))
    # A written table of one row per partition, so the join does not shuffle the rows.
    ahead = materialize(ahead)
    joined = written.withColumn("_in", block).join(ahead, F.col("_in") == F.col(BLOCK))
    return with_rows_of(joined.select(*df.columns, (F.col("_ahead") + local + 1).cast("bigint").alias(name)), written)


def net_by_day(ledger: DataFrame, item: str, day: str, qty_in: Column, qty_out: Column) -> DataFrame:
    """Net movement per item and day; rows with no item or day are left out."""
    known = ledger.filter(F.col(item).isNotNull() & F.col(day).isNotNull())
    return known.groupBy(item, day).agg(F.sum(qty_in - qty_out).alias("net"))


def running_inventory(ledger: DataFrame, item: str, day: str, qty_in: Column, qty_out: Column) -> DataFrame:
    """Closing inventory of each item on each day it moved.

    The window runs over day totals: one item has at most one row per calendar day,
    however many movements it has.
    """
    w = Window.partitionBy(item).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    daily = net_by_day(ledger, item, day, qty_in, qty_out)
    return daily.withColumn("inventory", snap_zero(F.sum("net").over(w)))


def stock_at_cutoff(
    ledger: DataFrame, item: str, day: str, qty_in: Column, qty_out: Column, cutoff: Column
) -> DataFrame:
    """Stock on hand per item at the cutoff: the running inventory of its last day in time.

    That value is the sum of all movements up to the cutoff, so no window is needed.
    """
    in_time = ledger.filter(F.col(item).isNotNull() & (F.col(day) <= cutoff))
    return in_time.groupBy(item).agg(snap_zero(F.sum(qty_in - qty_out)).alias("on_hand"))


def last_movement(ledger: DataFrame, item: str, day: str, order: list[Column], cutoff: Column) -> DataFrame:
    """Latest ledger row of each item at the cutoff; ``order`` lists the latest first."""
    return first_per_key(ledger.filter(F.col(day) <= cutoff), [item], order)


def _carry(blocks: DataFrame, keys: list[str], order: list[Column], cols: list[str]) -> DataFrame:
    """Per (key, block): nearest known value in earlier and in later blocks."""
    edge = F.struct(*order)
    known = [F.when(F.col(f"`{c}`").isNotNull(), edge) for c in cols]
    ends = blocks.groupBy(*keys, BLOCK).agg(
        *[F.max_by(F.col(f"`{c}`"), k).alias(f"_last_{i}") for i, (c, k) in enumerate(zip(cols, known))],
        *[F.min_by(F.col(f"`{c}`"), k).alias(f"_first_{i}") for i, (c, k) in enumerate(zip(cols, known))],
    )
    w = Window.partitionBy(*keys).orderBy(BLOCK)
    ahead, behind = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    n = range(len(cols))
    return ends.select(
        *keys,
        BLOCK,
        *[F.last(f"_last_{i}", ignorenulls=True).over(ahead).alias(f"_ahead_{i}") for i in n],
        *[F.first(f"_first_{i}", ignorenulls=True).over(behind).alias(f"_behind_{i}") for i in n],
    )


def _fill(df: DataFrame, keys: list[str], order: list[Column], cols: list[str], backward: bool, carried: bool):
    w = Window.partitionBy(*keys).orderBy(*order)
    down, up = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    for i, c in enumerate(cols):
        source = F.col(f"`{c}`")
        choices = [F.last(source, ignorenulls=True).over(down)]
        if carried:
            choices.append(F.col(f"_ahead_{i}"))
        if backward:
            choices.append(F.first(source, ignorenulls=True).over(up))
            if carried:
                choices.append(F.col(f"_behind_{i}"))
        df = df.withColumn(f"_filled_{i}", F.coalesce(*choices))
    return df


def fill_gaps(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    cols: list[str],
    backward: bool = False,
    limit: int | None = None,
    most: int | None = None,
) -> DataFrame:
    """Replace null in ``cols`` by the last known value of the group, then (``backward``) the next.

    ``order`` names ascending columns; rows they do not tell apart follow their other columns,
    so a group gives the same rows whether or not it is split. ``most`` is a known upper bound
    of the rows of a group.
    """
    limit = limit or hot_rows(df.sparkSession)
    by = [F.col(f"`{o}`") for o in order]
    by = [*by, *tie_break(df, [*keys, *order])]
    out_cols = df.columns
    hot = hot_groups(df, keys, limit, most)
    parts = []
    if hot is None:
        parts.append(_fill(df, keys, by, cols, backward, carried=False))
    else:
        hot_part, plain = split_hot(df, keys, hot)
        parts.append(_fill(plain, keys, by, cols, backward, carried=False))
        rows = hot.agg(F.sum("_rows")).first()[0]
        blocks = ordered_blocks(hot_part, keys, by, rows, limit)
        total = [*by, F.col("_copy")]
        carry = _carry(blocks, keys, total, cols)
        names = [f"{side}_{i}" for side in ("_ahead", "_behind") for i in range(len(cols))]
        joined = attach_offsets(blocks, carry, keys, names)
        parts.append(_fill(joined, [*keys, BLOCK], total, cols, backward, carried=True))
    place = {c: f"_filled_{i}" for i, c in enumerate(cols)}
    picked = [p.select(*[F.col(f"`{place.get(c, c)}`").alias(c) for c in out_cols]) for p in parts]
    return reduce(DataFrame.unionByName, picked)


def fill_within_group(
    df: DataFrame,
    group: str,
    order: list[str],
    cols: list[str],
    only: Column,
    limit: int | None = None,
    most: int | None = None,
) -> DataFrame:
    """Fill ``cols`` down then up inside ``group``, for the rows where ``only`` holds.

    Rows that qualify but have no group lose the values; rows that do not qualify are untouched.
    """
    applies = F.coalesce(only, F.lit(False))
    grouped = F.col(group).isNotNull()
    rest = df.filter(~(applies & grouped))
    lost = applies & ~grouped
    rest = rest.withColumns({c: F.when(~lost, F.col(f"`{c}`")) for c in cols})
    filled = fill_gaps(df.filter(applies & grouped), [group], order, cols, backward=True, limit=limit, most=most)
    return filled.unionByName(rest)


def head_tail_trend(series: DataFrame, day: str, value: str, n: int = 7) -> DataFrame:
    """Mean of the last ``n`` days minus the mean of the first ``n``."""
    picked = series.select(day, value)
    first = picked.orderBy(F.col(day).asc()).limit(n).select(value, F.lit(True).alias("head"))
    last = picked.orderBy(F.col(day).desc()).limit(n).select(value, F.lit(False).alias("head"))
    both = first.unionByName(last).agg(
        F.avg(F.when(F.col("head"), F.col(value))).alias("head_mean"),
        F.avg(F.when(~F.col("head"), F.col(value))).alias("tail_mean"),
    )
    return both.select("head_mean", "tail_mean", (F.col("tail_mean") - F.col("head_mean")).alias("trend"))


__all__ = [
    "fill_gaps",
    "fill_within_group",
    "first_per_key",
    "head_tail_trend",
    "last_movement",
    "net_by_day",
    "number_rows",
    "running_inventory",
    "stock_at_cutoff",
]
