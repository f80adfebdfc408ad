"""Work on groups of any size.

Spark puts all rows of a window partition, and of one side of an outer join key, into one
task.  That is fine until one key holds a large share of the table.  The helpers here count
rows per key first (a partial aggregate over the key columns only).  Keys under the
threshold take the ordinary plan.  Keys above it are split:

* windows: the hot rows are range-partitioned over (key, order), so that one key spans many
  partitions; each partition is scanned on its own and receives what came before it as a
  small per-partition offset;
* joins: the many-row side is salted, the other side repeated once per salt.

No count runs where an upper bound is known: of written tables, and of document keys, which
`plans.key_sizes` bounds for all tables of a run in one pass.

The set of hot keys is bounded by rows / threshold. It is a written table, so Spark knows its
size and broadcasts it only while it is small; nothing here forces a broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import hot_rows, materialize, share_shuffles, written_rows

BLOCK = "_block"


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _same(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    return _all([left[k].eqNullSafe(right[prefix + k]) for k in keys])


def _prefixed(df: DataFrame, keys: list[str], prefix: str, *extra: str) -> DataFrame:
    return df.select(*[F.col(f"`{k}`").alias(prefix + k) for k in keys], *extra)


def hot_groups(df: DataFrame, keys: list[str], limit: int | None = None, most: int | None = None) -> DataFrame | None:
    """Keys with more than ``limit`` rows and their ``_rows``; None when there is none.

    ``most`` is a known upper bound of the rows of a key, or of the table. Up to the limit nothing is
    counted. Else a table that is not larger than ``limit`` cannot hold such a key, so the
    plain count, which needs no shuffle, comes first.
    """
    limit = limit or hot_rows(df.sparkSession)
    if most is None:
        most = written_rows(df)
    if most is None:
        most = df.count()
    if most <= limit:
        return None
    found = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit))
    return found if written_rows(found) else None


def split_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of hot keys, and the others."""
    marked = _prefixed(hot, keys, "_hot_")
    same = _same(df, marked, keys, "_hot_")
    return df.join(marked, same, "left_semi"), df.join(marked, same, "left_anti")


def tie_break(df: DataFrame, keys: list[str]) -> list[Column]:
    """All remaining columns that can be ordered, so that equal order keys sort the same on a retry."""
    unordered = (T.MapType, T.VariantType)
    return [F.col(f"`{f.name}`") for f in df.schema if f.name not in keys and not isinstance(f.dataType, unordered)]


def ordered_blocks(df: DataFrame, keys: list[str], order: list[Column], rows: int, limit: int) -> DataFrame:
    """Cut ``df`` into contiguous ranges of (keys, order) and number them in ``_block``.

    Exact copies are told apart by their position after a full local sort, so even a
    group of identical rows spreads over blocks.  The result is a written table: block
    borders come from sampling and must not be drawn twice.
    """
    wanted = max(2, -(-2 * rows // limit))
    by = [*[F.col(f"`{k}`") for k in keys], *order, *tie_break(df, keys)]
    spread = df.sortWithinPartitions(*by).withColumn("_copy", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(wanted, *by, F.col("_copy"))
    return materialize(ranged.withColumn(BLOCK, F.spark_partition_id()))


def row_order(order: list[Column], blocks: DataFrame, keys: list[str]) -> list[Column]:
    """The total order used inside blocks."""
    return [*order, *tie_break(blocks.drop(BLOCK), keys)]


def before(keys: list[str], order: list[Column]):
    """Frame of all rows ahead of the current one."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def total_before(c: Column, frame) -> Column:
    return F.coalesce(F.sum(c).over(frame), F.lit(0))


def attach_offsets(blocks: DataFrame, offsets: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Join per-(key, block) values onto the rows; there is one row per key and block."""
    at = [*keys, BLOCK]
    small = _prefixed(offsets, at, "_at_", *names)
    return blocks.join(small, _same(blocks, small, at, "_at_"), "left").drop(*["_at_" + k for k in at])


def block_offsets(blocks: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Per (key, block): total of each sum over all earlier blocks of the key."""
    totals = blocks.groupBy(*keys, BLOCK).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    frame = before(keys, [F.col(BLOCK)])
    return totals.select(*keys, BLOCK, *[total_before(F.col(n), frame).alias(n) for n in sums])


def spread_name(keys: list[str]) -> str:
    """Name of the column that scatters rows without these keys; joins on the same keys share it and so its exchange."""
    return "_spread_" + "_".join(keys)


def spread_null_keys(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str], by: list[str]):
    """Give both sides one more join key that scatters left rows with a null key over many tasks.

    Such rows match nothing, but would all be shuffled to one task.  Rows with a full key get
    0, as does every right row; the right value is computed from the key so that it stays a
    join key and is not folded away.  The scatter is a hash of the columns ``by``, which should tell
    the left rows apart, and of the keys themselves; no other column is read for it. A left
    side that already has the column keeps it.
    """
    name = spread_name(lkeys)
    if name not in left.columns:
        missing = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in lkeys])
        scatter = F.xxhash64(*[F.col(f"`{c}`") for c in dict.fromkeys([*by, *lkeys])])
        left = left.withColumn(name, F.when(missing, scatter).otherwise(F.lit(0).cast("bigint")))
    zero = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in rkeys]), F.lit(1))
    return left, right.withColumn("_rspread", zero), name


def drop_spread(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_spread_")])


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    limit: int | None = None,
    most: int | None = None,
    by: list[str] | None = None,
    keep_spread: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """Left outer join whose right side may hold very many rows of one key.

    A skewed left side is split by AQE. Left rows without a key are scattered by the columns ``by``, which
    should tell them apart; without ``by`` by all columns, with an empty list not at all.
    ``keep_spread`` leaves the scatter column to following joins on the same keys.

    A skewed right side of an outer join is not split by AQE, so hot right keys are salted here.
    A hot key is known to exist on the right, so every left row that carries it matches and its
    unmatched salts can be dropped. ``most`` is a known upper bound of right rows per key.

    ``dealt`` says that the left rows were dealt by the left key of the first pair (`deal`); joins on it and
    any further columns share that one shuffle.
    """
    if dealt:
        return _dealt_left_join(left, right, on, limit, most)
    limit = limit or hot_rows(right.sparkSession)
    lkeys, rkeys = [k for k, _ in on], [k for _, k in on]
    usable = right.filter(_all([F.col(f"`{k}`").isNotNull() for k in rkeys]))
    hot = hot_groups(usable, rkeys, limit, most)
    if hot is None:
        return _plain_left_join(left, usable, on, by, keep_spread)

    pairs, spread = on, spread_name(lkeys)
    had = spread in left.columns
    by = _hashable(left) if by is None else by
    if by or had:
        left, usable, spread = spread_null_keys(left, usable, lkeys, rkeys, by)
        pairs = [*on, (spread, "_rspread")]
    salts = hot.withColumn("_salts", F.ceil(F.col("_rows") / F.lit(limit)).cast("int"))
    for_right = _prefixed(salts, rkeys, "_hot_", "_salts")
    same = _all([usable[k] == for_right["_hot_" + k] for k in rkeys])
    marked = usable.join(for_right, same, "left").drop(*["_hot_" + k for k in rkeys])
    hot_side = marked.filter(F.col("_salts").isNotNull())
    hot_side = hot_side.sortWithinPartitions(*[F.col(f"`{k}`") for k in rkeys], *tie_break(usable, rkeys))
    hot_side = hot_side.withColumn("_rsalt", F.pmod(F.monotonically_increasing_id(), F.col("_salts")).cast("int"))
    cold_side = marked.filter(F.col("_salts").isNull()).withColumn("_rsalt", F.lit(0))
    salted = hot_side.unionByName(cold_side).drop("_salts").withColumn("_hit", F.lit(True))

    for_left = _prefixed(salts, rkeys, "_hot_", "_salts")
    same = _all([left[lk] == for_left["_hot_" + rk] for lk, rk in on])
    repeated = left.join(for_left, same, "left").drop(*["_hot_" + k for k in rkeys])
    repeated = repeated.withColumn(
        "_lsalt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    equal = [repeated[lk] == salted[rk] for lk, rk in pairs]
    joined = repeated.join(salted, _all([*equal, repeated["_lsalt"] == salted["_rsalt"]]), "left")
    kept = joined.filter(F.col("_hit").isNotNull() | F.col("_salts").isNull())
    kept = kept.drop("_lsalt", "_rsalt", "_hit", "_salts", "_rspread")
    return kept if keep_spread or had else kept.drop(spread)


def _plain_left_join(left, right, on, by, keep_spread):
    lkeys, rkeys = [k for k, _ in on], [k for _, k in on]
    had = spread_name(lkeys) in left.columns
    by = _hashable(left) if by is None else by
    if not by and not had:
        return left.join(right, _all([left[lk] == right[rk] for lk, rk in on]), "left")
    left, right, spread = spread_null_keys(left, right, lkeys, rkeys, by)
    pairs = [*on, (spread, "_rspread")]
    joined = left.join(right, _all([left[lk] == right[rk] for lk, rk in pairs]), "left").drop("_rspread")
    return joined if keep_spread or had else joined.drop(spread)


PLACE = "_place"
PLACES = 1 << 16  # far more than partitions, and narrow in a shuffle


def place_of(key: Column, by: list[Column]) -> Column:
    """Where rows of a key are dealt to: a hash of the key, of the columns ``by`` where it is null."""
    place = F.when(key.isNull(), F.xxhash64(F.lit("no key"), *by)).otherwise(F.xxhash64(key.cast("string")))
    return F.pmod(place, F.lit(PLACES)).cast("int")


def deal(df: DataFrame, key: Column, by: list[str], most: int | None = None, limit: int | None = None) -> DataFrame:
    """``df`` dealt by the place of ``key``, once for all joins whose keys contain it, see `left_join`.

    ``most`` bounds the rows of a key. Above the limit the rows get their place but are not moved:
    each join then shuffles them itself, where AQE splits a skewed side.
    """
    placed = df.withColumn(PLACE, place_of(key, [F.col(f"`{c}`") for c in by]))
    limit = limit or hot_rows(df.sparkSession)
    share_shuffles(df.sparkSession)
    return placed if most is not None and most > limit else placed.repartition(PLACE)


def _dealt_left_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], limit: int | None, most: int | None) -> DataFrame:
    """The right rows are dealt by the key of the first pair alone, so the left rows stay where they are."""
    limit = limit or hot_rows(right.sparkSession)
    rkeys = [k for _, k in on]
    usable = right.filter(_all([F.col(f"`{k}`").isNotNull() for k in rkeys]))
    usable = usable.withColumn("_rplace", place_of(F.col(f"`{rkeys[0]}`"), []))
    # The place second, so a join whose keys begin as those of the one before finds its rows sorted, and few compare it.
    pairs = [on[0], (PLACE, "_rplace"), *on[1:]]
    if hot_groups(usable, rkeys, limit, most) is not None:
        return left_join(left, usable, pairs, limit, by=[]).drop("_rplace")
    usable = usable.repartition("_rplace")
    return left.join(usable, _all([left[lk] == usable[rk] for lk, rk in pairs]), "left").drop("_rplace")


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
