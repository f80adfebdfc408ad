"""Upper bounds of the rows per document key, for all tables of a run in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import compiled_methods, hot_rows, share_shuffles

SLOTS = 8192  # hash slots of a key; the fullest one bounds every key in it
FINE_SLOTS = 1 << 24  # the same for keys whose first bounds multiply to more than a group may hold

Key = tuple[str, ...]  # table, then the columns of the key


class SizedTables(Mapping[str, DataFrame]):
    """Tables with `most`, an upper bound of the rows that share a value of one of the given keys.

    All keys are counted by hash slot in one named stage: each task sends at most one number per
    key and slot it meets, and only the largest count per key reaches the driver. Joins
    ask for the bound instead of counting the same key again; rows with a null in the key are left out.
    """

    def __init__(self, tables: Mapping[str, DataFrame], keys: Iterable[Key]):
        self.tables = tables
        self.keys = tuple(dict.fromkeys(keys))
        self._most: dict[Key, int] | None = None
        self._fine: dict[Key, int] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)

    def most(self, *key: str) -> int:
        if self._most is None:
            self._most = largest_slots(self.tables, self.keys)
        return self._fine.get(key, self._most[key])

    def product(self, *keys: Key, limit: int | None = None) -> int:
        """Upper bound of the rows per key of a join over ``keys``.

        Slots of a large table hold many keys, so their bounds multiply to far more than a key has. Where that passes
        ``limit``, these keys alone are counted by finer slots, which is less than counting the joined rows.
        """
        bound = self._product(keys)
        limit = limit or hot_rows(self.tables[keys[0][0]].sparkSession)
        coarse = [k for k in keys if k not in self._fine]
        if bound > limit and coarse:
            self._fine |= largest_slots(self.tables, coarse, FINE_SLOTS)
            bound = self._product(keys)
        return bound

    def _product(self, keys: Iterable[Key]) -> int:
        return reduce(lambda a, b: a * b, [max(self.most(*k), 1) for k in keys])

    def may_exceed(self, rows: int, *key: str) -> bool:
        """Whether the table of ``key`` may have more rows than that."""
        return self.most(*key) * SLOTS > rows


def sized(tables: Mapping[str, DataFrame], keys: Iterable[Key]) -> SizedTables:
    """``tables`` with bounds for at least ``keys``; counts of an outer dataset are used again.

    The joins of a dataset share shuffles, see `share_shuffles`, and run compiled, see `compiled_methods`.
    """
    keys = tuple(keys)
    spark = SparkSession.getActiveSession()
    if spark is not None:
        share_shuffles(spark)
        compiled_methods(spark)
    if isinstance(tables, SizedTables) and set(keys) <= set(tables.keys):
        return tables
    return SizedTables(tables.tables if isinstance(tables, SizedTables) else tables, keys)


def largest_slots(tables: Mapping[str, DataFrame], keys: Iterable[Key], slots: int = SLOTS) -> dict[Key, int]:
    keys = tuple(keys)
    if not keys:
        return {}
    parts = []
    for i, (name, *columns) in enumerate(keys):
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        slot = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in columns]), F.lit(slots)).cast("int")
        parts.append(tables[name].filter(known).select(F.lit(i).alias("key"), slot.alias("slot")))
    counted = reduce(DataFrame.unionByName, parts).groupBy("key", "slot").count()
    found = dict.fromkeys(range(len(keys)), 0)
    found |= {r["key"]: r["most"] for r in counted.groupBy("key").agg(F.max("count").alias("most")).collect()}
    return {keys[i]: n for i, n in found.items()}


def link(table: str) -> Key:
    """Base link of a follow-up line."""
    return (table, "BaseType", "BaseEntry", "BaseLine")


def line(table: str) -> Key:
    return (table, "DocEntry", "LineNum")


def number(table: str) -> Key:
    return (table, "DocNum")
