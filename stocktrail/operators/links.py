"""Joins along document chains."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import share_shuffles
from .skew import left_join, spread_null_keys


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Project to the named columns under new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


@dataclass(frozen=True)
class Documents:
    """Lines with their header in ``rows``; the same lines without it in ``lines``.

    Work that needs the link columns only reads ``lines`` and saves the header join.
    ``most`` bounds the lines that share one base link (type, entry, line); None if unknown.
    """

    rows: DataFrame
    lines: DataFrame
    most: int | None = None

    def where_line(self, condition: Column) -> Documents:
        return Documents(self.rows.filter(condition), self.lines.filter(condition), self.most)

    def where_header(self, condition: Column) -> Documents:
        kept = self.rows.filter(condition)
        return Documents(kept, kept, self.most)


def documents(
    header: DataFrame,
    line: DataFrame,
    prefix: str,
    header_cols: dict[str, str],
    line_cols: dict[str, str],
    gate: Column | None = None,
    how: str = "left",
    entry: str = "DocEntry",
    most: int | None = None,
) -> Documents:
    """Lines with the header of their own document, columns prefixed.

    The document number is the header's primary key, so the join does not repeat lines.

    ``gate`` is a condition on the header inside the join: lines of other headers stay, with
    the header columns null.  Joining lines to headers before any chain keeps the rows
    narrow and the shuffle on the document number.
    """
    heads = header if gate is None else header.filter(gate)
    heads = renamed(heads, {entry: f"{prefix}_entry", **{c: f"{prefix}_{n}" for c, n in header_cols.items()}})
    lines = renamed(line, {entry: f"_{prefix}_of", **{c: f"{prefix}_{n}" for c, n in line_cols.items()}})
    joined = lines.join(heads, lines[f"_{prefix}_of"] == heads[f"{prefix}_entry"], how)
    return Documents(joined.drop(f"_{prefix}_of"), lines.drop(f"_{prefix}_of"), most)


def document_lines(*args, **kwargs) -> DataFrame:
    """The rows of :func:`documents`."""
    return documents(*args, **kwargs).rows


def follow(
    parents: DataFrame,
    child: Documents,
    prefix: str,
    base_type: int,
    on: list[tuple[str, str]],
    limit: int | None = None,
    by: list[str] | None = None,
    at: tuple[str, str] | None = None,
) -> DataFrame:
    """Left join to follow-up lines that name the parent as their base document.

    ``on`` pairs a parent column with the child's ``base_entry``, ``base_line``, and where the
    chain asks for it ``item``. With ``by`` parents without the link are scattered by these columns,
    and the scatter column stays for the next join on the same link. ``at`` pairs a column by which the
    parents lie with the child's root (`rooted`); the parents then stay where they are.
    """
    typed = F.col(f"{prefix}_base_type") == F.lit(base_type)
    keys = [(p, f"{prefix}_{c}") for p, c in on]
    if at:
        return left_join(parents, child.rows.filter(typed), [at, *keys], limit, child.most, by or []).drop(at[1])
    return left_join(parents, child.rows.filter(typed), keys, limit, child.most, by, keep_spread=True)


def alternative_link_join(
    parents: DataFrame,
    child: Documents,
    prefix: str,
    arms: list[tuple[int, str, str]],
    limit: int | None = None,
    by: list[str] | None = None,
    at: tuple[str, str] | None = None,
) -> DataFrame:
    """Left join to child lines reachable by any of several (type, entry, line) links.

    A child line has one base link, so it matches a parent once if the parent's links are
    distinct.  For each arm the parent first learns whether any child carries its link, from
    the distinct link columns alone; it then takes one row per distinct existing link, or one
    row without any, and joins the children on it.  All joins are equi-joins, the parents are
    read once, and an arm on the key of the preceding join needs no new shuffle.
    Parents without a link are scattered by the columns ``by``, else by all that can be hashed.
    With ``at``, see `follow`, the parents are not shuffled at all.
    """
    share_shuffles(parents.sparkSession)
    by = parents.columns if by is None else by
    keys = ["_t", "_e", "_l"]
    base = [f"{prefix}_base_type", f"{prefix}_base_entry", f"{prefix}_base_line"]
    typed = F.col(base[0]).isin([a[0] for a in arms])
    roots = [F.col(at[1]).alias("_r")] if at else []
    present = child.lines.filter(typed).select(*[F.col(b).cast("bigint").alias(k) for b, k in zip(base, keys)], *roots)
    rows, links = parents, []
    for i, (kind, entry, line) in enumerate(arms):
        arm = [F.col("_e").alias(f"_e{i}"), F.col("_l").alias(f"_l{i}"), *(["_r"] if at else [])]
        of_kind = present.filter(F.col("_t") == kind).select(*arm)
        if at:
            of_kind = of_kind.repartition("_r").distinct()
            same = (rows[entry] == of_kind[f"_e{i}"]) & (rows[line] == of_kind[f"_l{i}"])
            rows = rows.join(of_kind, same & (rows[at[0]] == of_kind["_r"]), "left").drop("_r")
        else:
            rows, of_kind, spread = spread_null_keys(rows, of_kind.distinct(), [entry, line], [f"_e{i}", f"_l{i}"], by)
            same = (rows[entry] == of_kind[f"_e{i}"]) & (rows[line] == of_kind[f"_l{i}"])
            rows = rows.join(of_kind, same & (rows[spread] == of_kind["_rspread"]), "left").drop("_rspread")
        link = F.struct(
            F.lit(kind).cast("bigint").alias("_t"), F.col(f"_e{i}").alias("_e"), F.col(f"_l{i}").alias("_l")
        )
        links.append(F.when(F.col(f"_e{i}").isNotNull(), link))
    found = F.array_distinct(F.array_compact(F.array(*links)))
    resolved = rows.withColumn("_link", F.explode_outer(found))
    resolved = resolved.select(*parents.columns, *[F.col("_link")[k].alias(k) for k in keys])
    on = list(zip(keys, base))
    if at:
        return left_join(resolved, child.rows.filter(typed), [at, *on], limit, child.most, by=[]).drop(*keys, at[1])
    return left_join(resolved, child.rows.filter(typed), on, limit, child.most, by).drop(*keys)


ROOT_LINK = ["_t", "_e", "_l", "_root"]


def root_links(df: DataFrame, kind: int, prefix: str) -> DataFrame:
    """The complete links that follow-up lines of ``df`` may name, each with the root it leads to."""
    link = [F.lit(kind), F.col(f"{prefix}_entry"), F.col(f"{prefix}_line")]
    named = [c.cast("bigint").alias(k) for c, k in zip(link, ROOT_LINK)]
    return df.select(*named, F.col(f"{prefix}_root").alias("_root")).na.drop().distinct()


def own_root(child: Documents, prefix: str, kind: int) -> Documents:
    """Lines of one base type whose base document is the root itself."""
    root, typed = F.col(f"{prefix}_base_entry"), F.col(f"{prefix}_base_type") == F.lit(kind)
    add = [df.filter(typed & root.isNotNull()).withColumn(f"{prefix}_root", root) for df in (child.rows, child.lines)]
    return Documents(*add, child.most)


def rooted(child: Documents, prefix: str, links: DataFrame) -> Documents:
    """Lines with the root that their base link leads to; a line comes once per root, without any not at all.

    Only children move here, with narrow links; the parents of the whole chain stay with their root.
    """
    base = [F.col(f"{prefix}_base_{c}") for c in ("type", "entry", "line")]
    same = reduce(lambda a, b: a & b, [b == F.col(k) for b, k in zip(base, ROOT_LINK)])
    add = [
        df.join(links, same).withColumnRenamed("_root", f"{prefix}_root").drop(*ROOT_LINK[:3])
        for df in (child.rows, child.lines)
    ]
    return Documents(*add, child.most)


def both(a: Documents, b: Documents) -> Documents:
    return Documents(a.rows.unionByName(b.rows), a.lines.unionByName(b.lines), a.most)


def document_index(headers: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Headers of several document tables as one table keyed by (type, number).

    Each entry gives the table, its number column and its cancelled column.  A movement then
    needs one join instead of one per table.
    """
    parts = [
        df.select(
            F.lit(kind).alias("doc_type"),
            F.col(number).cast("string").alias("doc_number"),
            F.col(cancelled).alias("doc_cancelled"),
        )
        for kind, (df, number, cancelled) in headers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def polymorphic_join(
    movements: DataFrame,
    index: DataFrame,
    kind: str,
    number: str,
    limit: int | None = None,
    most: int | None = None,
    by: list[str] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Attach the document a movement belongs to; ``dealt`` movements lie by their number."""
    keyed = movements.withColumn("_number", F.col(number).cast("string"))
    joined = left_join(keyed, index, [("_number", "doc_number"), (kind, "doc_type")], limit, most, by, dealt=dealt)
    return joined.drop("_number", "doc_type", "doc_number")


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    take: dict[str, str],
    unique: str | None = None,
    limit: int | None = None,
    most: int | None = None,
    by: list[str] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Left join that adds the ``take`` columns under new names.

    Repeated right keys repeat left rows.  ``unique="check"`` raises on them instead;
    ``unique="given"`` says the key is a primary key or was just grouped by, so there is
    nothing to check or split; else ``most`` bounds the right rows of a key, if that is known.
    Left rows without a key are scattered by the columns ``by``, and ``dealt`` rows stay in place, see `left_join`.
    No broadcast is forced: Spark picks it from the measured size.
    """
    right_cols = {rk: f"_key_{i}" for i, (_, rk) in enumerate(on)}
    table = right.select(
        *[F.col(f"`{rk}`").alias(k) for rk, k in right_cols.items()],
        *[F.col(f"`{old}`").alias(new) for old, new in take.items()],
    )
    keys = list(right_cols.values())
    if unique == "check":
        assert_unique_key(table, keys)
    pairs = list(zip([lk for lk, _ in on], keys))
    joined = left_join(left, table, pairs, limit, 1 if unique else most, by, dealt=dealt)
    return joined.drop(*keys)


def assert_unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Raise when a non-null key occurs twice."""
    usable = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    repeated = usable.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1).first()
    if repeated is not None:
        raise ValueError(f"key {keys} is not unique, for example {repeated.asDict()}")
    return df


def snapshot_pick(snapshots: DataFrame, period: str, wanted: Column) -> DataFrame:
    """Rows of the wanted period, or of the latest one when that period has none."""
    top = snapshots.agg(
        F.coalesce(F.max(F.when(F.col(period) == wanted, F.col(period))), F.max(period)).alias("_period")
    )
    return snapshots.join(F.broadcast(top), F.col(period) == F.col("_period")).drop("_period")
