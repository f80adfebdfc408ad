"""Filter conditions, each with its null rule spelled out."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of(day: Column, cutoff: Column) -> Column:
    """On or before the cutoff; unknown dates are out."""
    return day <= cutoff


def alive(cancelled: Column) -> Column:
    """Not cancelled; an unknown flag counts as alive."""
    return F.coalesce(cancelled, F.lit("N")) != F.lit("Y")


def voided_or_missing(cancelled: Column) -> Column:
    """Cancelled or absent document."""
    return F.coalesce(cancelled, F.lit("Y")) == F.lit("Y")


def item_prefix(code: Column, prefixes: Iterable[str]) -> Column:
    """Non-blank code that begins with one of ``prefixes``."""
    starts = reduce(lambda a, b: a | b, [code.startswith(p) for p in prefixes])
    return code.isNotNull() & (F.length(F.trim(code)) > 0) & starts


def keep_not_in(c: Column, listed: Iterable[str]) -> Column:
    """Not one of the listed values; null is kept."""
    return ~F.coalesce(c.isin(list(listed)), F.lit(False))


def outer_side_cutoff(*days: Column, cutoff: Column) -> Column:
    """After a left join: every follow-up document is absent or in time."""
    return reduce(lambda a, b: a & b, [d.isNull() | (d <= cutoff) for d in days])
