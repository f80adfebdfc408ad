"""Small value rewrites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def coalesce_chain(*sources: Column) -> Column:
    """First known value, as text."""
    return F.coalesce(*[s.cast("string") for s in sources])


def replace_when(c: Column, marker: str, other: Column) -> Column:
    """``other`` where ``c`` is the marker; null is not the marker and stays null."""
    return F.when(c.eqNullSafe(F.lit(marker)), other).otherwise(c)


def prefix_key(c: Column, prefix: str = "MP") -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def text_value(c: Column, dtype: T.DataType) -> Column:
    """Value as sink text: ISO date or timestamp, plain number, else its string form."""
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c.cast("string"))
    return c.cast("string")
