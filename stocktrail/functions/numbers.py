"""Number cleaning and netting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for "no number" in the sources.
EMPTY_NUMBER_TOKENS = ["", " ", "None", "none", "NULL", "NaN"]


def clean_number(c: Column, form: str = "token", safe: bool = False, kind: T.DataType | None = None) -> Column:
    """Text with thousands commas to double.

    With ``kind``, the type of a numeric column, the number is not taken through text: it keeps
    its type, null becomes 0, and NaN is treated as below.

    ``token``: empty tokens and null become 0, a float NaN stays NaN.
    ``fill``: empty tokens, null and NaN all become 0.
    ``pattern``: blank text, or text holding "None" or "nan", becomes 0.
    Other text raises under ANSI mode; with ``safe`` it becomes null.
    """
    if isinstance(kind, T.NumericType):
        known = F.coalesce(c, F.lit(0).cast(kind))
        if form == "token" or not isinstance(kind, (T.DoubleType, T.FloatType)):
            return known
        return F.nanvl(known, F.lit(0).cast(kind))
    text = F.regexp_replace(c.cast("string"), ",", "")
    parse = (lambda t: t.try_cast("double")) if safe else (lambda t: t.cast("double"))
    zero = F.lit(0.0)
    if form == "pattern":
        empty = text.isNull() | text.rlike(r"^\s*$|None|(?i:nan)")
        return F.when(empty, zero).otherwise(parse(text))
    number = F.when(text.isNull() | text.isin(EMPTY_NUMBER_TOKENS), zero).otherwise(parse(text))
    if form == "fill":
        return F.when(F.isnan(number), zero).otherwise(number)
    if form == "token":
        float_nan = F.typeof(c).isin("double", "float") & F.isnan(c.try_cast("double"))
        return F.when(float_nan, c.try_cast("double")).otherwise(number)
    raise ValueError(f"unknown form {form!r}")


def to_key(c: Column) -> Column:
    """Text to document number; anything that is not a whole number becomes null.

    A whole number may be written with decimals, such as "123.0".
    """
    decimal = c.cast("string").try_cast("decimal(38,6)")
    whole = F.when(decimal == F.floor(decimal), decimal.try_cast("bigint"))
    return F.coalesce(c.try_cast("bigint"), whole)


def snap_zero(c: Column, eps: float = 1e-10) -> Column:
    """Rounding residue to exact zero."""
    return F.when(F.abs(c) < F.lit(eps), F.lit(0).cast("double")).otherwise(c)


def net_layer_qty(received: Column, consumed: Column, missing: str = "zero") -> Column:
    """Part of a receipt that its own order has not consumed, never below zero.

    ``missing`` says what an unknown consumption means: ``zero`` (nothing consumed)
    or ``strict`` (the layer quantity is unknown too).  ``greatest`` skips nulls, so the
    strict form guards explicitly.
    """
    if missing == "zero":
        consumed = F.coalesce(consumed, F.lit(0))
    elif missing != "strict":
        raise ValueError(f"unknown missing {missing!r}")
    left = received - consumed
    return F.when(left.isNotNull(), F.greatest(left, F.lit(0).cast("double")))
