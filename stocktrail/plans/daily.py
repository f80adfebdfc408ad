"""Daily sales summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import global_summary, top_rows
from ..operators.windows import head_tail_trend


def daily_summary(series: DataFrame) -> DataFrame:
    """Totals, daily mean, and last week against first week, in one row."""
    totals, trend = global_summary(series, "sales", "customers"), head_tail_trend(series, "day", "sales")
    parts = totals.unionByName(trend, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def top_days(series: DataFrame, n: int = 5) -> DataFrame:
    return top_rows(series.select("day", "sales", "customers"), "sales", "day", n)
