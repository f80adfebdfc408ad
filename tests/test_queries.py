"""Every registered query against its check SQL at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from stocktrail.runtime import HOT_ROWS_CONF

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")
HOT = [
    "allocate_layers_newest_first",
    "allocate_layers_strict_null",
    "forward_fill",
    "fill_within_group",
    "receipt_number",
    "alternative_link_join",
    "sales_order_balance",
    "polymorphic_document",
    "inbound_receipts",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return v if isinstance(v, str) else f"{float(v):.6f}"


def rows(df):
    ordered = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in r) for r in ordered.itertuples(index=False, name=None))


def check(spark, duck, name):
    got = entry_points.queries()[name](spark, str(DATA)).toPandas()
    want = duck.execute(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_query(spark, duck, name):
    check(spark, duck, name)


@pytest.mark.parametrize("name", HOT)
def test_query_with_every_group_split(spark, duck, name):
    """A threshold of a few rows sends almost all groups through the split plans."""
    spark.conf.set(HOT_ROWS_CONF, "3")
    try:
        check(spark, duck, name)
    finally:
        spark.conf.unset(HOT_ROWS_CONF)


def test_ledger_order_numbers_every_movement(spark):
    got = entry_points.queries()["ledger_movement_order"](spark, str(DATA)).toPandas().sort_values("row_no")
    assert len(got) == entry_points.queries()["movement_ledger"](spark, str(DATA)).count()
    assert list(got["row_no"]) == list(range(1, len(got) + 1))
    assert got["created"].is_monotonic_increasing


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
