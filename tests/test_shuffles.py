"""How often the wide rows of a dataset are shuffled."""

import re
from pathlib import Path

import pytest

from stocktrail.plans import receipts
from stocktrail.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def shuffled(spark, frame) -> list[list[str]]:
    """Column names of the rows that each shuffle of the plan moves, as if all tables were large."""
    before = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    try:
        text = frame.select("*")._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.set(BROADCAST, before)
    found = re.findall(r"^\(\d+\) Exchange\nInput(?: \[\d+\])?: \[(.*?)\]$", text, re.M)
    return [re.findall(r"([\w`.()= %+-]+)#\d+", columns) for columns in found]


def with_column(exchanges, *names) -> int:
    return sum(any(n.strip() in names for n in columns) for columns in exchanges)


@pytest.mark.parametrize("name", ["movement_ledger"])
def test_ledger_moves_its_wide_rows_once(spark, name):
    exchanges = shuffled(spark, QUERIES[name](spark, str(DATA)))
    assert len(exchanges) > 5
    assert with_column(exchanges, "JrnlMemo", "Warehouse", "TransValue") == 1


def test_receipts_move_their_wide_rows_once_after_the_filter(spark, monkeypatch):
    numbered = []
    number_rows = receipts.number_rows
    monkeypatch.setattr(receipts, "number_rows", lambda rows, *a, **k: numbered.append(rows) or number_rows(rows, *a, **k))
    QUERIES["inbound_receipts"](spark, str(DATA))
    exchanges = shuffled(spark, numbered[0])
    assert len(exchanges) > 5
    assert with_column(exchanges, "JrnlMemo", "Warehouse", "TransValue") == 1


@pytest.mark.parametrize(
    "name, column, most",
    [
        ("sales_order_trace", "so_text", 1),
        ("sales_order_trace_ignore_late", "so_item", 1),
        # Two payment forms, each with its order lines and its distinct rows.
        ("order_fulfilment", "so_line_status", 4),
    ],
)
def test_order_lines_stay_with_their_order(spark, name, column, most):
    exchanges = shuffled(spark, QUERIES[name](spark, str(DATA)))
    assert 1 <= with_column(exchanges, column) <= most


def test_alternative_link_join_reads_what_it_shows(spark):
    """Rows without a link are scattered by the order line, so no other column goes along."""
    exchanges = shuffled(spark, QUERIES["alternative_link_join"](spark, str(DATA)))
    assert with_column(exchanges, "so_text", "so_client") == 0
    assert with_column(exchanges, "so_qty") <= 4


def test_balance_moves_order_heads_once(spark):
    """Complete heads once, those without number or item once."""
    exchanges = shuffled(spark, QUERIES["sales_order_balance"](spark, str(DATA)))
    assert 1 <= with_column(exchanges, "so_client") <= 2


def test_fulfilment_rows_of_an_order_move_together(spark):
    """Rows are dealt by the order's number alone, after repeats are removed where they lie."""
    frame = QUERIES["order_fulfilment"](spark, str(DATA))
    before = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    try:
        plan = frame.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(BROADCAST, before)
    assert len(re.findall(r"Exchange hashpartitioning\(_place#\d+, \d+\)", plan)) == 2
    assert not re.search(r"Exchange hashpartitioning\(so_number#", plan)


def test_receipts_choose_movements_by_their_keys(spark, monkeypatch):
    """The wide columns meet the chosen keys once, and are not moved again to be numbered."""
    written, write = [], receipts.materialize
    monkeypatch.setattr(receipts, "materialize", lambda df: written.append(df) or write(df))
    got = QUERIES["inbound_receipts"](spark, str(DATA))
    exchanges = shuffled(spark, written[0])
    assert len(exchanges) > 8
    assert with_column(exchanges, "Dscription", "Warehouse", "TransValue") == 1
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
