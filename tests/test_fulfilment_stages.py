"""Fulfilment of large document tables."""

from collections import Counter
from pathlib import Path

import pytest

from stocktrail import runtime
from stocktrail.plans import sales_orders
from stocktrail.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_large_fulfilment_writes_one_form_before_the_other(spark, monkeypatch):
    written = []
    monkeypatch.setattr(sales_orders, "materialize", lambda df: written.append(df) or runtime.materialize(df), raising=False)
    want = Counter(tuple(r) for r in QUERIES["order_fulfilment"](spark, str(DATA)).collect())
    assert not written and len(want) > 5_000
    spark.conf.set(runtime.HOT_ROWS_CONF, "2000")
    try:
        got = Counter(tuple(r) for r in QUERIES["order_fulfilment"](spark, str(DATA)).collect())
    finally:
        spark.conf.unset(runtime.HOT_ROWS_CONF)
    assert len(written) == 1 and got == want
