"""What Spark runs while a dataset is being declared: schema reads, one pass over document keys, named stage writes."""

from pathlib import Path

import pytest

from stocktrail import runtime
from stocktrail.operators import allocate, skew, windows
from stocktrail.plans import key_sizes, ledger, order_balance, production, receipts, report, sales_orders
from stocktrail.plans.erp_tables import CUTOFF, SOURCES, erp_tables
from stocktrail.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")
USERS = [allocate, skew, windows, order_balance, receipts, report, sales_orders, ledger, production]


@pytest.fixture
def stages(monkeypatch):
    """Stage writes and key passes that builders ask for."""
    seen = {"writes": 0, "key passes": 0}
    write, sizes = runtime.materialize, key_sizes.largest_slots

    def counted_write(df):
        seen["writes"] += 1
        return write(df)

    def counted_sizes(*args):
        seen["key passes"] += 1
        return sizes(*args)

    for module in USERS:
        if hasattr(module, "materialize"):
            monkeypatch.setattr(module, "materialize", counted_write)
    monkeypatch.setattr(key_sizes, "largest_slots", counted_sizes)
    return seen


def queries_run(spark, build):
    """SQL executions that start while ``build`` declares its DataFrame, besides naming the source tables as views."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = store.executionsCount()
    frame = build()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return frame, store.executionsCount() - before - len(SOURCES)


@pytest.mark.parametrize("name", ["sales_order_trace", "order_fulfilment", "movement_ledger", "production_balance"])
def test_joins_count_keys_once(spark, stages, name):
    _, ran = queries_run(spark, lambda: QUERIES[name](spark, str(DATA)))
    assert stages == {"writes": 0, "key passes": 1} and ran <= 1


def test_report(spark, stages):
    """One pass over the document keys of all datasets, one over the item keys; all else is a stage write."""
    frame, ran = queries_run(spark, lambda: QUERIES["stock_origin_report"](spark, str(DATA)))
    assert stages["key passes"] == 3  # the ledger is a table of its own
    # Besides stage writes and key passes: one bound of the trim.
    assert ran <= stages["writes"] + stages["key passes"] + 1
    assert frame.columns == list(report.REPORT_COLUMNS)


def test_no_plan_hashes_whole_rows(spark):
    t = erp_tables(spark, str(DATA))
    for frame in (
        sales_orders.sales_order_trace(t, CUTOFF),
        sales_orders.order_fulfilment(t),
        ledger.movement_ledger(t),
        production.production_order_balance(t, CUTOFF),
    ):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        hashed = [part.split(")")[0] for part in plan.split("xxhash64(")[1:]]
        assert max(h.count("#") for h in hashed) <= 5
