"""Order trace and balance on hand-made documents."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stocktrail.operators.links import Documents, alternative_link_join
from stocktrail.plans.order_balance import order_balance
from stocktrail.plans.production import production_order_balance
from stocktrail.plans.sales_orders import order_fulfilment, sales_order_balance, sales_order_trace
from stocktrail.sources.schemas import DDL, schema

CUTOFF = dt.date(2024, 6, 30)
EARLY, LATE = dt.date(2024, 1, 10), dt.date(2024, 8, 1)


def tables(spark, **rows):
    """ERP tables from short dicts; every table not named is empty."""
    out = {}
    for name in DDL:
        shape = schema(name)
        data = []
        for given in rows.get(name, []):
            values = {k: float(v) if k in ("Quantity", "PlannedQty", "IssuedQty") else v for k, v in given.items()}
            data.append(tuple(values.get(f.name) for f in shape))
        ddl = DDL[name].replace("decimal(19,6)", "double")
        out[name] = spark.createDataFrame(data, ddl)
    return out


def order(entry=1, cancelled="N"):
    return {"DocEntry": entry, "DocNum": 100 + entry, "CardName": "c", "CANCELED": cancelled, "CreateDate": EARLY}


def line(no=0, item="A1", qty=10, entry=1):
    return {"DocEntry": entry, "LineNum": no, "ItemCode": item, "Quantity": qty, "LineStatus": "O"}


def head(entry, day=EARLY, cancelled="N"):
    return {"DocEntry": entry, "DocNum": 1000 + entry, "CANCELED": cancelled, "CreateDate": day, "DocDate": day}


def child(entry, base_type, base, qty, no=0, base_line=0, **extra):
    return {
        "DocEntry": entry,
        "LineNum": no,
        "BaseType": base_type,
        "BaseEntry": base,
        "BaseLine": base_line,
        "ItemCode": "A1",
        "Quantity": qty,
        **extra,
    }


def balance(t, **kw):
    """Straight from the documents; the sums over the trace must be the same rows."""
    got = order_balance(t, CUTOFF, **kw).collect()
    over_trace = sales_order_balance(sales_order_trace(t, CUTOFF, **kw), CUTOFF)
    assert sorted(map(str, got)) == sorted(map(str, over_trace.select(*order_balance(t, CUTOFF, **kw).columns).collect()))
    return got


def test_delivered_and_returned(spark):
    t = tables(
        spark,
        ORDR=[order()],
        RDR1=[line()],
        ODLN=[head(5)],
        DLN1=[child(5, 17, 1, 6)],
        ORDN=[head(7)],
        RDN1=[child(7, 15, 5, 2)],
    )
    (row,) = balance(t)
    assert (row["so_ordered"], row["so_net_delivered"], row["so_balance"], row["so_state"]) == (10, 4, 6, "A")


def test_fan_out_does_not_repeat_sums(spark):
    t = tables(
        spark,
        ORDR=[order()],
        RDR1=[line()],
        ODLN=[head(5), head(6)],
        DLN1=[child(5, 17, 1, 3), child(6, 17, 1, 4)],
        ORDN=[head(7), head(8)],
        RDN1=[child(7, 15, 5, 1), child(8, 15, 5, 1)],
    )
    assert sales_order_trace(t, CUTOFF).count() == 3
    (row,) = balance(t)
    assert (row["so_ordered"], row["so_net_delivered"]) == (10, 5)


def test_late_delivery(spark):
    t = tables(spark, ORDR=[order()], RDR1=[line()], ODLN=[head(5, LATE)], DLN1=[child(5, 17, 1, 6)])
    assert balance(t) == []
    (row,) = balance(t, late_docs="ignore")
    assert (row["so_net_delivered"], row["so_balance"]) == (0, 10)


def test_cancelled_header_keeps_quantity_without_number(spark):
    t = tables(spark, ORDR=[order()], RDR1=[line()], ODLN=[head(5, cancelled="Y")], DLN1=[child(5, 17, 1, 6)])
    (row,) = sales_order_trace(t, CUTOFF).collect()
    assert (row["dl_qty"], row["dl_number"]) == (6, None)
    assert balance(t)[0]["so_net_delivered"] == 0


def test_credit_reached_twice_counts_once(spark):
    t = tables(
        spark,
        ORDR=[order()],
        RDR1=[line()],
        OINV=[head(3)],
        INV1=[child(3, 17, 1, 10), child(3, 15, 5, 10)],
        ODLN=[head(5)],
        DLN1=[child(5, 13, 3, 6)],
        ORIN=[head(9)],
        RIN1=[child(9, 13, 3, 2, DropShip="N"), child(9, 13, 3, 9, no=1, DropShip="Y")],
    )
    trace = sales_order_trace(t, CUTOFF)
    assert trace.count() == 1
    assert balance(t)[0]["so_net_delivered"] == 4


def test_credit_without_delivery(spark):
    t = tables(
        spark,
        ORDR=[order()],
        RDR1=[line()],
        OINV=[head(3)],
        INV1=[child(3, 17, 1, 10)],
        ORIN=[head(9)],
        RIN1=[child(9, 13, 3, 3, DropShip="N")],
    )
    assert balance(t)[0]["so_net_delivered"] == 0


def test_cancelled_order(spark):
    t = tables(spark, ORDR=[order(cancelled=" y ")], RDR1=[line()])
    assert balance(t)[0]["so_state"] == "C"


@pytest.mark.parametrize("limit", [3, 10_000])
def test_alternative_links_equal_or_join(spark, limit):
    parents = spark.sql(
        "SELECT id AS p, CAST(id % 4 AS BIGINT) AS e1, CASE WHEN id % 3 > 0 THEN CAST(id % 5 AS BIGINT) END AS e2, "
        "CAST(id % 2 AS INT) AS l FROM range(20)"
    )
    rows = spark.sql(
        "SELECT id AS x_id, CAST(CASE WHEN id % 3 = 0 THEN 17 ELSE 13 END AS INT) AS x_base_type, "
        "CAST(id % 7 AS BIGINT) AS x_base_entry, CAST(id % 2 AS INT) AS x_base_line FROM range(60)"
    )
    got = alternative_link_join(parents, Documents(rows, rows), "x", [(17, "e1", "l"), (13, "e2", "l"), (13, "e1", "l")], limit)
    arms = " OR ".join(
        f"(x_base_type = {k} AND x_base_entry = {e} AND x_base_line = l)" for k, e in ((17, "e1"), (13, "e2"), (13, "e1"))
    )
    want = parents.join(rows, F.expr(arms), "left")
    pick = lambda df: Counter((r["p"], r["x_id"]) for r in df.collect())
    assert pick(got) == pick(want)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_production_balance(spark):
    t = tables(
        spark,
        OWOR=[
            {"DocEntry": 1, "DocNum": 70, "Status": "R", "ItemCode": "S1", "CreateDate": EARLY},
            {"DocEntry": 2, "DocNum": 71, "Status": "R", "ItemCode": "A9", "CreateDate": EARLY},
        ],
        WOR1=[
            {"DocEntry": 1, "LineNum": 0, "ItemCode": "A1", "PlannedQty": 10},
            {"DocEntry": 1, "LineNum": 1, "ItemCode": "A1", "PlannedQty": 5},
            {"DocEntry": 2, "LineNum": 0, "ItemCode": "A1", "PlannedQty": 5},
        ],
        OIGE=[head(3), head(4, LATE)],
        IGE1=[{"DocEntry": e, "ItemCode": "A1", "Quantity": 12, "BaseRef": "70"} for e in (3, 4)],
        OIGN=[head(5)],
        IGN1=[{"DocEntry": 5, "ItemCode": "A1", "Quantity": 2, "BaseRef": "70"}],
    )
    (row,) = production_order_balance(t, CUTOFF).collect()
    assert (row["po_number"], row["po_planned"], row["po_issued"], row["po_received"]) == (70, 15, 12, 2)
    assert (row["po_balance"], row["po_state"]) == (5, "A")


def test_fulfilment_union(spark):
    t = tables(
        spark,
        ORDR=[order()],
        RDR1=[line(), line(1, item="Z9")],
        ODLN=[head(5)],
        DLN1=[child(5, 17, 1, 6)],
        OINV=[head(3)],
        INV1=[child(3, 17, 1, 4)],
    )
    got = {r["payment_form"]: r for r in order_fulfilment(t).collect()}
    assert got["Credito"]["dl_qty"] == 6 and got["Credito"]["inv_qty"] is None
    assert got["Contado"]["inv_qty"] == 4 and got["Contado"]["dl_qty"] is None


def random_documents(seed, lines=24):
    """Few documents with many links: several per line, shared numbers, cancelled and late ones, open links."""
    rng = random.Random(seed)

    def maybe(value, chance=0.08):
        return None if rng.random() < chance else value

    def heads(n):
        days = [EARLY, EARLY, LATE, None]
        return [head(e, rng.choice(days), rng.choice("NNNY")) | {"DocNum": maybe(1000 + rng.randrange(n + 2))} for e in range(n)]

    def children(n, kinds, spread, count=lines):
        return [
            child(rng.randrange(n), maybe(rng.choice(kinds)), maybe(rng.randrange(spread)), rng.randrange(1, 9), no=maybe(rng.randrange(3)),
                  base_line=maybe(rng.randrange(3)), DropShip=rng.choice("NNY"))
            for _ in range(count)
        ]

    return {
        "ORDR": [order(e, rng.choice("NNY")) | {"DocNum": maybe(100 + rng.randrange(4))} for e in range(5)],
        "RDR1": [line(maybe(rng.randrange(3)), maybe(rng.choice(["A1", "A2"])), rng.randrange(1, 9), rng.randrange(6)) for _ in range(14)],
        "OINV": heads(5),
        "INV1": children(5, [17, 15, 13], 5, 18),
        "ODLN": heads(5),
        "DLN1": children(5, [17, 13], 5, 18),
        "ORDN": heads(4),
        "RDN1": children(4, [15, 15, 17], 5, 12),
        "ORIN": heads(4),
        "RIN1": children(4, [15, 13], 5, 18),
    }


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("late_docs", ["drop", "ignore"])
def test_balance_from_documents_equals_balance_over_trace(spark, seed, late_docs):
    t = tables(spark, **random_documents(seed))
    assert balance(t, late_docs=late_docs)


def test_balance_needs_no_product(spark):
    """One line with 40 documents of each kind: the trace holds their product, the balance's joins do not."""
    n = range(40)
    t = tables(
        spark,
        ORDR=[order()],
        RDR1=[line()],
        OINV=[head(100 + i) for i in n],
        INV1=[child(100 + i, 17, 1, 1) for i in n],
        ODLN=[head(200 + i) for i in n],
        DLN1=[child(200 + i, 17, 1, 1) for i in n],
        ORDN=[head(300 + i) for i in n],
        RDN1=[child(300 + i, 15, 200, 1) for i in n],
        ORIN=[head(400 + i) for i in n],
        RIN1=[child(400 + i, 13, 100, 1, DropShip="N") for i in n],
    )
    assert sales_order_trace(t, CUTOFF).count() == (40 + 39) * 79
    (row,) = order_balance(t, CUTOFF).collect()
    assert (row["so_ordered"], row["so_net_delivered"]) == (10, 40 - 40 - 40)
