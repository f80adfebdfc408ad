"""Sales order datasets: trace, balance per order and item, and fulfilment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    alive,
    balance_status,
    clean_number,
    item_prefix,
    mask_after,
    outer_side_cutoff,
    voided_or_missing,
)
from ..operators.links import (
    Documents,
    alternative_link_join,
    both,
    document_lines,
    documents,
    follow,
    own_root,
    root_links,
    rooted,
)
from ..operators.skew import PLACE, place_of
from ..runtime import hot_rows, materialize
from .key_sizes import SizedTables, link, sized

Tables = Mapping[str, DataFrame]

ORDER, INVOICE, DELIVERY, RETURN, RETURN_REQUEST = 17, 13, 15, 16, 234

TRACE_KEYS = [link(name) for name in ("INV1", "DLN1", "RDN1", "RIN1")]
_ORDER_LINE = ["so_entry", "so_line"]  # tells rows apart where a chain has no document

_BASE = {"BaseType": "base_type", "BaseEntry": "base_entry", "BaseLine": "base_line"}
_HEAD = {"DocNum": "number", "DocStatus": "status", "CreateDate": "created", "DocDate": "posted"}
_LINE = {"LineNum": "line", "Quantity": "qty", **_BASE}


def order_lines(t: Tables) -> DataFrame:
    """Sales order headers with their lines."""
    return document_lines(
        t["ORDR"],
        t["RDR1"],
        "so",
        {
            "DocNum": "number",
            "CardCode": "partner",
            "CardName": "client",
            "DocStatus": "status",
            "CANCELED": "cancelled",
            "CreateDate": "created",
            "DocDate": "posted",
            "DocDueDate": "due",
            "GroupNum": "payment_group",
        },
        {
            "LineNum": "line",
            "LineStatus": "line_status",
            "ItemCode": "item",
            "Dscription": "text",
            "Quantity": "qty",
        },
        how="inner",
    )


def live_documents(t: Tables, header: str, line: str, prefix: str, extra: dict[str, str] | None = None) -> Documents:
    """Follow-up lines; only a header that is not cancelled is attached."""
    most = t.most(*link(line)) if isinstance(t, SizedTables) else None
    return documents(
        t[header], t[line], prefix, _HEAD, {**_LINE, **(extra or {})}, F.col("CANCELED") == "N", most=most
    )


def sales_order_trace(t: Tables, cutoff: dt.date, late_docs: str = "drop") -> DataFrame:
    """One row per order line and combination of its invoices, deliveries, returns and credits.

    ``late_docs="drop"`` removes rows whose delivery or return is later than the cutoff, so a
    line delivered only afterwards disappears; ``"ignore"`` leaves such documents out of the
    join and keeps the line.

    Order lines lie by their order from the header join on and do not move again: every follow-up line
    is first given its order, the root, along narrow links, and comes to it once.
    """
    if late_docs not in ("drop", "ignore"):
        raise ValueError(f"unknown late_docs {late_docs!r}")
    day = F.lit(cutoff)
    t = sized(t, TRACE_KEYS)
    delivery, returned = live_documents(t, "ODLN", "DLN1", "dl"), live_documents(t, "ORDN", "RDN1", "rt")
    if late_docs == "ignore":
        delivery = delivery.where_header(F.col("dl_created").isNull() | (F.col("dl_created") <= day))
        returned = returned.where_header(F.col("rt_created").isNull() | (F.col("rt_created") <= day))
    credit = live_documents(t, "ORIN", "RIN1", "cn", {"DropShip": "drop_ship"}).where_line(F.col("cn_drop_ship") == "N")
    by_delivery = [("dl_entry", "base_entry"), ("dl_line", "base_line")]

    ordered, delivered = live_documents(t, "OINV", "INV1", "inv"), live_documents(t, "OINV", "INV1", "di")
    invoice = own_root(ordered, "inv", ORDER)
    by_invoice = root_links(invoice.rows, INVOICE, "inv")
    delivery = both(own_root(delivery, "dl", ORDER), rooted(delivery, "dl", by_invoice))
    of_delivery = root_links(delivery.rows, DELIVERY, "dl")
    billed = rooted(delivered, "di", of_delivery)
    returned = rooted(returned, "rt", of_delivery)
    links = of_delivery.unionByName(by_invoice).unionByName(root_links(billed.rows, INVOICE, "di")).distinct()
    credit = rooted(credit, "cn", links)

    def at(prefix: str) -> tuple[str, str]:
        return ("so_entry", f"{prefix}_root")

    by_line = [("so_entry", "base_entry"), ("so_line", "base_line")]
    rows = follow(order_lines(t), invoice, "inv", ORDER, by_line, at=at("inv"))
    rows = alternative_link_join(
        rows, delivery, "dl", [(ORDER, "so_entry", "so_line"), (INVOICE, "inv_entry", "inv_line")], at=at("dl")
    )
    if late_docs == "drop":
        rows = rows.filter(outer_side_cutoff(F.col("dl_created"), cutoff=day))
    rows = follow(rows, billed, "di", DELIVERY, by_delivery, by=_ORDER_LINE, at=at("di"))
    rows = alternative_link_join(
        rows,
        credit,
        "cn",
        [(DELIVERY, "dl_entry", "dl_line"), (INVOICE, "inv_entry", "inv_line"), (INVOICE, "di_entry", "di_line")],
        at=at("cn"),
    )
    rows = follow(rows, returned, "rt", DELIVERY, by_delivery, by=_ORDER_LINE, at=at("rt"))
    if late_docs == "drop":
        rows = rows.filter(outer_side_cutoff(F.col("rt_created"), cutoff=day))
    kept = [c for c in rows.columns if not c.endswith(("_base_type", "_base_entry", "cn_drop_ship"))]
    return rows.select(*[c for c in kept if c in ("dl_base_line",) or not c.endswith("_base_line")])


def trace_order():
    """Published row order of the trace."""
    return [F.col(c).asc_nulls_last() for c in ("so_number", "so_line", "dl_number", "rt_number", "cn_number")]


# Header columns that identify an order in the balance.
ORDER_HEAD = ["so_created", "so_cancelled", "so_client", "so_status", "so_due", "so_payment_group"]
_KINDS = {
    "ordered": ("so_qty", None, None, "fill", None),
    "delivered": ("dl_qty", "dl_line", "dl_number", "fill", "dl_created"),
    "returned": ("rt_qty", "rt_line", "rt_number", "fill", "rt_created"),
    "credited": ("cn_qty", "cn_line", "cn_number", "fill", "cn_created"),
}


def sales_order_balance(trace: DataFrame, cutoff: dt.date) -> DataFrame:
    """Ordered, net delivered and open quantity per order header and item.

    The trace repeats a document once per combination.  Each row is turned into five narrow
    records (order line, delivery, return, credit, header), duplicates are removed, and the
    sums are taken over what is left: one pass over the trace instead of one per quantity.
    """
    day = F.lit(cutoff)
    none_l, none_s = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    records = []
    for kind, (qty, line, number, form, created) in _KINDS.items():
        value = clean_number(F.col(qty), form, kind=trace.schema[qty].dataType)
        if created:
            value = mask_after(value, F.col(created), day)
        child = F.col(number).cast("bigint") if number else none_l
        applies = F.col(number).isNotNull() if number else F.col("so_number").isNotNull()
        records.append(
            F.when(
                applies,
                F.struct(
                    F.lit(kind).alias("kind"),
                    F.coalesce(F.col("so_line"), F.lit(0)).cast("bigint").alias("line"),
                    (F.col(line).cast("bigint") if line else none_l).alias("child_line"),
                    child.alias("child"),
                    value.alias("qty"),
                    F.lit(None).cast(_head_type(trace)).alias("head"),
                ),
            )
        )
    records.append(
        F.struct(
            F.lit("head").alias("kind"),
            none_l.alias("line"),
            none_l.alias("child_line"),
            none_l.alias("child"),
            F.lit(None).cast("double").alias("qty"),
            F.struct(*ORDER_HEAD).alias("head"),
        )
    )
    keys = ["so_number", "so_item"]
    narrow = trace.select(*keys, F.explode(F.array_compact(F.array(*records))).alias("r")).select(*keys, "r.*")
    sums = narrow.distinct().groupBy(*keys, "kind", "head").agg(F.sum("qty").alias("qty"))
    group = Window.partitionBy(*keys)

    def total(kind: str):
        known = F.col("so_number").isNotNull() & F.col("so_item").isNotNull()
        return F.when(known, F.sum(F.when(F.col("kind") == kind, F.col("qty"))).over(group))

    wide = sums.select(*keys, "kind", "head", *[total(k).alias(k) for k in _KINDS]).filter(F.col("kind") == "head")
    return netted(wide.select("head.*", *keys, *_KINDS))


def netted(wide: DataFrame) -> DataFrame:
    """Net delivered and open quantity and state from the four sums.

    Without deliveries, credits do not count.
    """
    delivered, returned = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("delivered", "returned"))
    credited = F.when(delivered == 0, F.lit(0.0)).otherwise(F.coalesce(F.col("credited"), F.lit(0.0)))
    out = wide.select(
        "so_created",
        "so_cancelled",
        "so_number",
        "so_item",
        "so_client",
        "so_status",
        "so_due",
        "so_payment_group",
        F.col("ordered").alias("so_ordered"),
        F.when(F.col("ordered").isNotNull(), delivered - returned - credited).alias("so_net_delivered"),
    )
    out = out.withColumn("so_balance", F.col("so_ordered") - F.col("so_net_delivered"))
    return out.withColumn("so_state", balance_status(F.col("so_cancelled"), F.col("so_balance")))


def _head_type(trace: DataFrame) -> str:
    types = {f.name: f.dataType.simpleString() for f in trace.schema}
    return "struct<" + ",".join(f"{c}:{types[c]}" for c in ORDER_HEAD) + ">"


# Payment forms.
CREDIT, CASH = "Credito", "Contado"


def _flagged(t: SizedTables, header: str, line: str, prefix: str) -> Documents:
    return documents(
        t[header],
        t[line],
        prefix,
        {"DocNum": "number", "DocDate": "posted", "CANCELED": "cancelled"},
        {"LineNum": "line", "ItemCode": "item", "Quantity": "qty", **_BASE},
        most=t.most(*link(line)),
    )


def order_fulfilment(t: Tables) -> DataFrame:
    """Order lines with their deliveries, returns, invoices and credit notes, on credit and in cash.

    On credit the order is delivered and the delivery invoiced; in cash the order is invoiced
    and the invoice delivered. Over large document tables the first form's rows are written, so that the shuffle
    files of the two forms do not lie on disk together.
    """

    def on(prefix: str) -> list[tuple[str, str]]:
        return [(f"{prefix}_{a}", b) for a, b in (("entry", "base_entry"), ("line", "base_line"), ("item", "item"))]

    t = sized(t, TRACE_KEYS)
    orders = order_lines(t).filter(item_prefix(F.col("so_item"), ("A", "MP")))
    delivery, invoice = _flagged(t, "ODLN", "DLN1", "dl"), _flagged(t, "OINV", "INV1", "inv")
    returned, requested = _flagged(t, "ORDN", "RDN1", "rt"), _flagged(t, "ORDN", "RDN1", "rq")
    credit = _flagged(t, "ORIN", "RIN1", "cn")

    def at(prefix: str) -> dict:
        return {"on": on_of[prefix], "by": _ORDER_LINE, "at": ("so_entry", f"{prefix}_root")}

    requested = own_root(requested, "rq", RETURN_REQUEST)

    first = own_root(delivery, "dl", ORDER)
    links = root_links(first.rows, DELIVERY, "dl")
    bills = rooted(invoice, "inv", links)
    on_of = {"dl": on("so"), "rt": on("dl"), "rq": on("so"), "inv": on("dl"), "cn": on("inv")}
    on_credit = follow(orders, first, "dl", ORDER, **at("dl")).filter(alive(F.col("dl_cancelled")))
    on_credit = follow(on_credit, rooted(returned, "rt", links), "rt", DELIVERY, **at("rt"))
    on_credit = on_credit.filter(voided_or_missing(F.col("rt_cancelled")))
    on_credit = follow(on_credit, requested, "rq", RETURN_REQUEST, **at("rq"))
    on_credit = follow(on_credit, bills, "inv", DELIVERY, **at("inv")).filter(alive(F.col("inv_cancelled")))
    on_credit = follow(on_credit, rooted(credit, "cn", root_links(bills.rows, INVOICE, "inv")), "cn", INVOICE, **at("cn"))

    first = own_root(invoice, "inv", ORDER)
    sent = rooted(delivery, "dl", root_links(first.rows, INVOICE, "inv"))
    back = rooted(returned, "rt", root_links(sent.rows, DELIVERY, "dl"))
    on_of = {"inv": on("so"), "dl": on("inv"), "rt": on("dl"), "rq": on("so"), "cn": on("rt")}
    in_cash = follow(orders, first, "inv", ORDER, **at("inv")).filter(alive(F.col("inv_cancelled")))
    in_cash = follow(in_cash, sent, "dl", INVOICE, **at("dl")).filter(alive(F.col("dl_cancelled")))
    in_cash = follow(in_cash, back, "rt", DELIVERY, **at("rt"))
    in_cash = in_cash.filter(voided_or_missing(F.col("rt_cancelled")))
    in_cash = follow(in_cash, requested, "rq", RETURN_REQUEST, **at("rq"))
    in_cash = follow(in_cash, rooted(credit, "cn", root_links(back.rows, RETURN, "rt")), "cn", RETURN, **at("cn"))

    def published(df: DataFrame, form: str) -> DataFrame:
        kept = df.filter(voided_or_missing(F.col("cn_cancelled"))).select(
            "so_entry",
            *[f"so_{c}" for c in ("number", "posted", "partner", "client", "payment_group", "status", "cancelled")],
            *[f"so_{c}" for c in ("line", "item", "qty", "line_status")],
            *[f"{p}_{c}" for p in ("dl", "rt", "rq", "inv", "cn") for c in ("number", "posted", "cancelled", "qty")],
        )
        # Repeats of one order go where they lie. Then an order's rows move together, so that a shuffle block holds what
        # they share about once; rows without a number scatter.
        kept = kept.distinct().drop("so_entry")
        place = place_of(F.col("so_number"), [F.col(c) for c in ("so_partner", "so_item", "so_line")])
        placed = kept.withColumn(PLACE, place).repartition(PLACE)
        return placed.distinct().drop(PLACE).withColumn("payment_form", F.lit(form))

    first = published(on_credit, CREDIT)
    limit = hot_rows(first.sparkSession)
    if any(t.may_exceed(limit, *link(name)) for name in ("DLN1", "INV1")):
        first = materialize(first)
    return first.unionByName(published(in_cash, CASH))
