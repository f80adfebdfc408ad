"""One query per operator and dataset over the test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fx
from ..functions.codes import CLASSES
from ..operators import aggregates, links, windows
from ..operators.allocate import allocate_layers, allocation_totals
from ..operators.collapse import collapse_repeated, split_by
from ..operators.skew import left_join
from ..runtime import materialize, shared_dir
from ..sources import readers, writers
from ..sources.snapshots import SnapshotTable
from ..sources.versions import ResultTable
from ..sources.schemas import schema
from . import daily, ledger, netting, order_balance, production, receipts, report, sales_orders
from .erp_tables import CUTOFF, erp_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as double, so engines compare alike."""

    def cast(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        return c.alias(f.name)

    return df.select(*[cast(f) for f in df.schema])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day() -> Column:
    return F.lit(CUTOFF)


def moves(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger view of the line items: flag R goes out, all else comes in."""
    out = F.col("l_returnflag") == "R"
    qty, none = F.col("l_quantity"), F.lit(0.0)
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("item"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.when(out, none).otherwise(qty).alias("qty_in"),
        F.when(out, qty).otherwise(none).alias("qty_out"),
        F.col("l_orderkey").alias("doc"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_tax").alias("tax"),
        F.col("l_discount").alias("discount"),
    )


def newest() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ("day", "doc", "line", "supplier", "value")]


def _held(rows: DataFrame) -> DataFrame:
    return windows.stock_at_cutoff(rows, "item", "day", F.col("qty_in"), F.col("qty_out"), day())


def stock(spark: SparkSession, folder: str) -> DataFrame:
    return _held(moves(spark, folder))


def _inbound(rows: DataFrame) -> DataFrame:
    rows = rows.filter((F.col("qty_in") > 0) & fx.as_of(F.col("day"), day()))
    return rows.select("item", "day", "doc", "line", "supplier", "value", "tax", "discount", F.col("qty_in").alias("qty"))


def layers(spark: SparkSession, folder: str) -> DataFrame:
    return _inbound(moves(spark, folder))


def _allocated(spark: SparkSession, folder: str, null_qty: str, bucket: Column | None = None) -> DataFrame:
    return _allocate(layers(spark, folder), stock(spark, folder), null_qty, bucket)


def _allocate(rows: DataFrame, held: DataFrame, null_qty: str, bucket: Column | None = None) -> DataFrame:
    if null_qty == "strict":
        rows = rows.withColumn("qty", F.when(~((F.col("tax") == 0.08) & (F.col("discount") >= 0.05)), F.col("qty")))
    got = allocate_layers(
        rows.drop("tax", "discount"),
        held,
        item="item",
        qty="qty",
        on_hand="on_hand",
        order=newest(),
        null_qty=null_qty,
        bucket=bucket,
    )
    return plain(got.select("item", "day", "doc", "line", "supplier", "value", "qty", "on_hand", "taken"))


@query
def allocate_layers_newest_first(spark, folder):
    return _allocated(spark, folder, "zero")


@query
def allocate_layers_strict_null(spark, folder):
    return _allocated(spark, folder, "strict")


@query
def allocate_layers_trimmed(spark, folder):
    """The same rows; months of an item beyond its coverage are dropped before the shuffle."""
    return _allocated(spark, folder, "zero", F.trunc("day", "MM"))


@query
def allocate_layers_trimmed_strict(spark, folder):
    return _allocated(spark, folder, "strict", F.trunc("day", "MM"))


@query
def allocation_summary(spark, folder):
    return allocation_totals(_allocated(spark, folder, "zero"), "item")


@query
def stock_on_hand(spark, folder):
    return stock(spark, folder)


@query
def running_inventory(spark, folder):
    return plain(
        windows.running_inventory(moves(spark, folder), "item", "day", F.col("qty_in"), F.col("qty_out"))
    )


@query
def net_by_item_day(spark, folder):
    return plain(windows.net_by_day(moves(spark, folder), "item", "day", F.col("qty_in"), F.col("qty_out")))


@query
def last_movement(spark, folder):
    rows = moves(spark, folder).withColumn("net", F.col("qty_in") - F.col("qty_out"))
    got = windows.last_movement(rows, "item", "day", newest(), day())
    return plain(got.select("item", "day", "doc", "line", "net"))


@query
def last_closing_inventory(spark, folder):
    """Forward-filled inventory, last row per item at the cutoff."""
    daily_rows = windows.running_inventory(
        moves(spark, folder), "item", "day", F.col("qty_in"), F.col("qty_out")
    )
    in_time = daily_rows.filter(fx.as_of(F.col("day"), day()))
    filled = windows.fill_gaps(in_time, ["item"], ["day"], ["inventory"])
    last = windows.first_per_key(filled, ["item"], [F.col("day").desc()])
    return last.select("item", "inventory", F.lit(CUTOFF.isoformat()).alias("cutoff"))


@query
def forward_fill(spark, folder):
    rows = moves(spark, folder).withColumn("known", F.when(F.col("qty_out") == 0, F.col("qty_in")))
    got = windows.fill_gaps(rows, ["item"], ["day", "doc", "line", "supplier", "value"], ["known"])
    return plain(got.select("item", "day", "doc", "line", "supplier", "value", "known"))


@query
def fill_within_group(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") != "A", F.col("l_orderkey").cast("string")).alias("base_ref"),
        F.col("l_linestatus").alias("charge"),
        F.when(F.col("l_discount") < 0.05, F.col("l_partkey")).alias("order_no"),
        F.when(F.col("l_tax") < 0.04, F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("client"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("item"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("value"),
    )
    order = ["line", "item", "supplier", "value"]
    return plain(
        windows.fill_within_group(rows, "base_ref", order, ["order_no", "client"], F.col("charge") == "F")
    )


@query
def first_per_movement(spark, folder):
    rows = moves(spark, folder).select("doc", "line", "item", "supplier", "value")
    return plain(windows.first_per_key(rows, ["doc"], [F.col(c) for c in ("line", "item", "supplier", "value")]))


@query
def receipt_number(spark, folder):
    rows = layers(spark, folder).select("day", "doc", "line", "supplier", "value", "item")
    return plain(windows.number_rows(rows, [*newest(), F.col("item").asc()]))


@query
def collapse_repeated_lines(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.when(F.col("l_tax") > 0, F.col("l_orderkey")).alias("doc"),
        F.when(F.col("l_tax") == 0.01, F.lit("")).otherwise(F.concat(F.lit("L"), F.col("l_linenumber").cast("string"))).alias("code"),
        F.col("l_quantity").alias("qty"),
        F.col("l_partkey").alias("item"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("value"),
        F.when(F.col("l_discount") < 0.05, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_discount") >= 0.03, F.col("l_linestatus")).alias("status"),
    )
    return collapse_repeated(rows, ["doc", "code"], "qty", ["item", "supplier", "value"])


# Input texts shared with the check queries.
RAW_NUMBER = (
    "CASE WHEN l_tax = 0 THEN '' WHEN l_tax = 0.01 THEN ' ' WHEN l_tax = 0.02 THEN 'None' "
    "WHEN l_tax = 0.03 THEN CAST(NULL AS STRING) WHEN l_tax = 0.04 THEN 'NULL' WHEN l_tax = 0.05 THEN 'NaN' "
    "WHEN l_tax = 0.06 THEN concat('1,', lpad(CAST(l_linenumber AS STRING), 3, '0'), '.5') "
    "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"
)
RAW_KEY = (
    "CASE WHEN l_tax < 0.02 THEN concat('K', CAST(l_partkey AS STRING)) WHEN l_tax < 0.03 THEN '' "
    "ELSE CAST(l_partkey AS STRING) END"
)
RAW_DATE = (
    "CASE WHEN o_orderpriority = '5-LOW' THEN 'sin fecha' WHEN o_orderpriority = '2-HIGH' THEN '2000-13-45' "
    "WHEN o_orderpriority = '1-URGENT' THEN CAST(NULL AS STRING) ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"
)


@query
def clean_number(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr(RAW_NUMBER).alias("raw")
    )
    plain_raw = F.when(F.col("raw") != "NULL", F.col("raw"))
    return plain(
        rows.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            fx.clean_number(F.col("raw")).alias("by_token"),
            fx.clean_number(F.col("raw"), "fill").alias("filled"),
            fx.clean_number(plain_raw, "pattern").alias("by_pattern"),
        )
    )


@query
def to_key(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(RAW_KEY).alias("raw"))
    return plain(rows.withColumn("key", fx.to_key(F.col("raw"))))


@query
def to_timestamp_or_null(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", F.expr(RAW_DATE).alias("raw"))
    return plain(rows.withColumn("at", fx.to_ts(F.col("raw"))))


@query
def date_plus_hhmm(spark, folder):
    rows = erp_tables(spark, folder)["OINM"].select("TransNum", "ItemCode", "CreateDate", "DocTime")
    return plain(rows.withColumn("moved_at", fx.date_plus_hhmm(F.col("CreateDate"), F.col("DocTime"))))


@query
def movement_labels(spark, folder):
    rows = erp_tables(spark, folder)["OINM"]
    return rows.select(
        "TransNum",
        "ItemCode",
        "TransType",
        fx.movement_label(F.col("TransType")).alias("label"),
        fx.movement_label(F.col("TransType"), fx.RECEIPT_LABELS).alias("receipt_label"),
    )


@query
def status_by_type(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    both = left_join(rows, orders, [("l_orderkey", "o_orderkey")])
    flags = {"R": F.col("o_orderstatus"), "A": F.col("o_orderpriority")}
    return plain(
        both.select(
            "l_orderkey", "l_linenumber", "l_partkey", fx.status_by_type(F.col("l_returnflag"), flags).alias("status")
        )
    )


@query
def line_status(spark, folder):
    rows = erp_tables(spark, folder)["RDR1"]
    return plain(rows.select("DocEntry", "LineNum", "ItemCode", fx.line_status(F.col("LineStatus")).alias("status")))


@query
def classify_receipt(spark, folder):
    """Class of every movement from its own attributes and those of its item and supplier."""
    got = _classified(spark, folder)
    return got.select("l_orderkey", "l_linenumber", "item", "kind", "charge", "receipt_class", "qty")


def _classified(spark, folder):
    lines = table(spark, folder, "lineitem")
    accounts = erp_tables(spark, folder)["OACT"].select("AcctCode", "FormatCode", "AcctName")
    rows = lines.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("day"),
        F.expr("CASE WHEN l_discount = 0.05 THEN 'Y' WHEN l_discount <> 0.06 THEN 'N' END").alias("flag"),
        F.expr("CASE WHEN l_returnflag = 'N' THEN '20' WHEN l_linestatus = 'O' THEN '59' ELSE '18' END").alias("kind"),
        F.expr(
            "CASE WHEN l_tax = 0 THEN 'GA' WHEN l_tax = 0.01 THEN 'G' WHEN l_tax = 0.02 THEN 'OF' WHEN l_tax = 0.03 "
            "THEN 'OV' WHEN l_tax = 0.04 THEN 'OS' WHEN l_tax = 0.05 THEN 'ST' WHEN l_tax = 0.06 THEN 'XX' END"
        ).alias("charge"),
        F.expr("CASE WHEN l_discount = 0.1 THEN l_orderkey END").alias("order_no"),
        F.expr("CASE WHEN l_discount = 0.09 THEN l_orderkey END").alias("so_no"),
        F.expr(
            "CASE WHEN l_discount < 0.03 THEN 'Recibo de produccion' WHEN l_discount < 0.05 THEN 'Receipt from Prod' "
            "ELSE 'Ajuste' END"
        ).alias("memo"),
        F.expr(
            "CASE WHEN l_tax < 0.02 THEN concat('A', CAST(l_partkey AS STRING)) WHEN l_tax < 0.05 THEN "
            "concat('S', CAST(l_partkey AS STRING)) END"
        ).alias("produced"),
        F.expr("concat('S', CAST(l_partkey AS STRING))").alias("item"),
        F.expr("concat('S', CAST(l_suppkey AS STRING))").alias("acct"),
        F.col("l_quantity").alias("qty"),
    )
    rows = left_join(rows, accounts, [("acct", "AcctCode")])
    cls = fx.classify_receipt(
        kind=F.col("kind"),
        charge=F.col("charge"),
        production_order=F.col("order_no"),
        sales_order=F.col("so_no"),
        memo=F.col("memo"),
        produced_item=F.col("produced"),
        item=F.col("item"),
        account=F.col("FormatCode"),
        account_name=F.col("AcctName"),
    )
    return rows.withColumn("receipt_class", cls)


@query
def coalesce_chain(spark, folder):
    rows = table(spark, folder, "lineitem")
    first = F.when(F.col("l_tax") < 0.02, F.col("l_partkey"))
    second = F.when(F.col("l_tax") < 0.05, F.col("l_suppkey"))
    third = fx.blank_to_null(F.when(F.col("l_tax") == 0.05, F.lit("")).otherwise(F.col("l_returnflag")))
    return plain(
        rows.select("l_orderkey", "l_linenumber", "l_partkey", fx.coalesce_chain(first, second, third).alias("number"))
    )


@query
def replace_when(spark, folder):
    rows = erp_tables(spark, folder)["OINM"]
    got = fx.replace_when(F.col("CardName"), ledger.IN_PRODUCTION, F.col("Warehouse"))
    return rows.select("TransNum", "ItemCode", "Price", got.alias("final_client"))


@query
def status_overrides(spark, folder):
    """Cancelled documents, missing statuses and columns that belong to one class."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.expr("CASE WHEN l_tax < 0.03 THEN 'COMPRA CALZADA OV' WHEN l_tax < 0.06 THEN 'COMPRA STOCK' ELSE '' END").alias("cls"),
        F.expr("CASE WHEN l_discount < 0.03 THEN ' ' WHEN l_discount < 0.06 THEN 'Ce' END").alias("status"),
        F.expr("CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_returnflag = 'A' THEN 'N' END").alias("flag"),
    )
    cls = F.col("cls")
    return plain(
        rows.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            fx.override_status(F.col("status"), F.col("flag")).alias("overridden"),
            fx.default_status(F.col("status"), cls, CLASSES.sales).alias("defaulted"),
            fx.class_only(F.col("l_suppkey"), cls).alias("stock_supplier"),
        )
    )


@query
def balance_states(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.expr("CASE WHEN c_mktsegment = 'MACHINERY' THEN ' y ' WHEN c_mktsegment = 'FURNITURE' THEN 'N' END").alias("flag"),
        F.expr("CASE WHEN c_nationkey > 3 THEN c_acctbal END").alias("balance"),
    )
    return plain(
        rows.select(
            "c_custkey",
            fx.balance_status(F.col("flag"), F.col("balance")).alias("order_state"),
            fx.production_status(F.trim("flag"), F.col("balance")).alias("production_state"),
        )
    )


@query
def net_layer_qty(spark, folder):
    used = F.expr("CASE WHEN l_returnflag = 'A' THEN CAST(NULL AS DOUBLE) ELSE l_suppkey / CAST(4 AS DOUBLE) END")
    rows = table(spark, folder, "lineitem")
    return plain(
        rows.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            fx.net_layer_qty(F.col("l_quantity"), used).alias("net_zero"),
            fx.net_layer_qty(F.col("l_quantity"), used, "strict").alias("net_strict"),
        )
    )


@query
def mask_after_cutoff(spark, folder):
    shipped = F.when(F.col("l_tax") > 0, F.col("l_shipdate").cast("date"))
    rows = table(spark, folder, "lineitem")
    return plain(
        rows.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            fx.mask_after(F.col("l_quantity"), shipped, day()).alias("qty"),
            fx.snap_zero(F.col("l_discount") - F.lit(0.05)).alias("residue"),
        )
    )


@query
def age_buckets(spark, folder):
    shipped = F.when(F.col("l_tax") > 0, F.col("l_shipdate").cast("date"))
    years = fx.age_years(shipped, day())
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    return table(spark, folder, "lineitem").select(*keys, years.alias("years"), fx.age_bucket(years).alias("age"))


@query
def cutoff_calendar(spark, folder):
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return plain(days.select("day", *[c.alias(n) for n, c in fx.cutoff_calendar(F.col("day")).items()]))


@query
def inbound_filter_3vl(spark, folder):
    """Live inbound movements; a stock entry whose account is unknown is not one of them."""
    c = F.col
    inbound = receipts.inbound_filter(
        c("kind"), c("day"), c("qty"), {k: c("flag") for k in receipts.INBOUND}, c("memo"), c("produced"), c("item"),
        c("FormatCode"), day(),
    )
    rows = _classified(spark, folder).filter(inbound)
    return rows.select("l_orderkey", "l_linenumber", "item", "kind", "FormatCode", "qty")


@query
def keep_not_in(spark, folder):
    t = erp_tables(spark, folder)
    rows = t["OITM"].join(t["OITB"], "ItmsGrpCod").filter(fx.keep_not_in(F.col("ItmsGrpNam"), report.EXCLUDED_LINES))
    return rows.select("ItemCode", "ItmsGrpNam")


@query
def alive_flags(spark, folder):
    rows = erp_tables(spark, folder)["OPDN"]
    live = rows.filter(fx.alive(F.col("CANCELED"))).select("DocEntry", F.lit("alive").alias("state"))
    return live.unionByName(
        rows.filter(fx.voided_or_missing(F.col("CANCELED"))).select("DocEntry", F.lit("void").alias("state"))
    )


@query
def item_prefix_filter(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_name")
    return rows.filter(fx.item_prefix(F.col("p_name"), ("small", "red")))


@query
def snapshot_pick(spark, folder):
    """Present period and absent period, over a rotation table made from the orders."""
    rows = rotation(spark, folder)
    month = F.lit(CUTOFF).cast("date")
    found = links.snapshot_pick(rows, "period", F.last_day(F.add_months(month, -1)))
    absent = links.snapshot_pick(rows, "period", F.last_day(F.add_months(month, 1200)))
    tagged = [found.withColumn("pick", F.lit("present")), absent.withColumn("pick", F.lit("latest"))]
    return plain(reduce(DataFrame.unionByName, tagged))


@query
def snapshot_pick_by_period(spark, folder):
    """The same picks from rotation snapshots kept by period: each reads one period's files."""
    kept = SnapshotTable(spark, _new_path(spark))
    kept.write(rotation(spark, folder))
    month = CUTOFF.replace(day=1) - dt.timedelta(days=1)
    picks = {"present": kept.pick(month), "latest": kept.pick(dt.date(2100, 1, 31))}
    columns = rotation(spark, folder).columns
    return plain(reduce(DataFrame.unionByName, [p.select(*columns, F.lit(n).alias("pick")) for n, p in picks.items()]))


def rotation(spark: SparkSession, folder: str) -> DataFrame:
    """Rotation category per month end and item, from how often the item was ordered."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", F.last_day(F.col("o_orderdate").cast("date")).alias("period"))
    counted = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("period", "l_partkey")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted.select(
        "period",
        F.concat(F.lit("MPA"), F.col("l_partkey").cast("string")).alias("item_key"),
        F.when(F.col("_n") >= 2, F.lit("ALTA")).otherwise(F.lit("BAJA")).alias("category"),
    )


def master(spark: SparkSession, folder: str) -> DataFrame:
    """Item master: every part has a unique code, small ones under a key that no item has."""
    prefix = F.when(F.col("p_size") > 10, F.lit("MPA")).otherwise(F.lit("MPX"))
    return table(spark, folder, "part").select(
        F.concat(prefix, F.col("p_partkey").cast("string")).alias("item_key"),
        F.concat(F.lit("U-"), F.col("p_brand")).alias("unique_code"),
    )


@query
def header_line_join(spark, folder):
    rows = sales_orders.order_lines(erp_tables(spark, folder))
    return plain(rows.select("so_number", "so_line", "so_item", "so_qty", "so_cancelled", "so_created", "so_due"))


ORDER_LINE = ["so_entry", "so_line"]  # tells rows apart where a chain has no document


def _invoiced(t):
    inv = sales_orders.live_documents(t, "OINV", "INV1", "inv")
    orders = sales_orders.order_lines(t)
    on = [("so_entry", "base_entry"), ("so_line", "base_line")]
    return links.follow(orders, inv, "inv", sales_orders.ORDER, on, by=ORDER_LINE)


@query
def document_chain(spark, folder):
    """Order line to invoice line; cancelled invoice headers leave the quantity without number."""
    rows = _invoiced(erp_tables(spark, folder))
    return plain(rows.select("so_number", "so_line", "so_item", "so_qty", "inv_line", "inv_qty", "inv_number"))


@query
def alternative_link_join(spark, folder):
    t = erp_tables(spark, folder)
    rows = links.alternative_link_join(
        _invoiced(t),
        sales_orders.live_documents(t, "ODLN", "DLN1", "dl"),
        "dl",
        [(sales_orders.ORDER, "so_entry", "so_line"), (sales_orders.INVOICE, "inv_entry", "inv_line")],
        by=ORDER_LINE,
    )
    cols = ["so_number", "so_line", "so_item", "so_qty", "inv_number", "inv_qty", "dl_number", "dl_line", "dl_qty"]
    return plain(rows.select(*cols))


@query
def outer_side_cutoff(spark, folder):
    t = erp_tables(spark, folder)
    dl = sales_orders.live_documents(t, "ODLN", "DLN1", "dl")
    on = [("so_entry", "base_entry"), ("so_line", "base_line")]
    rows = links.follow(sales_orders.order_lines(t), dl, "dl", sales_orders.ORDER, on)
    rows = rows.filter(fx.outer_side_cutoff(F.col("dl_created"), cutoff=day()))
    return plain(rows.select("so_number", "so_line", "so_item", "so_qty", "dl_number", "dl_qty", "dl_created"))


@query
def polymorphic_document(spark, folder):
    t = erp_tables(spark, folder)
    index = links.document_index({k: (t[n], num, c) for k, (n, num, c) in ledger.BY_REFERENCE.items()})
    rows = links.polymorphic_join(t["OINM"].select("TransNum", "ItemCode", "Price", "TransType", "BASE_REF"), index, "TransType", "BASE_REF")
    return rows


@query
def cast_key_join(spark, folder):
    t = erp_tables(spark, folder)
    lines = t["IGN1"].withColumn("_ref", fx.to_key(fx.blank_to_null(F.col("BaseRef"))))
    rows = links.lookup(lines, t["OWOR"], [("_ref", "DocNum")], {"DocNum": "order_no", "Status": "order_status"})
    return plain(rows.select("DocEntry", "LineNum", "ItemCode", "Quantity", "BaseRef", "order_no", "order_status"))


@query
def role_join(spark, folder):
    """Item master in two roles: the component and the product made."""
    t = erp_tables(spark, folder)
    rows = links.document_lines(t["OWOR"], t["WOR1"], "po", {"ItemCode": "main_item", "DocNum": "number"}, {"ItemCode": "item", "LineNum": "line", "PlannedQty": "qty"}, how="inner")
    rows = links.lookup(rows, t["OITM"], [("po_item", "ItemCode")], {"ItemName": "item_name"})
    rows = links.lookup(rows, t["OITM"], [("po_main_item", "ItemCode")], {"ItemName": "main_name"})
    return plain(rows.select("po_number", "po_line", "po_item", "po_qty", "item_name", "po_main_item", "main_name"))


@query
def po_resolution(spark, folder):
    t = erp_tables(spark, folder)
    rows = receipts.po_resolution(t["PDN1"], t, "U_HAK_DETOC", "ItemCode", "BaseEntry")
    return plain(rows.select("DocEntry", "LineNum", "ItemCode", "U_EXM_CARGADOA2", "po_no"))


@query
def semi_join(spark, folder):
    held = stock(spark, folder).filter(F.col("on_hand") > 0)
    rows = layers(spark, folder).join(held.select("item"), "item", "left_semi")
    return plain(rows.select("item", "day", "doc", "line", "qty"))


@query
def lookup_defaults(spark, folder):
    rows = table(spark, folder, "part").select(fx.prefix_key(F.concat(F.lit("A"), F.col("p_partkey").cast("string"))).alias("item_key"), "p_name")
    got = links.lookup(rows, master(spark, folder), [("item_key", "item_key")], {"unique_code": "code"}, unique="check")
    return got.withColumn("code", F.coalesce("code", "item_key"))


@query
def production_balance(spark, folder):
    return plain(production.production_order_balance(erp_tables(spark, folder), CUTOFF))


@query
def production_receipts(spark, folder):
    return plain(production.production_receipts(erp_tables(spark, folder)))


@query
def sales_order_trace(spark, folder):
    return plain(sales_orders.sales_order_trace(erp_tables(spark, folder), CUTOFF))


@query
def sales_order_trace_ignore_late(spark, folder):
    rows = sales_orders.sales_order_trace(erp_tables(spark, folder), CUTOFF, late_docs="ignore")
    return plain(rows.select("so_number", "so_line", "so_item", "so_qty", "dl_number", "dl_qty", "rt_number", "rt_qty", "cn_number", "cn_qty"))


@query
def sales_order_balance(spark, folder):
    return plain(order_balance.order_balance(erp_tables(spark, folder), CUTOFF))


@query
def order_fulfilment(spark, folder):
    return plain(sales_orders.order_fulfilment(erp_tables(spark, folder)))


@query
def sum_by_key(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_suppkey", F.when(F.col("l_tax") > 0, F.col("l_partkey")).alias("item"), F.when(F.col("l_discount") > 0.02, F.col("l_quantity")).alias("qty")
    )
    return aggregates.sum_by_key(rows, ["l_suppkey", "item"], {"qty": F.col("qty")})


@query
def distinct_sum(spark, folder):
    """Order quantity by item after a join that repeats lines."""
    rows = _invoiced(erp_tables(spark, folder))
    return plain(aggregates.distinct_sum(rows, ["so_number", "so_item"], ["so_line"], "so_qty", "qty"))


@query
def distinct_rows(spark, folder):
    return plain(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct())


@query
def class_split_union(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.when(F.col("l_tax") > 0, F.col("l_returnflag")).alias("cls"))
    parts, rest = split_by(rows, "cls", ["A", "R"])
    tagged = [p.withColumn("part", F.lit(v)) for v, p in parts.items()] + [rest.withColumn("part", F.lit("rest"))]
    return plain(reduce(DataFrame.unionByName, tagged))


def _series(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("sales"),
        F.count_distinct("o_custkey").alias("customers"),
    )


@query
def daily_series(spark, folder):
    return plain(_series(spark, folder))


@query
def daily_summary(spark, folder):
    got = daily.daily_summary(_series(spark, folder))
    return got.select(*[F.round(F.col(c).cast("double"), 4).alias(c) for c in got.columns])


@query
def top_days(spark, folder):
    return plain(daily.top_days(_series(spark, folder)))


@query
def latest_period(spark, folder):
    return plain(rotation(spark, folder).agg(F.max("period").alias("period"), F.count_distinct("item_key").alias("items")))


@query
def stage_counts(spark, folder):
    """Rows of each stage of one allocation, counted by the writes; every source is read once."""
    stages = aggregates.Stages()
    rows = stages.write("ledger", moves(spark, folder))
    held = stages.write("stock", _held(rows))
    found = stages.write("layers", _inbound(rows))
    stages.write("allocated", _allocate(found, held, "zero"))
    return stages.counts(spark)


@query
def report_stage_counts(spark, folder):
    """Rows of each stage of one run of the stock origin report."""
    stages = aggregates.Stages()
    _report(spark, folder, "zero", stages)
    return stages.counts(spark)


@query
def movement_ledger(spark, folder):
    return plain(ledger.movement_ledger(erp_tables(spark, folder)))


@query
def inbound_receipts(spark, folder):
    return plain(receipts.inbound_receipts(erp_tables(spark, folder), CUTOFF))


def _erp_stock(t):
    """Movements of the published ledger."""
    return ledger.movement_ledger(t, only=["item", "created", "qty_in", "qty_out"])


def _net_layers(spark, folder, missing):
    t = erp_tables(spark, folder)
    moved = (F.col("qty_in"), F.col("qty_out"))
    held = materialize(windows.stock_at_cutoff(_erp_stock(t), "item", "created", *moved, day()))
    sales = materialize(order_balance.order_balance(t, CUTOFF))
    made = materialize(production.production_order_balance(t, CUTOFF))
    return netting.net_layers(receipts.inbound_receipts(t, CUTOFF), held, sales, made, missing)


@query
def net_layers(spark, folder):
    cols = ["receipt_no", "item", "receipt_class", "qty_in", "final_qty", "so_no", "order_no", "rel_so_no", "rel_so_state", "so_state", "po_state", "so_ordered", "so_balance", "po_planned", "po_balance"]
    return plain(_net_layers(spark, folder, "strict").select(*cols))


def _report(spark, folder, missing, stages=None):
    t = erp_tables(spark, folder)
    return report.stock_origin_report(
        t, _erp_stock(t), master(spark, folder), rotation(spark, folder), CUTOFF, missing, stages=stages
    )


@query
def stock_origin_report(spark, folder):
    return plain(_report(spark, folder, "zero"))


@query
def stock_origin_report_strict(spark, folder):
    return plain(_report(spark, folder, "strict"))


@query
def text_rows(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", F.col("l_shipdate").cast("date").alias("day"), F.when(F.col("l_tax") > 0, F.col("l_returnflag")).alias("flag"))
    return writers.text_rows(rows)


@query
def partner_master(spark, folder):
    return readers.partner_master(erp_tables(spark, folder)["OCRD"])


@query
def as_of_scan(spark, folder):
    rows = readers.as_of_scan(table(spark, folder, "orders"), "o_orderdate", CUTOFF)
    return plain(rows.select("o_orderkey", "o_orderdate"))


@query
def scan_or_empty(spark, folder):
    """A good source, and the same one failing at its last rows, which counts as empty."""
    good = erp_tables(spark, folder)["OCRD"]
    last = good.agg(F.max("CardCode")).first()[0]
    broken = good.withColumn("CardName", F.when(F.col("CardCode") == last, F.raise_error(F.lit("gone"))).otherwise(F.col("CardName")))
    parts = [readers.scan_or_empty(spark, lambda df=df: df, schema("OCRD"), on_error="empty") for df in (good, broken)]
    return parts[0].unionByName(parts[1])


@query
def read_rows(spark, folder):
    text = "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderdate <= :cutoff AND o_orderstatus = :status"
    return readers.read_rows(spark, text, {"cutoff": CUTOFF, "status": "F"}, orders=table(spark, folder, "orders"))


@query
def table_function_scan(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("orders")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION orders_of_status(wanted STRING) "
        "RETURNS TABLE(o_orderkey BIGINT, o_custkey BIGINT) "
        "RETURN SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = wanted"
    )
    return readers.table_function_scan(spark, "orders_of_status", ["P"])


def _new_path(spark):
    return f"{shared_dir(spark)}/out-{uuid.uuid4().hex}"


@query
def item_snapshot(spark, folder):
    """Item master kept as CSV: written, then read with its declared types."""
    rows = master(spark, folder)
    return readers.snapshot(spark, writers.write_csv(rows, _new_path(spark)), rows.schema)


@query
def rotation_snapshot(spark, folder):
    """Rotation categories kept as Parquet."""
    rows, path = rotation(spark, folder), _new_path(spark)
    rows.write.parquet(path)
    return plain(readers.snapshot(spark, path, rows.schema, "parquet"))


@query
def write_tsv(spark, folder):
    """Text files of one cutoff, read back as text."""
    rows = table(spark, folder, "part").select("p_partkey", "p_name", "p_size", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("brand"))
    path = writers.write_tsv(rows, _new_path(spark), CUTOFF)
    return spark.read.option("sep", "\t").option("header", True).csv(path)


@query
def append_table(spark, folder):
    """Two cutoffs in the result table, the first one written twice and a third one taken out again."""
    rows, path = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), _new_path(spark)
    for cutoff, kept in ((CUTOFF, "F"), (dt.date(2000, 2, 1), "O"), (dt.date(2000, 3, 1), "P"), (CUTOFF, "F")):
        writers.append_table(rows.filter(F.col("o_orderstatus") == kept), path, cutoff)
    writers.remove_cutoff(spark, path, dt.date(2000, 3, 1))
    return plain(spark.read.parquet(path).drop("fecha_carga"))


@query
def publish_report(spark, folder):
    """The published report as it stands in the result table."""
    rows, result = _report(spark, folder, "zero"), _new_path(spark)
    report.publish(rows, _new_path(spark), result, CUTOFF)
    got = ResultTable(spark, result).read()
    names = report.REPORT_COLUMNS
    return plain(got.select(*[F.col(f"`{names[f.name]}`").cast(f.dataType).alias(f.name) for f in rows.schema]))


@query
def report_order(spark, folder):
    """Row numbers of the report's rows in their published order: item, newest receipt last."""
    rows = materialize(_report(spark, folder, "zero").select("item", "receipt_no"))
    return windows.number_rows(rows, report.report_order(), "row_no")


@query
def production_receipt_order(spark, folder):
    """Row numbers of the production receipts in their published order: latest posting first, then document number."""
    rows = production.production_receipts(erp_tables(spark, folder)).select("rc_posted", "rc_number", "rc_line", "rc_item")
    order = [F.col("rc_posted").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ("rc_number", "rc_line", "rc_item")]]
    return plain(windows.number_rows(rows, order, "row_no"))


@query
def production_balance_order(spark, folder):
    """Row numbers of the production order balance in its published order: by component, then order number."""
    rows = production.production_order_balance(erp_tables(spark, folder), CUTOFF).select("po_item", "po_number")
    return windows.number_rows(rows, [F.col(c).asc_nulls_last() for c in rows.columns], "row_no")


@query
def versioned_results(spark, folder):
    """Two cutoffs in the versioned result table: one replaced by a rerun, one by an empty rerun, a failed rerun unseen."""
    rows, result = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), ResultTable(spark, _new_path(spark))
    later = dt.date(2000, 2, 1)
    for cutoff, kept in ((CUTOFF, "O"), (later, "F"), (CUTOFF, "P"), (later, "none")):
        result.publish(rows.filter(F.col("o_orderstatus") == kept), cutoff)
    result.publish(rows.filter(F.col("o_orderstatus") == "F"), dt.date(2000, 3, 1))
    broken = rows.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.raise_error(F.lit("gone"))).otherwise("x"))
    try:
        result.publish(broken, CUTOFF)
    except (PySparkException, Py4JJavaError):
        pass
    return plain(result.read().drop("fecha_carga"))


@query
def ledger_order(spark, folder):
    """Row numbers of the day totals of incoming stock, by item and day of posting.

    The order of the ledger's movements is `ledger_movement_order`.
    """
    rows = erp_tables(spark, folder)["OINM"].groupBy("ItemCode", "DocDate").agg(F.sum("InQty").alias("qty_in"))
    order = [F.col("ItemCode").asc_nulls_last(), F.col("DocDate").asc_nulls_last()]
    return plain(windows.number_rows(rows, order, "row_no", distinct_order=True))


@query
def ledger_movement_order(spark, folder):
    """Row numbers of every ledger row in the published order, by day of creation; movement number and item break ties."""
    rows = ledger.movement_ledger(erp_tables(spark, folder), only=["created", "movement_no", "item"])
    rows = materialize(rows)
    order = [F.col(c).asc_nulls_last() for c in rows.columns]
    return plain(windows.number_rows(rows, order, "row_no"))


@query
def trace_order(spark, folder):
    """Row numbers of all rows of the order trace in their published order."""
    keys = ["so_number", "so_line", "dl_number", "rt_number", "cn_number"]
    rows = sales_orders.sales_order_trace(erp_tables(spark, folder), CUTOFF).select(*keys)
    return windows.number_rows(rows, sales_orders.trace_order(), "row_no")
