"""ERP tables derived from the order/line-item test tables, for queries and benchmarks.

Each table is one SELECT in SQL that Spark and DuckDB both accept, so the check queries
can start from the same rows.  The choice of columns has no business meaning beyond giving
every rule something to act on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

CUTOFF = dt.date(2000, 1, 1)
SOURCES = ("lineitem", "orders", "part", "customer", "supplier")

# A partner, account or item code that no master table has, so that lookups also miss.
_UNKNOWN_PARTNER = "CASE WHEN {key} % 11 = 0 THEN concat('X', CAST({key} AS STRING)) ELSE concat('C', CAST({key} AS STRING)) END"
_ACCOUNT = "CASE WHEN l_suppkey % 10 = 0 THEN concat('X', CAST(l_suppkey AS STRING)) ELSE concat('S', CAST(l_suppkey AS STRING)) END"

_LINES = "SELECT {cols} FROM lineitem WHERE {where}"


def _lines(where: str, cols: str) -> str:
    return _LINES.format(cols=cols, where=where)


_BASE_LINE = (
    "l_orderkey AS DocEntry, l_linenumber AS LineNum, {kind} AS BaseType, {base} AS BaseEntry, "
    "l_linenumber AS BaseLine, concat('A', CAST(l_partkey AS STRING)) AS ItemCode, l_quantity AS Quantity"
)


def _doc_lines(where: str, kind: str, base: str = "l_orderkey", extra: str = "") -> str:
    return _lines(where, _BASE_LINE.format(kind=kind, base=base) + extra)


def _header(number: int, cancelled: str, day: str = "o_orderdate") -> str:
    return (
        f"SELECT o_orderkey AS DocEntry, o_orderkey + {number} AS DocNum, "
        f"{_UNKNOWN_PARTNER.format(key='o_custkey')} AS CardCode, "
        "concat('Customer ', CAST(o_custkey AS STRING)) AS CardName, "
        "CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'O' END AS DocStatus, "
        f"CASE WHEN {cancelled} THEN 'Y' ELSE 'N' END AS CANCELED, "
        f"CAST({day} AS DATE) AS CreateDate, CAST({day} AS DATE) AS DocDate FROM orders"
    )


_MOVE_TYPE = (
    "CASE (l_orderkey + l_linenumber) % 31 WHEN 0 THEN '13' WHEN 1 THEN '14' WHEN 2 THEN '19' WHEN 3 THEN '21' "
    "WHEN 4 THEN '69' WHEN 5 THEN '162' WHEN 6 THEN '202' WHEN 7 THEN '999' ELSE "
    "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '15' WHEN l_returnflag = 'R' THEN '60' "
    "WHEN l_returnflag = 'N' THEN '20' WHEN l_linestatus = 'O' AND l_tax < 0.03 THEN '18' "
    "WHEN l_linestatus = 'O' AND l_tax < 0.05 THEN '16' WHEN l_linestatus = 'O' AND l_tax < 0.07 THEN '67' "
    "ELSE '59' END END"
)


ERP_SQL = {
    "OINM": (
        "SELECT concat('A', CAST(l_partkey AS STRING)) AS ItemCode, l_orderkey * 10 + l_linenumber AS TransNum, "
        f"{_MOVE_TYPE} AS TransType, l_linenumber AS DocLineNum, l_orderkey AS TransSeq, 0 AS SubLineNum, "
        f"l_orderkey + CASE WHEN {_MOVE_TYPE} = '16' THEN 4000000 ELSE 0 END AS CreatedBy, "
        f"CAST(l_orderkey + CASE {_MOVE_TYPE} WHEN '13' THEN 2000000 WHEN '14' THEN 5000000 ELSE 0 END AS STRING) AS BASE_REF, "
        "CASE WHEN l_discount < 0.04 THEN 'Recibo de produccion' WHEN l_discount < 0.07 THEN 'Receipt from Prod' "
        "ELSE 'Ajuste' END AS JrnlMemo, concat('Part ', CAST(l_partkey AS STRING)) AS Dscription, "
        "'PEN' AS Currency, CAST(1 AS DOUBLE) AS Rate, l_extendedprice AS Price, l_extendedprice AS TransValue, "
        "CAST(l_shipdate AS DATE) AS CreateDate, CAST(l_shipdate AS DATE) AS DocDate, "
        "l_linenumber * 100 + CAST(l_quantity AS INT) AS DocTime, "
        "CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS InQty, "
        "CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE CAST(0 AS DOUBLE) END AS OutQty, "
        "concat('W', CAST(l_suppkey AS STRING)) AS Warehouse, CAST(l_suppkey AS INT) AS UserSign, "
        "CAST(NULL AS STRING) AS Comments, CASE WHEN l_discount < 0.02 THEN "
        "'PRODUCTOS EN FABRICACION (GEN., GEN.)' WHEN l_discount < 0.03 THEN CAST(NULL AS STRING) "
        "ELSE concat('Supplier ', CAST(l_suppkey AS STRING)) END AS CardName FROM lineitem"
    ),
    "OITM": (
        "SELECT concat('A', CAST(p_partkey AS STRING)) AS ItemCode, p_name AS ItemName, p_size AS ItmsGrpCod, "
        "p_retailprice AS AvgPrice, p_brand AS U_EXX_CGET FROM part"
    ),
    "OITB": (
        "SELECT DISTINCT p_size AS ItmsGrpCod, CASE WHEN p_size <= 5 THEN 'HERRAMIENTAS' "
        "WHEN p_size <= 8 THEN CAST(NULL AS STRING) ELSE concat('GRUPO ', CAST(p_size AS STRING)) END "
        "AS ItmsGrpNam FROM part"
    ),
    "OCRD": (
        "SELECT concat('C', CAST(c_custkey AS STRING)) AS CardCode, c_name AS CardName FROM customer"
    ),
    "OACT": (
        "SELECT concat('S', CAST(s_suppkey AS STRING)) AS AcctCode, CASE WHEN s_acctbal < 2000 THEN '20111040000' "
        "WHEN s_acctbal < 4000 THEN '42111090000' ELSE concat('601', CAST(s_suppkey AS STRING)) END AS FormatCode, "
        "CASE WHEN s_acctbal < 8000 THEN concat('Account ', CAST(s_suppkey AS STRING)) "
        "ELSE 'CUENTA DE ORDEN INVENTARIO (GEN., GEN.)' END AS AcctName FROM supplier"
    ),
    "ORDR": (
        "SELECT o_orderkey AS DocEntry, o_orderkey + 1000000 AS DocNum, "
        f"{_UNKNOWN_PARTNER.format(key='o_custkey')} AS CardCode, "
        "concat('Customer ', CAST(o_custkey AS STRING)) AS CardName, "
        "CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'O' END AS DocStatus, "
        "CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS CANCELED, "
        "CAST(o_orderdate AS DATE) AS CreateDate, CAST(o_orderdate AS DATE) AS DocDate, "
        "CAST(o_orderdate + INTERVAL '30' DAY AS DATE) AS DocDueDate, "
        "CAST(substring(o_orderpriority, 1, 1) AS INT) AS GroupNum FROM orders"
    ),
    "RDR1": _lines(
        "true",
        "l_orderkey AS DocEntry, l_linenumber AS LineNum, "
        "CASE WHEN l_linestatus = 'F' THEN 'C' WHEN l_tax = 0 THEN 'X' ELSE 'O' END AS LineStatus, "
        "concat('A', CAST(l_partkey AS STRING)) AS ItemCode, "
        "concat('Part ', CAST(l_partkey AS STRING)) AS Dscription, l_quantity AS Quantity",
    ),
    "OINV": _header(2000000, "o_orderpriority = '5-LOW'"),
    "INV1": _lines(
        "l_tax <= 0.01 OR l_tax >= 0.06",
        _BASE_LINE.format(kind="CASE WHEN l_tax <= 0.01 THEN 17 ELSE 15 END", base="l_orderkey"),
    ),
    "ODLN": _header(3000000, "o_orderpriority = '4-NOT SPECIFIED'", "o_orderdate + INTERVAL '200' DAY")
    .replace(" FROM orders", ", o_orderkey AS BaseEntry, 17 AS BaseType FROM orders"),
    "DLN1": _doc_lines(
        "l_linestatus = 'F'",
        "CASE WHEN l_returnflag = 'A' THEN 13 ELSE 17 END",
        extra=", l_extendedprice AS GrssProfit",
    ),
    "ORDN": _header(4000000, "o_orderpriority = '1-URGENT'", "o_orderdate + INTERVAL '300' DAY")
    .replace(" FROM orders", ", o_orderkey AS BaseEntry, 17 AS BaseType FROM orders"),
    "RDN1": _doc_lines(
        "l_returnflag = 'R'",
        "CASE WHEN l_linestatus = 'F' THEN 15 ELSE 234 END",
        extra=", l_extendedprice AS GrssProfit",
    ),
    "ORIN": _header(5000000, "o_orderpriority = '2-HIGH'", "o_orderdate + INTERVAL '400' DAY"),
    "RIN1": _doc_lines(
        "l_returnflag = 'A'",
        "CASE WHEN l_discount < 0.04 THEN 15 WHEN l_discount < 0.08 THEN 13 ELSE 16 END",
        extra=", CASE WHEN l_tax = 0.08 THEN 'Y' ELSE 'N' END AS DropShip",
    ),
    "OPDN": (
        "SELECT o_orderkey AS DocEntry, o_orderkey AS DocNum, "
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'Y' WHEN o_orderpriority = '1-URGENT' THEN CAST(NULL AS STRING) "
        "ELSE 'N' END AS CANCELED FROM orders"
    ),
    "PDN1": _lines(
        "l_returnflag = 'N'",
        "l_orderkey AS DocEntry, l_linenumber AS LineNum, concat('A', CAST(l_partkey AS STRING)) AS ItemCode, "
        "CASE WHEN l_discount >= 0.03 THEN l_orderkey END AS BaseEntry, "
        "CASE WHEN l_tax = 0 THEN 'GA' WHEN l_tax = 0.01 THEN 'G' WHEN l_tax = 0.02 THEN 'OF' "
        "WHEN l_tax = 0.03 THEN 'OV' WHEN l_tax = 0.04 THEN 'OS' WHEN l_tax = 0.05 THEN 'ST' END AS U_EXM_CARGADOA, "
        "concat('T', CAST(l_suppkey AS STRING)) AS U_EXM_CARGADOA2, l_linestatus AS FreeTxt, "
        "CASE WHEN l_tax = 0.02 AND l_discount >= 0.02 OR l_tax = 0.06 THEN l_orderkey END AS U_EXM_OF, "
        "CASE WHEN l_tax = 0.03 AND l_discount >= 0.02 OR l_tax = 0.07 THEN l_orderkey END AS U_EXM_OV, "
        "CASE WHEN l_discount < 0.07 THEN l_suppkey END AS U_HAK_DETOC",
    ),
    "OPOR": "SELECT o_orderkey AS DocEntry, o_orderkey + 6000000 AS DocNum FROM orders",
    "POR1": _lines(
        "l_linestatus = 'O' AND l_returnflag = 'N'",
        "l_orderkey AS DocEntry, concat('A', CAST(l_partkey AS STRING)) AS ItemCode, "
        "CASE WHEN l_discount < 0.04 THEN l_suppkey END AS U_HAK_DETOC",
    ),
    "HAK_DETOC": "SELECT s_suppkey AS DocEntry, concat('OC-', CAST(s_suppkey AS STRING)) AS U_HAK_NROOC FROM supplier",
    "OPCH": (
        "SELECT o_orderkey AS DocEntry, o_orderkey AS DocNum, "
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Y' ELSE 'N' END AS CANCELED FROM orders"
    ),
    "ORPC": "SELECT o_orderkey AS DocNum, 'N' AS CANCELED FROM orders WHERE o_orderstatus = 'F'",
    "ORPD": "SELECT o_orderkey AS DocNum, 'N' AS CANCELED FROM orders WHERE o_orderstatus = 'O'",
    "OWTR": (
        "SELECT o_orderkey AS DocNum, CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS CANCELED FROM orders"
    ),
    "OIPF": "SELECT o_orderkey AS DocNum, 'N' AS Canceled FROM orders WHERE o_orderstatus = 'P'",
    "OIGN": (
        "SELECT o_orderkey AS DocEntry, o_orderkey AS DocNum, "
        "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Y' ELSE 'N' END AS CANCELED, "
        "CAST(o_orderdate AS DATE) AS CreateDate, CAST(o_orderdate AS DATE) AS DocDate, "
        "o_orderpriority AS Comments, CASE WHEN o_orderstatus = 'P' THEN 60 ELSE 59 END AS ObjType FROM orders"
    ),
    "IGN1": _lines(
        "l_returnflag = 'A'",
        "l_orderkey AS DocEntry, l_linenumber AS LineNum, concat('A', CAST(l_partkey AS STRING)) AS ItemCode, "
        "l_quantity AS Quantity, CASE WHEN l_discount >= 0.09 THEN '' ELSE CAST(l_orderkey + 7000000 AS STRING) END "
        "AS BaseRef, CASE WHEN l_tax <= 0.05 THEN 202 ELSE 0 END AS BaseType, l_orderkey AS BaseEntry, "
        f"{_ACCOUNT} AS AcctCode",
    ),
    "OIGE": (
        "SELECT o_orderkey AS DocEntry, o_orderkey AS DocNum, "
        "CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS CANCELED, "
        "CAST(o_orderdate AS DATE) AS CreateDate, CAST(o_orderdate AS DATE) AS DocDate, "
        "o_orderpriority AS Comments, 60 AS ObjType FROM orders"
    ),
    "IGE1": _lines(
        "l_returnflag <> 'A'",
        "l_orderkey AS DocEntry, l_linenumber AS LineNum, concat('A', CAST(l_partkey AS STRING)) AS ItemCode, "
        "l_quantity AS Quantity, CASE WHEN l_discount >= 0.09 THEN '' ELSE CAST(l_orderkey + 7000000 AS STRING) END "
        "AS BaseRef, CASE WHEN l_tax <= 0.05 THEN 202 ELSE 0 END AS BaseType, l_orderkey AS BaseEntry, "
        f"{_ACCOUNT} AS AcctCode",
    ),
    "OWOR": (
        "SELECT orders.o_orderkey AS DocEntry, orders.o_orderkey + 7000000 AS DocNum, "
        "CASE orders.o_orderstatus WHEN 'P' THEN 'C' WHEN 'F' THEN 'L' ELSE 'R' END AS Status, "
        f"{_UNKNOWN_PARTNER.format(key='orders.o_custkey')} AS CardCode, "
        "CASE WHEN orders.o_orderpriority = '1-URGENT' THEN made.ItemCode "
        "WHEN orders.o_orderpriority = '2-HIGH' THEN concat('A9', CAST(orders.o_custkey AS STRING)) "
        "ELSE concat('S', CAST(orders.o_custkey AS STRING)) END AS ItemCode, "
        "CASE WHEN orders.o_orderstatus <> 'F' THEN orders.o_orderkey + 1000000 END AS OriginNum, "
        "CAST(orders.o_orderdate AS DATE) AS CreateDate, orders.o_totalprice AS PlannedQty "
        "FROM orders LEFT JOIN (SELECT l_orderkey, concat('A', CAST(min(l_partkey) AS STRING)) AS ItemCode "
        "FROM lineitem GROUP BY l_orderkey) made ON made.l_orderkey = orders.o_orderkey"
    ),
    "WOR1": _lines(
        "l_returnflag <> 'R'",
        "l_orderkey AS DocEntry, l_linenumber AS LineNum, concat('A', CAST(l_partkey AS STRING)) AS ItemCode, "
        "l_quantity AS PlannedQty, CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE CAST(0 AS DOUBLE) END AS IssuedQty",
    ),
}


def source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in SOURCES}


class ErpTables(Mapping[str, DataFrame]):
    """The ERP tables over the Parquet files in a folder, each analysed when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._built = spark, {}
        for name, df in source_tables(spark, folder).items():
            df.createOrReplaceTempView(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._spark.sql(ERP_SQL[name])
        return self._built[name]

    def __iter__(self):
        return iter(ERP_SQL)

    def __len__(self) -> int:
        return len(ERP_SQL)


def erp_tables(spark: SparkSession, folder: str) -> ErpTables:
    return ErpTables(spark, folder)


def erp_ctes(*names: str) -> str:
    """The named tables as SQL common table expressions."""
    return ",\n".join(f"{name} AS ({ERP_SQL[name]})" for name in names)
