"""Schemas of the ERP tables the datasets read."""

from __future__ import annotations

from pyspark.sql import types as T

QTY = "decimal(19,6)"

_HEADER = (
    "DocEntry bigint, DocNum bigint, CardCode string, CardName string, DocStatus string, CANCELED string, "
    "CreateDate date, DocDate date, BaseEntry bigint, BaseType int"
)
_LINE = f"DocEntry bigint, LineNum int, BaseType int, BaseEntry bigint, BaseLine int, ItemCode string, Quantity {QTY}"
_STOCK_HEADER = (
    "DocEntry bigint, DocNum bigint, CANCELED string, CreateDate date, DocDate date, Comments string, ObjType int"
)
_STOCK_LINE = (
    f"DocEntry bigint, LineNum int, ItemCode string, Quantity {QTY}, BaseRef string, BaseType int, "
    "BaseEntry bigint, AcctCode string"
)

DDL = {
    "OINM": (
        "ItemCode string, TransNum bigint, TransType string, DocLineNum int, TransSeq bigint, SubLineNum int, "
        "CreatedBy bigint, BASE_REF string, JrnlMemo string, Dscription string, Currency string, "
        f"Rate {QTY}, Price {QTY}, TransValue {QTY}, CreateDate date, DocDate date, DocTime int, "
        f"InQty {QTY}, OutQty {QTY}, Warehouse string, UserSign int, Comments string, CardName string"
    ),
    "OITM": f"ItemCode string, ItemName string, ItmsGrpCod int, AvgPrice {QTY}, U_EXX_CGET string",
    "OITB": "ItmsGrpCod int, ItmsGrpNam string",
    "OCRD": "CardCode string, CardName string",
    "OACT": "AcctCode string, FormatCode string, AcctName string",
    "ORDR": (
        "DocEntry bigint, DocNum bigint, CardCode string, CardName string, DocStatus string, CANCELED string, "
        "CreateDate date, DocDate date, DocDueDate date, GroupNum int"
    ),
    "RDR1": (
        "DocEntry bigint, LineNum int, LineStatus string, ItemCode string, Dscription string, "
        f"Quantity {QTY}"
    ),
    "OINV": _HEADER,
    "INV1": _LINE,
    "ODLN": _HEADER,
    "DLN1": _LINE + f", GrssProfit {QTY}",
    "ORDN": _HEADER,
    "RDN1": _LINE + f", GrssProfit {QTY}",
    "ORIN": _HEADER,
    "RIN1": _LINE + ", DropShip string",
    "OPDN": "DocEntry bigint, DocNum bigint, CANCELED string",
    "PDN1": (
        "DocEntry bigint, LineNum int, ItemCode string, BaseEntry bigint, U_EXM_CARGADOA string, "
        "U_EXM_CARGADOA2 string, FreeTxt string, U_EXM_OF bigint, U_EXM_OV bigint, U_HAK_DETOC bigint"
    ),
    "OPOR": "DocEntry bigint, DocNum bigint",
    "POR1": "DocEntry bigint, ItemCode string, U_HAK_DETOC bigint",
    "HAK_DETOC": "DocEntry bigint, U_HAK_NROOC string",
    "OPCH": "DocEntry bigint, DocNum bigint, CANCELED string",
    "ORPC": "DocNum bigint, CANCELED string",
    "ORPD": "DocNum bigint, CANCELED string",
    "OWTR": "DocNum bigint, CANCELED string",
    "OIPF": "DocNum bigint, Canceled string",
    "OIGN": _STOCK_HEADER,
    "IGN1": _STOCK_LINE,
    "OIGE": _STOCK_HEADER,
    "IGE1": _STOCK_LINE,
    "OWOR": (
        "DocEntry bigint, DocNum bigint, Status string, CardCode string, ItemCode string, OriginNum bigint, "
        f"CreateDate date, PlannedQty {QTY}"
    ),
    "WOR1": f"DocEntry bigint, LineNum int, ItemCode string, PlannedQty {QTY}, IssuedQty {QTY}",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])
