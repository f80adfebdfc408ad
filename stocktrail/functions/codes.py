"""Document codes, purchase classes and status rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Movement type code and its published label.
MOVEMENT_LABELS = {
    "13": "Factura de Clientes",
    "14": "NC de Clientes",
    "15": "Entrega",
    "16": "Devolucion de Venta",
    "18": "Factura de  Proveedores",
    "19": "NC de Proveedores",
    "20": "Entrada por Compra",
    "21": "Devolucion por Compra",
    "59": "Entrada por Inventario",
    "60": "Salida por Inventario",
    "67": "Transferencia por Inventario",
    "69": "Precio de Entrega",
    "162": "revalorizacion de Inventario",
    "202": "Orden de Produccion",
}
# Labels used for inbound receipts.
RECEIPT_LABELS = {
    "18": "Factura de Proveedores",
    "20": "Entrada por Compra",
    "59": "Entrada por Inventario",
}
UNKNOWN_LABEL = "Revisar"
# Line status code and label.
LINE_STATUS = {"O": "Abierto", "C": "Cerrado"}


@dataclass(frozen=True)
class ReceiptClasses:
    """Purchase-class names and the accounts and memos that lead to them (fixed values)."""

    expense: str = "COMPRA CALZADA GASTO"
    warranty: str = "COMPRA CALZADA GARANTIA"
    production: str = "COMPRA CALZADA OF"
    sales: str = "COMPRA CALZADA OV"
    stock: str = "COMPRA STOCK"
    assembly: str = "SETTING"
    returned: str = "DEVOLUCION OF"
    migrated: str = "MIGRACION DE SISTEMA GET A SAP"
    assembly_account: str = "20111040000"
    excluded_account: str = "42111090000"
    migration_account: str = "CUENTA DE ORDEN INVENTARIO (GEN., GEN.)"
    memo_patterns: tuple[str, ...] = ("Recibo de prod%", "Receipt % Prod%")
    finished_prefix: str = "A"


CLASSES = ReceiptClasses()


def _labels(c: Column, table: dict[str, str], default: str) -> Column:
    out = None
    for code, label in table.items():
        hit = c == F.lit(code)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def movement_label(kind: Column, table: dict[str, str] | None = None) -> Column:
    return _labels(kind, table or MOVEMENT_LABELS, UNKNOWN_LABEL)


def line_status(code: Column) -> Column:
    return _labels(code, LINE_STATUS, "")


def status_by_type(kind: Column, flags: dict[str, Column]) -> Column:
    """Cancelled flag of the document that matches the movement type, else empty text."""
    out = None
    for code, flag in flags.items():
        hit = kind == F.lit(code)
        out = F.when(hit, flag) if out is None else out.when(hit, flag)
    return out.otherwise(F.lit(""))


def production_memo(memo: Column, classes: ReceiptClasses = CLASSES) -> Column:
    first, *rest = classes.memo_patterns
    hit = memo.like(first)
    for pattern in rest:
        hit = hit | memo.like(pattern)
    return hit


def classify_receipt(
    *,
    kind: Column,
    charge: Column,
    production_order: Column,
    sales_order: Column,
    memo: Column,
    produced_item: Column,
    item: Column,
    account: Column,
    account_name: Column,
    classes: ReceiptClasses = CLASSES,
) -> Column:
    """Purchase class of a receipt; the first rule that holds wins."""
    goods, invoice, entry = (kind == F.lit(k) for k in ("20", "18", "59"))
    from_production = entry & production_memo(memo, classes)
    on_assembly = account == F.lit(classes.assembly_account)
    rules = [
        (goods & (charge == "GA"), F.lit(classes.expense)),
        (goods & (charge == "G"), F.lit(classes.warranty)),
        (goods & ((charge == "OF") | production_order.isNotNull()), F.lit(classes.production)),
        (goods & (charge.isin("OV", "OS") | sales_order.isNotNull()), F.lit(classes.sales)),
        (goods & ((charge == "ST") | charge.isNull()), F.lit(classes.stock)),
        (invoice, F.lit(classes.stock)),
        (from_production & produced_item.startswith(classes.finished_prefix), F.lit(classes.assembly)),
        (from_production & (produced_item == item), F.lit(classes.returned)),
        (entry & on_assembly, F.lit(classes.assembly)),
        (goods & (account_name == F.lit(classes.migration_account)), F.lit(classes.migrated)),
        (entry & ~on_assembly, account_name),
    ]
    out = F.when(*rules[0])
    for rule in rules[1:]:
        out = out.when(*rule)
    return out.otherwise(F.lit(""))


def override_status(status: Column, flag: Column, marker: str = "Y") -> Column:
    """``C`` when the linked document carries the marker."""
    return F.when(flag == F.lit(marker), F.lit("C")).otherwise(status)


def default_status(status: Column, cls: Column, wanted: str) -> Column:
    """``A`` for rows of class ``wanted`` that have no status."""
    blank = status.isNull() | (F.trim(status) == "")
    return F.when((cls == F.lit(wanted)) & blank, F.lit("A")).otherwise(status)


def class_only(c: Column, cls: Column, wanted: str = CLASSES.stock) -> Column:
    return F.when(cls == F.lit(wanted), c)


def balance_status(cancelled: Column, balance: Column) -> Column:
    """Sales order line: cancelled ``C``, nothing open ``Ce``, else ``A`` (also when unknown)."""
    return (
        F.when(F.upper(F.trim(cancelled)) == "Y", F.lit("C"))
        .when(balance <= 0, F.lit("Ce"))
        .otherwise(F.lit("A"))
    )


def production_status(status: Column, balance: Column) -> Column:
    """Production order component: cancelled ``C``, something open ``A``, else ``Ce``."""
    return F.when(status == "C", F.lit("C")).when(balance > 0, F.lit("A")).otherwise(F.lit("Ce"))
