"""Explicit schemas of the twelve source tables (types inferred from use).

Logical table names are our own; the column names are the ERP's.  Column
names with blanks or quotes are normalised (``Date + Expiry`` ->
``Date_Expiry``, ``PO's`` -> ``POs``, ``FG Desc`` -> ``FG_Desc``).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S = StringType()
D = DateType()
TS = TimestampNTZType()
Q = DecimalType(19, 5)  # quantity / cost columns
I = IntegerType()


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


# planning rows: demand lines, PO text and one 'Beg Bal' row per item
PLANNING = _schema(
    ("ORDERNUMBER", S), ("ITEMNMBR", S), ("STSDESCR", S), ("DUEDATE", D),
    ("Expiry_Dates", S), ("Date_Expiry", S), ("Deductions", S), ("BEG_BAL", S),
    ("Expiry", S), ("POs", S), ("Running_Balance", S), ("MRPTYPE", S),
    ("VendorItem", S), ("PRIME_VNDR", S), ("PURCHASING_LT", S), ("PLANNING_LT", S),
    ("ORDER_POINT_QTY", S), ("SAFETY_STOCK", S),
)
FG_ORDERS = _schema(("ORDERNUMBER", S), ("FG", S), ("Customer", S), ("FG_Desc", S))
VENDOR_ITEMS = _schema(("Item_Number", S), ("ITEMDESC", S), ("UOMSCHDL", S), ("Active", S))
MO_ISSUES = _schema(
    ("MANUFACTUREORDER_I", S), ("ITEMNMBR", S), ("WCID_I", S), ("MRPISSUEDATE_I", TS),
    ("QTY_ISSUED_I", Q), ("QTY_BACKFLUSHED_I", Q), ("MRPAMOUNT_I", Q), ("ATYALLOC", Q),
)
MO_STATUS = _schema(("MANUFACTUREORDER_I", S), ("MANUFACTUREORDERST_I", I))
ITEM_MASTER = _schema(("ITEMNMBR", S), ("UOMSCHDL", S))
LOTS = _schema(
    ("ITEMNMBR", S), ("LOCNCODE", S), ("LOTNUMBR", S), ("EXPNDATE", TS),
    ("DATERECD", TS), ("QTYRECVD", Q), ("QTYSOLD", Q),
)
BIN_STOCK = _schema(("Item_Number", S), ("SITE", S), ("QTY_Available", Q), ("DATERECD", TS))
SS_ITEMS = _schema(("ITEMNMBR", S), ("VendorItem", S), ("PRIME_VNDR", S), ("INCLUDE_MRP", S))
RECEIPTS = _schema(
    ("Item_Number", S), ("Item_Description", S), ("U_Of_M", S), ("Item_Tracking_Option", S),
    ("POP_Receipt_Number", S), ("QTY_Shipped", Q), ("Receipt_Line_Number", I),
    ("Created_Date", TS),
)
RECEIPT_LINES = _schema(
    ("POPRCTNM", S), ("RCPTLNNM", I), ("ITEMNMBR", S), ("SERLTNUM", S),
    ("UNITCOST", Q), ("PRIME_VNDR", S),
)
CONSUMPTION = _schema(("Component", S), ("UoM", S), ("IssueDate", TS), ("IssueQty", Q))

SOURCE_SCHEMAS: dict[str, StructType] = {
    "planning": PLANNING,
    "fg_orders": FG_ORDERS,
    "vendor_items": VENDOR_ITEMS,
    "mo_issues": MO_ISSUES,
    "mo_status": MO_STATUS,
    "item_master": ITEM_MASTER,
    "lots": LOTS,
    "bin_stock": BIN_STOCK,
    "ss_items": SS_ITEMS,
    "receipts": RECEIPTS,
    "receipt_lines": RECEIPT_LINES,
    "consumption": CONSUMPTION,
}
