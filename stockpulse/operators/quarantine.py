"""Quarantine supply (Q1-Q3) -> view 3, the lot-level quarantine pipe."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions import group_by_keys, norm_key, ts_lit
from stockpulse.params import Params

# FIXED VALUES
VIEW_LEVEL = "ITEM_LEVEL"


def _midnight(d: dt.date) -> dt.datetime:
    return dt.datetime.combine(d, dt.time())


def quarantine_lots(lots: DataFrame, p: Params) -> DataFrame:
    """Q1: lots at a quarantine site, on-hand != 0, received <= N days ago.

    ``DATEDIFF(day, DATERECD, now) <= N`` is written as a range on the raw
    column so the predicate reaches the Parquet scan.
    """
    ci = p.case_insensitive
    sites = [s.upper() if ci else s for s in p.lot_sites]
    since = ts_lit(_midnight(p.today - dt.timedelta(days=p.lot_window_days)))
    return lots.where((F.col("QTYRECVD") - F.col("QTYSOLD") != 0)
                      & (F.col("DATERECD") >= since)
                      & norm_key(F.trim(F.col("LOCNCODE")), ci).isin(sites))


def lot_on_hand(lots: DataFrame, item_master: DataFrame, p: Params) -> DataFrame:
    """Q3: SUM(received - sold) per item / site / lot / expiry / UOM / receipt date.

    The item master join is on the untrimmed item number, as the source does.
    Text keys group as they compare (``group_by_keys``).
    """
    ci = p.case_insensitive
    im = item_master.select(norm_key(F.col("ITEMNMBR"), ci).alias("_im_key"),
                            F.trim(F.col("UOMSCHDL")).alias("UOM"))
    j = lots.join(im, norm_key(lots.ITEMNMBR, ci) == im._im_key, "left")
    return group_by_keys(
        j, {"Item_Number": F.trim("ITEMNMBR"), "SITE": F.trim("LOCNCODE"),
            "LOT_Number": F.trim("LOTNUMBR"), "UOM": F.col("UOM")}, ["EXPNDATE", "DATERECD"],
        [F.sum(F.col("QTYRECVD") - F.col("QTYSOLD")).alias("QTY_ON_HAND")], ci)


def lot_enrich(df: DataFrame, p: Params) -> DataFrame:
    """Q2: series, SOP days, lot age, estimated release (now + SOP days,
    keeping the time of day), valid expiration (computed, never filtered on)."""
    asof = ts_lit(p.as_of)
    series = F.left(F.col("Item_Number"), F.lit(2))
    sop = F.when(series == "10", p.sop_days_series_10).otherwise(p.sop_days_default)
    return df.select(
        F.lit(VIEW_LEVEL).alias("View_Level"), "Item_Number", "SITE", "LOT_Number", "EXPNDATE",
        "UOM", "QTY_ON_HAND", series.alias("Series"), sop.alias("SOP_Target_Days"),
        F.datediff(F.lit(p.today), F.to_date("DATERECD")).alias("Lot_Age_Days"),
        F.timestamp_add("DAY", sop, asof).alias("Estimated_Release_Date"),
        F.when(F.col("EXPNDATE") > F.timestamp_add("DAY", F.lit(p.valid_expiry_days), asof), 1)
         .otherwise(0).alias("Valid_Expiration"),
    )


def quarantine_pipe(lots: DataFrame, item_master: DataFrame, p: Params) -> DataFrame:
    """V3: 12 columns, one row per quarantine lot group."""
    return lot_enrich(lot_on_hand(quarantine_lots(lots, p), item_master, p), p)
