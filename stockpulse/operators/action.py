"""Supply action (A1-A7) -> view 5."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions import norm_key, to_decimal_or_zero, try_date
from stockpulse.operators.overlay import V4_COLUMNS
from stockpulse.operators.quarantine import VIEW_LEVEL
from stockpulse.params import Params

# FIXED VALUES: recommendation labels
SUFFICIENT = "SUFFICIENT"
ORDER = "ORDER"
BOTH = "BOTH"
REVIEW = "REVIEW_REQUIRED"


def balance_analysis(v4: DataFrame, p: Params) -> DataFrame:
    """A1-A3: deficit, open PO quantity, effective demand date."""
    ext = F.coalesce(F.col("Ledger_Extended_Balance"), F.lit(0))
    net = F.coalesce(F.col("Net_Demand"), F.lit(0))
    return v4.withColumns({
        "Deficit_Qty": F.when(ext >= net, F.lit(0)).otherwise(net - ext),
        "POs_On_Order_Qty": to_decimal_or_zero(F.col("POs"), 18, 6),
        "Demand_Due_Date": F.coalesce(F.col("DUEDATE"),
                                      try_date(F.col("Date_Expiry"), p.date_formats)),
    })


def turnaround(pipe: DataFrame, p: Params) -> DataFrame:
    """A4: days from today to each quarantine row's release (0 when past)."""
    rel = F.col("Estimated_Release_Date")
    today_ts = F.lit(dt.datetime.combine(p.today, dt.time()).strftime("%Y-%m-%d %H:%M:%S")) \
        .cast("timestamp_ntz")
    return pipe.where(F.col("View_Level") == VIEW_LEVEL).select(
        F.col("Item_Number").alias("ITEMNMBR"), "Estimated_Release_Date",
        F.when(rel.isNotNull() & (rel >= today_ts), F.datediff(F.to_date(rel), F.lit(p.today)))
         .otherwise(0).alias("PO_Turn_Around_Days"),
        rel.alias("PO_Actual_Arrival_Date"))


def po_timing(df: DataFrame, turn: DataFrame, p: Params) -> DataFrame:
    """A5: left join by item only, so each ledger row repeats once per
    quarantine row of its item (T15), or meets the item's earliest release
    with ``dedupe_timing``."""
    ci = p.case_insensitive
    if p.dedupe_timing:
        turn = turn.groupBy(norm_key(F.col("ITEMNMBR"), ci).alias("ITEMNMBR")).agg(
            F.min("Estimated_Release_Date").alias("Estimated_Release_Date"),
            F.min("PO_Turn_Around_Days").alias("PO_Turn_Around_Days"),
            F.min("PO_Actual_Arrival_Date").alias("PO_Actual_Arrival_Date"))
    t = turn.select(norm_key(F.col("ITEMNMBR"), ci).alias("_t_item"),
                    F.col("Estimated_Release_Date").alias("PO_Release_Date"),
                    "PO_Turn_Around_Days", "PO_Actual_Arrival_Date")
    j = df.join(t, norm_key(df.ITEMNMBR, ci) == t._t_item, "left").drop("_t_item")
    arr, due = F.col("PO_Actual_Arrival_Date"), F.col("Demand_Due_Date")
    return j.withColumns({
        "PO_On_Time": F.when(arr.isNotNull() & due.isNotNull()
                             & (arr <= due.cast("timestamp_ntz")), 1).otherwise(0),
        "Is_Past_Due_In_Backlog": F.when(due.isNotNull() & (due < F.lit(p.today)), 1).otherwise(0),
    })


def timing_copies(turn: DataFrame, p: Params) -> DataFrame:
    """How often A5 repeats a ledger row: once per quarantine row of its item."""
    copies = F.lit(1).cast("bigint") if p.dedupe_timing else F.count(F.lit(1))
    return turn.groupBy(norm_key(F.col("ITEMNMBR"), p.case_insensitive).alias("_t_item")).agg(copies.alias("Copies"))


def recommend(df: DataFrame) -> DataFrame:
    """A6 + A7: first matching rule wins."""
    ext = F.coalesce(F.col("Ledger_Extended_Balance"), F.lit(0))
    net = F.coalesce(F.col("Net_Demand"), F.lit(0))
    d, po, on_time = F.col("Deficit_Qty"), F.col("POs_On_Order_Qty"), F.col("PO_On_Time")
    rec = (F.when(ext >= net, SUFFICIENT)
            .when((d > 0) & (po == 0), ORDER)
            .when((d > 0) & (po >= d) & (on_time == 0), ORDER)
            .when((d > 0) & (po >= d) & (on_time == 1), SUFFICIENT)
            .when((d > 0) & (po > 0) & (po < d), BOTH)
            .otherwise(REVIEW))
    return df.withColumns({
        "Supply_Action_Recommendation": rec,
        "Additional_Order_Qty": F.when((d > 0) & (po < d), d - po).otherwise(F.lit(0)),
    })


V5_COLUMNS = V4_COLUMNS + ["Deficit_Qty", "POs_On_Order_Qty", "Demand_Due_Date",
                           "PO_Release_Date", "PO_Turn_Around_Days", "PO_Actual_Arrival_Date",
                           "PO_On_Time", "Is_Past_Due_In_Backlog",
                           "Supply_Action_Recommendation", "Additional_Order_Qty"]


#: What the actions are decided by.
ACTION_INPUTS = ("ITEMNMBR", "DUEDATE", "Date_Expiry", "POs", "Net_Demand", "Ledger_Extended_Balance")


def actions(v4: DataFrame, pipe: DataFrame, p: Params) -> DataFrame:
    """A1-A7 on view 4, or on those of its columns that hold ``ACTION_INPUTS``."""
    return recommend(po_timing(balance_analysis(v4, p), turnaround(pipe, p), p))


def supply_action(v4: DataFrame, pipe: DataFrame, p: Params) -> DataFrame:
    """V5: 45 columns."""
    return actions(v4, pipe, p).select(*V5_COLUMNS)
