"""Safety stock (K1-K7) -> the safety-stock table (VS).

Decimal arithmetic as the source engine does it: averages and ratios are
decimal(38,6) (exact half-up), lead/7 is a decimal quotient truncated at 6
places, products are rounded back to 6 places before the final ROUND.  The
float steps of the source (purchasing-UOM quantity) stay float.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stockpulse.functions import (
    group_by_keys,
    norm_key,
    not_like_prefix,
    ratio_half_up,
    str_eq,
    trunc_ratio,
    ts_lit,
    us_week,
)
from stockpulse.params import Params

# FIXED VALUES: lead days by item series, first match wins; default 45.
LEAD_DAYS_BY_SERIES = (("30.", 100), ("10.", 60))
LEAD_DAYS_DEFAULT = 45
EXCLUDED_COST_SERIES = "20."
UNTRACKED = "None"


def avg_receipt_cost(receipts: DataFrame, receipt_lines: DataFrame, p: Params) -> DataFrame:
    """K1: quantity-weighted receipt cost per (item, description, UOM).

    The source's LEFT JOIN is filtered on ``SERLTNUM IS NOT NULL``, so it is an
    inner join; the filter is applied to the line side before joining.
    """
    ci = p.case_insensitive
    r = receipts.where((F.col("Created_Date") > ts_lit(p.receipts_since))
                       & ~str_eq(F.col("Item_Tracking_Option"), UNTRACKED, ci)
                       & not_like_prefix(F.col("Item_Number"), EXCLUDED_COST_SERIES, ci))
    pl = receipt_lines.where(F.col("SERLTNUM").isNotNull()).select(
        F.col("RCPTLNNM").alias("_ln"), norm_key(F.col("ITEMNMBR"), ci).alias("_it"),
        norm_key(F.col("POPRCTNM"), ci).alias("_rn"), "UNITCOST")
    j = r.join(pl, (r.Receipt_Line_Number == pl._ln)
               & (norm_key(r.Item_Number, ci) == pl._it)
               & (norm_key(r.POP_Receipt_Number, ci) == pl._rn))
    g = group_by_keys(j, {c: F.col(c) for c in ("Item_Number", "Item_Description", "U_Of_M")}, [],
                      [F.sum("QTY_Shipped").alias("TotalQtyShipped"),
                       F.sum(F.col("UNITCOST") * F.col("QTY_Shipped")).alias("TotalCost")], ci)
    avg = F.when(F.col("TotalQtyShipped") > 0,
                 ratio_half_up("TotalCost", "TotalQtyShipped", 6)).otherwise(F.lit(0))
    return g.withColumn("AverageCost", avg.cast(DecimalType(38, 6)))


def weekly_demand(consumption: DataFrame, p: Params) -> DataFrame:
    """K2: consumption per (component, US week, year, UoM) in the chosen years."""
    years = sorted(p.demand_years)
    cond = F.year("IssueDate").isin(years)
    if years == list(range(years[0], years[-1] + 1)):  # contiguous: add a pushable range
        cond = cond & (F.col("IssueDate") >= ts_lit(dt.datetime(years[0], 1, 1))) \
            & (F.col("IssueDate") < ts_lit(dt.datetime(years[-1] + 1, 1, 1)))
    used = consumption.where(cond).withColumns({"WeekNum": us_week(F.col("IssueDate")),
                                                "YearNum": F.year("IssueDate")})
    return group_by_keys(used, {"Component": F.col("Component"), "UoM": F.col("UoM")},
                         ["WeekNum", "YearNum"], [F.sum("IssueQty").alias("WeeklyDemand")],
                         p.case_insensitive)


def demand_stats(weekly: DataFrame, p: Params) -> DataFrame:
    """K3: AVG (scale 6), sample STDEV, MAX and SUM of weekly demand per (component, UoM)."""
    g = group_by_keys(
        weekly, {"Component": F.col("Component"), "UoM": F.col("UoM")}, [],
        [F.count(F.col("WeeklyDemand")).alias("_n"),
         F.stddev_samp(F.col("WeeklyDemand").cast("double")).alias("StdDevWeekly"),
         F.max("WeeklyDemand").alias("MaxWeeklyDemand"),
         F.sum("WeeklyDemand").alias("TotalDemand")], p.case_insensitive)
    avg = ratio_half_up("TotalDemand", "_n", 6).cast(DecimalType(38, 6))
    return g.select("Component", "UoM", avg.alias("AvgWeeklyDemand"), "StdDevWeekly",
                    "MaxWeeklyDemand", "TotalDemand")


def lead_days(item: Column, ci: bool = True) -> Column:
    """K4: lead days by item series."""
    out = None
    for prefix, days in LEAD_DAYS_BY_SERIES:
        cond = ~not_like_prefix(item, prefix, ci)
        out = F.when(cond, days) if out is None else out.when(cond, days)
    return out.otherwise(LEAD_DAYS_DEFAULT)


def safety_stock(df: DataFrame) -> DataFrame:
    """K5 + K6 on a frame holding LeadDays, demand stats and cost columns.

    raw    = round6(2 * (max - avg) * trunc6(lead / 7))
    SS     = ROUND(raw, 0);  SSValue = ROUND(round6(raw * avg cost), 2)
    PURUOM = ROUND(total demand / total shipped, 2);  SS(purch) = CEILING(float SS / PURUOM)
    """
    d18 = DecimalType(18, 6)
    spread = ((F.col("MaxWeeklyDemand") - F.col("AvgWeeklyDemand")) * 2).cast(d18)
    factor = trunc_ratio("LeadDays", 7, 6).cast(DecimalType(12, 6))
    raw = F.round(spread * factor, 6).cast(d18)
    return (df.withColumn("_raw", raw)
              .withColumn("CalculatedSS_MfgUOM", F.round(F.col("_raw"), 0))
              .withColumn("SSValue", F.round(F.round(F.col("_raw") * F.col("AverageCost").cast(d18), 6), 2))
              .withColumn("PURUOM", ratio_half_up("TotalDemand", "TotalQtyShipped", 2).cast("double"))
              .withColumn("CalculatedSS_PurchasingUOM",
                          F.ceil(F.col("CalculatedSS_MfgUOM").cast("double")
                                 / F.nullif(F.col("PURUOM"), F.lit(0.0))).cast("double"))
              .drop("_raw"))


def ss_master_filter(ss_items: DataFrame, p: Params) -> DataFrame:
    """K7 (first half): vendor item present, no '**', included in MRP."""
    ci = p.case_insensitive
    vi = F.col("VendorItem")
    return ss_items.where(vi.isNotNull() & (F.rtrim(vi) != "")
                          & str_eq(F.col("INCLUDE_MRP"), "YES", ci) & ~vi.contains("**"))


SS_COLUMNS = ["ITEMNMBR", "VendorItem", "PRIME_VNDR", "LeadDays", "TotalQtyShipped",
              "PurchasingUOM", "TotalCost", "AverageCost", "AvgWeeklyDemand", "StdDevWeekly",
              "MaxWeeklyDemand", "MfgUOM", "CalculatedSS_MfgUOM", "SSValue", "PURUOM",
              "CalculatedSS_PurchasingUOM"]


def safety_stock_calc(ss_items: DataFrame, receipts: DataFrame, receipt_lines: DataFrame,
                      consumption: DataFrame, p: Params) -> DataFrame:
    """VS: master ⋈ receipt cost ⟕ demand stats, K4-K7; 16 columns.

    ``SSValue <= cap`` drops NULL values, so items without demand stats drop.
    """
    ci = p.case_insensitive
    ac = avg_receipt_cost(receipts, receipt_lines, p)
    ds = demand_stats(weekly_demand(consumption, p), p)
    ss = ss_master_filter(ss_items, p)
    j = (ss.join(ac, norm_key(ss.ITEMNMBR, ci) == norm_key(ac.Item_Number, ci))
           .join(ds, norm_key(ss.ITEMNMBR, ci) == norm_key(ds.Component, ci), "left")
           .withColumn("LeadDays", lead_days(F.col("ITEMNMBR"), ci))
           .withColumnRenamed("U_Of_M", "PurchasingUOM")
           .withColumnRenamed("UoM", "MfgUOM"))
    return safety_stock(j).where(F.col("SSValue") <= p.ss_value_cap).select(*SS_COLUMNS)
