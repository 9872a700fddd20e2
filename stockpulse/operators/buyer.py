"""Buyer control (B1-B11) -> view 7.

Rewrite R4: the source joins every deficit row to the whole extended ledger
on (item, vendor) and to safety stock before grouping, so SUM(deficit) is
multiplied by the number of matching ledger rows N and safety-stock rows m.
Here the deficit rows are aggregated first and the sum is multiplied by
N (counted per key with a map-side partial aggregate) and m; MIN, MAX and
COUNT DISTINCT are unaffected.  No row is multiplied out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stockpulse.functions import group_by_keys, money, norm_key, ratio_half_up, text_max
from stockpulse.operators.demand import asc
from stockpulse.operators.risk import copied_sum
from stockpulse.params import Params

# FIXED VALUES: provenance and classification labels
VENDOR_FROM_SS = "ETB_SS_CALC"
VENDOR_FROM_ACTION = "ETB_PAB_SUPPLY_ACTION"
VENDOR_FROM_LEDGER = "ETB_PAB_WFQ_ADJ"
VENDOR_FALLBACK = "FALLBACK"
UNASSIGNED = "UNASSIGNED"
SS_CALCULATED = "CALCULATED"
SS_DEFAULT = "DEFAULT_30_DAYS"
COST_FROM_SS = "ETB_SS_CALC"
COST_FROM_PO = "POP30330"
COST_MISSING = "MISSING"
PLACE_NOW, PLAN, MONITOR = "PLACE_NOW", "PLAN", "MONITOR"
CLEAN, MISSING_VENDOR, MISSING_COST, MISSING_BOTH = (
    "CLEAN", "MISSING_VENDOR", "MISSING_COST", "MISSING_BOTH")


# tie-breakers of the presentation order
ROW_TIEBREAK = ("PRIME_VNDR", "ITEMNMBR", "Recommended_PO_Qty", "Unit_Cost", "Total_Carrying_Cost")


def _keys(df: DataFrame, item: str, vendor: str, ci: bool, tag: str) -> DataFrame:
    return df.withColumns({f"_{tag}_item": norm_key(F.col(item), ci),
                           f"_{tag}_vnd": norm_key(F.col(vendor), ci)})


def ledger_counts(v4: DataFrame, p: Params) -> DataFrame:
    """N: extended-ledger rows per (item, vendor); NULL vendors never match."""
    ci = p.case_insensitive
    return (v4.where(F.col("PRIME_VNDR").isNotNull())
              .groupBy(norm_key(F.col("ITEMNMBR"), ci).alias("_n_item"),
                       norm_key(F.col("PRIME_VNDR"), ci).alias("_n_vnd"))
              .agg(F.count(F.lit(1)).alias("_n")))


def consolidate(fs: DataFrame, ss: DataFrame, v4: DataFrame, p: Params) -> DataFrame:
    """B1 + B2 on the deficit rows (R1): vendor fallback with provenance and the PO
    consolidation per item/vendor."""
    ci = p.case_insensitive
    g = group_by_keys(
        fs, {"ITEMNMBR": F.col("ITEMNMBR"), "PRIME_VNDR": F.col("PRIME_VNDR")}, [],
        [text_max("ItemDescription", p.collation).alias("ItemDescription"), text_max("UOM", p.collation).alias("UOM"),
         F.min("Demand_Due_Date").alias("First_Stockout_Date"),
         copied_sum(fs, "Deficit_Qty").alias("_sum_deficit"),
         F.count_distinct("Demand_Due_Date").alias("Demand_Lines_In_Bucket")], ci)
    g = _keys(g, "ITEMNMBR", "PRIME_VNDR", ci, "g")
    ssg = (_keys(ss, "ITEMNMBR", "PRIME_VNDR", ci, "s")
           .groupBy("_s_item", "_s_vnd", F.col("LeadDays").alias("_s_lead"),
                    F.col("CalculatedSS_PurchasingUOM").alias("_s_sspu"))
           .agg(F.min("PRIME_VNDR").alias("_s_vendor"), F.count(F.lit(1)).alias("_m")))
    n = ledger_counts(v4, p)
    j = (g.join(ssg, (g._g_item == ssg._s_item) & (g._g_vnd == ssg._s_vnd), "left")
          .join(n, (g._g_item == n._n_item) & (g._g_vnd == n._n_vnd), "left"))
    ss_hit = F.col("_s_item").isNotNull()
    wfq_vendor = F.when(F.col("_n").isNotNull(), F.col("PRIME_VNDR"))
    total = (F.col("_sum_deficit") if p.dedupe_vendor_join else
             F.col("_sum_deficit") * F.coalesce(F.col("_n"), F.lit(1)) * F.coalesce(F.col("_m"), F.lit(1)))
    return j.select(
        "ITEMNMBR",
        F.coalesce(F.col("_s_vendor"), F.col("PRIME_VNDR"), wfq_vendor, F.lit(UNASSIGNED))
         .alias("PRIME_VNDR"),
        F.when(F.col("_s_vendor").isNotNull(), VENDOR_FROM_SS)
         .when(F.col("PRIME_VNDR").isNotNull(), VENDOR_FROM_ACTION)
         .when(wfq_vendor.isNotNull(), VENDOR_FROM_LEDGER)
         .otherwise(VENDOR_FALLBACK).alias("Vendor_Data_Source"),
        "ItemDescription", "UOM", "First_Stockout_Date", total.alias("Total_Deficit_Qty"),
        "Demand_Lines_In_Bucket",
        F.coalesce(F.col("_s_lead"), F.lit(p.default_lead_days)).alias("LeadDays"),
        F.coalesce(F.col("_s_sspu"), F.lit(0.0)).alias("CalculatedSS_PurchasingUOM"),
        F.when(ss_hit, SS_CALCULATED).otherwise(SS_DEFAULT).alias("SS_Data_Source"),
        F.when(ss_hit & F.col("_s_sspu").isNotNull(), "YES").when(ss_hit, "PARTIAL")
         .otherwise("NO").alias("Has_Complete_SS_Data"),
        (total * p.annual_factor).alias("Annual_Demand_Estimate"))


def po_unit_cost(receipt_lines: DataFrame, p: Params) -> DataFrame:
    """AVG of positive unit costs per (item, vendor), at scale 6."""
    ci = p.case_insensitive
    return (receipt_lines.where(F.col("UNITCOST").isNotNull() & (F.col("UNITCOST") > 0))
            .groupBy(norm_key(F.col("ITEMNMBR"), ci).alias("_p_item"),
                     norm_key(F.col("PRIME_VNDR"), ci).alias("_p_vnd"))
            .agg(F.sum("UNITCOST").alias("_p_sum"), F.count("UNITCOST").alias("_p_n"))
            .select("_p_item", "_p_vnd",
                    ratio_half_up("_p_sum", "_p_n", 6).cast(DecimalType(38, 6)).alias("_p_cost")))


def resolve_cost(vf: DataFrame, ss: DataFrame, pop: DataFrame, p: Params) -> DataFrame:
    """Unit cost from safety stock, else PO history, else MISSING.

    Safety stock is joined again on the resolved vendor; several rows per
    key multiply the row (T28)."""
    ci = p.case_insensitive
    s = _keys(ss, "ITEMNMBR", "PRIME_VNDR", ci, "c").select(
        "_c_item", "_c_vnd", F.col("AverageCost").alias("_c_cost"),
        F.col("SSValue").alias("SSValue"), F.col("CalculatedSS_MfgUOM").alias("CalculatedSS_MfgUOM"))
    v = _keys(vf, "ITEMNMBR", "PRIME_VNDR", ci, "v")
    j = (v.join(s, (v._v_item == s._c_item) & (v._v_vnd == s._c_vnd), "left")
          .join(pop, (v._v_item == pop._p_item) & (v._v_vnd == pop._p_vnd), "left"))
    return j.withColumns({
        "Unit_Cost": F.coalesce(F.col("_c_cost"), F.col("_p_cost")),
        "Cost_Data_Source": F.when(F.col("_c_cost").isNotNull(), COST_FROM_SS)
                             .when(F.col("_p_cost").isNotNull(), COST_FROM_PO)
                             .otherwise(COST_MISSING),
    }).drop("_v_item", "_v_vnd", "_c_item", "_c_vnd", "_c_cost", "_p_item", "_p_vnd", "_p_cost")


def holding_rate(df: DataFrame, p: Params) -> DataFrame:
    """Implied rate SSValue / (SS qty x unit cost), else the default rate."""
    ssv, ssm = F.col("SSValue").cast("double"), F.col("CalculatedSS_MfgUOM").cast("double")
    cost = F.col("Unit_Cost").cast("double")
    base = ssm * cost
    ok = ssv.isNotNull() & ssm.isNotNull() & (ssm > 0) & cost.isNotNull() & (cost > 0)
    rate = F.when(ok, F.when(base > 0, ssv / base).otherwise(F.lit(p.default_holding_rate))) \
        .otherwise(F.lit(p.default_holding_rate))
    return df.withColumns({"Holding_Cost_Pct": rate,
                           "Order_Cost_Estimate": F.lit(p.order_cost)})


def vendor_exposure(df: DataFrame, p: Params) -> DataFrame:
    """SUM of deficit per resolved vendor, attached to each row.

    Aggregate-then-join instead of a window: the partial aggregate is
    skew-safe for a vendor holding a large share of rows."""
    ci = p.case_insensitive
    tot = (df.groupBy(norm_key(F.col("PRIME_VNDR"), ci).alias("_x_vnd"))
             .agg(F.sum("Total_Deficit_Qty").alias("Vendor_Total_Exposure")))
    return df.join(tot, norm_key(df.PRIME_VNDR, ci) == tot._x_vnd, "left").drop("_x_vnd")


def final_output(h: DataFrame, p: Params) -> DataFrame:
    """Quantities, carrying cost, EOQ, urgency and quality label."""
    total = F.col("Total_Deficit_Qty").cast("double")
    sspu = F.col("CalculatedSS_PurchasingUOM")
    cost = F.col("Unit_Cost").cast("double")
    rate = F.col("Holding_Cost_Pct")
    order_cost = F.col("Order_Cost_Estimate")
    rec = total + sspu
    holding = (rec / F.lit(2.0)) * cost * rate
    annual = F.col("Annual_Demand_Estimate").cast("double")
    eoq = F.sqrt((F.lit(2.0) * annual * order_cost) / F.nullif(cost * rate, F.lit(0.0)))
    optimized = F.when(F.col("Has_Complete_SS_Data") == "YES", rec).otherwise(
        F.when((annual > 0) & (rate > 0) & (cost > 0), F.greatest(total, eoq))
         .otherwise(total * F.lit(p.fallback_multiplier)))
    first, lead = F.col("First_Stockout_Date"), F.col("LeadDays")
    urgency = (F.when(first <= F.date_add(F.lit(p.today), lead), PLACE_NOW)
                .when(first <= F.date_add(F.lit(p.today), lead * 2), PLAN).otherwise(MONITOR))
    fallback = F.col("Vendor_Data_Source") == VENDOR_FALLBACK
    no_cost = F.col("Unit_Cost").isNull() | (F.col("Cost_Data_Source") == COST_MISSING)
    return h.select(
        "PRIME_VNDR", "ITEMNMBR", "ItemDescription", "UOM",
        first.alias("Earliest_Demand_Date"), rec.alias("Recommended_PO_Qty"),
        "Demand_Lines_In_Bucket", "Vendor_Total_Exposure", "LeadDays",
        "CalculatedSS_PurchasingUOM", urgency.alias("Urgency"),
        money(rate, 10, 4).alias("Holding_Cost_Pct"),
        F.col("Unit_Cost").cast(DecimalType(18, 6)).alias("Unit_Cost"),
        money(F.when(cost.isNotNull(), holding), 18, 2).alias("Holding_Cost_Annual"),
        money(order_cost, 18, 2).alias("Order_Cost_Estimate"),
        money(F.when(cost.isNotNull(), holding + order_cost).otherwise(order_cost), 18, 2)
         .alias("Total_Carrying_Cost"),
        money(optimized, 18, 2).alias("Recommended_PO_Qty_Optimized"),
        "Vendor_Data_Source", "SS_Data_Source", "Has_Complete_SS_Data",
        F.when(fallback & no_cost, MISSING_BOTH).when(fallback, MISSING_VENDOR)
         .when(no_cost, MISSING_COST).otherwise(CLEAN).alias("Data_Quality_Flag"),
        "Cost_Data_Source")


def buyer_sort(df: DataFrame, p: Params) -> DataFrame:
    """Urgency (alphabetical, as the source sorts), exposure DESC, date; then
    tie-breakers, so the presentation order is total.

    ``sort_by_severity`` orders PLACE_NOW, PLAN, MONITOR instead."""
    key = F.col("Urgency")
    if p.sort_by_severity:
        key = F.when(key == PLACE_NOW, 0).when(key == PLAN, 1).otherwise(2)
    return df.orderBy(key.asc_nulls_first(), F.col("Vendor_Total_Exposure").desc_nulls_last(),
                      F.col("Earliest_Demand_Date").asc_nulls_first(),
                      *asc(*ROW_TIEBREAK, collation=p.collation))


def priced_rows(fs: DataFrame, ss: DataFrame, v4: DataFrame, receipt_lines: DataFrame, p: Params) -> DataFrame:
    """The item/vendor rows with cost and holding rate."""
    return holding_rate(resolve_cost(consolidate(fs, ss, v4, p), ss, po_unit_cost(receipt_lines, p), p), p)


def buyer_control(fs: DataFrame, ss: DataFrame, v4: DataFrame, receipt_lines: DataFrame,
                  p: Params, sort: bool = True,
                  cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """V7 from the deficit rows (R1): 22 columns.

    The item/vendor rows feed both the vendor-exposure aggregate and the join
    back; ``cut`` (a checkpoint, in a run) materialises them once so the
    consolidation is not computed twice."""
    h = priced_rows(fs, ss, v4, receipt_lines, p)
    if cut is not None:
        h = cut(h)
    out = final_output(vendor_exposure(h, p), p)
    return buyer_sort(out, p) if sort else out
