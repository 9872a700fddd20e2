"""Documented report queries (P1-P7) and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.functions import group_by_keys, norm_key
from stockpulse.operators.buyer import PLACE_NOW, ROW_TIEBREAK, UNASSIGNED


# tie-breakers of the run-risk reports
RISK_TIEBREAK = ("ITEMNMBR", "PRIME_VNDR", "ItemDescription", "UOM", "LeadDays")


def _first(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def critical_items(v6: DataFrame) -> DataFrame:
    """Schedule threats, soonest stockout first."""
    return v6.where(F.col("Schedule_Threat") == 1).orderBy(
        F.col("Days_To_Stockout").asc_nulls_first(), *_first(*RISK_TIEBREAK))


def rescue_dependent(v6: DataFrame) -> DataFrame:
    """Items that depend on quarantine release."""
    return v6.where(F.col("WFQ_Dependency_Flag") == 1)


def high_impact(v6: DataFrame, min_clients: int = 5) -> DataFrame:
    """Stockouts threatening at least ``min_clients`` clients, largest deficit first."""
    return v6.where(F.col("Client_Exposure_Count") >= min_clients) \
        .orderBy(F.col("Total_Deficit_Qty").desc_nulls_last(), *_first(*RISK_TIEBREAK))


def place_now(v7: DataFrame) -> DataFrame:
    """PO actions due now, earliest demand first."""
    return v7.where(F.col("Urgency") == PLACE_NOW) \
        .orderBy(F.col("Earliest_Demand_Date").asc_nulls_first(), *_first(*ROW_TIEBREAK))


def high_consolidation(v7: DataFrame, min_lines: int = 10) -> DataFrame:
    """P5: lines consolidating at least ``min_lines`` demand dates, largest qty first."""
    return v7.where(F.col("Demand_Lines_In_Bucket") >= min_lines) \
        .orderBy(F.col("Recommended_PO_Qty").desc_nulls_last(), *_first(*ROW_TIEBREAK))


def vendor_exposure_summary(v7: DataFrame, case_insensitive: bool = True) -> DataFrame:
    """Exposure and item count per vendor."""
    return (group_by_keys(v7, {"PRIME_VNDR": F.col("PRIME_VNDR")}, [],
                          [F.max("Vendor_Total_Exposure").alias("Total_Exposure"),
                           F.count(F.lit(1)).alias("Item_Count")], case_insensitive)
              .orderBy(F.col("Total_Exposure").desc_nulls_last(), F.col("PRIME_VNDR").asc_nulls_first()))


def action_sample(v5: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` actions (a top-n report; ordered so it is repeatable)."""
    cols = ["ITEMNMBR", "Supply_Action_Recommendation", "Additional_Order_Qty"]
    return v5.select(*cols).orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)


def row_counts(outputs: dict[str, DataFrame]) -> DataFrame:
    """Row count per output, one table (UNION ALL of counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("Row_Count"))
               .select(F.lit(name).alias("View_Name"), "Row_Count")
             for name, df in outputs.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def null_vendor_counts(v6: DataFrame, v7: DataFrame) -> DataFrame:
    """Rows with a NULL vendor in run risk and buyer control."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count_if(F.col("PRIME_VNDR").isNull()).alias("Null_Vendors")) \
            .select(F.lit(name).alias("View_Name"), "Null_Vendors")
    return one("run_risk", v6).unionByName(one("buyer_control", v7))


def action_completeness(v5: DataFrame) -> DataFrame:
    """D3: recommendation on every row; NULL counts of the decision columns."""
    cols = ["Supply_Action_Recommendation", "Deficit_Qty", "POs_On_Order_Qty",
            "Additional_Order_Qty", "WFQ_Extended_Status"]
    return v5.agg(F.count(F.lit(1)).alias("Row_Count"),
                  *[F.count_if(F.col(c).isNull()).alias(f"Null_{c}") for c in cols])


def vendor_gaps(v7: DataFrame, sources: list[DataFrame], case_insensitive: bool = True) -> DataFrame:
    """D4, third rule: buyer rows without a vendor although one of ``sources``
    (ITEMNMBR, PRIME_VNDR) names a vendor for the item; with the least such name."""
    named = None
    for s in sources:
        own = s.where(F.col("PRIME_VNDR").isNotNull()).select(
            norm_key(F.col("ITEMNMBR"), case_insensitive).alias("_item"), "PRIME_VNDR")
        named = own if named is None else named.unionByName(own)
    known = named.groupBy("_item").agg(F.min("PRIME_VNDR").alias("Known_Vendor"))
    open_ = v7.where(F.col("PRIME_VNDR").isNull() | (F.col("PRIME_VNDR") == UNASSIGNED))
    return (open_.join(known, norm_key(F.col("ITEMNMBR"), case_insensitive) == F.col("_item"))
            .select("ITEMNMBR", "PRIME_VNDR", "Known_Vendor"))


def regression_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that differ between two runs, as multisets, classed by their key.

    Both sides are united with a sign, -1 and +1, and rows that cancel go; what is left
    of a key on one side only was ``removed`` or ``added``, on both sides it ``changed``
    (Side says which run a row is from).  Copies is how many more there are on that side.
    Rows are exchanged once, by the key: equal rows and rows of one key meet there."""
    cols = before.columns
    both = before.withColumn("_sign", F.lit(-1)).unionByName(after.select(*cols).withColumn("_sign", F.lit(1)))
    net = (both.repartition(*[F.col(k) for k in keys]).groupBy(*cols).agg(F.sum("_sign").alias("_net"))
           .where(F.col("_net") != 0))
    sides = Window.partitionBy(*keys)
    return (net.withColumns({"_lost": F.max(F.col("_net") < 0).over(sides), "_new": F.max(F.col("_net") > 0).over(sides)})
            .select(*cols, F.when(F.col("_net") < 0, "before").otherwise("after").alias("Side"),
                    F.when(F.col("_lost") & F.col("_new"), "changed").when(F.col("_new"), "added").otherwise("removed").alias("Change"),
                    F.abs("_net").alias("Copies")))


def rollup_diff(before: DataFrame, after: DataFrame, keys: list[str],
                measures: list[str]) -> DataFrame:
    """Per-key totals and row counts that differ between two runs.

    Both sides are united and grouped once, so NULL keys meet like any others."""
    both = before.select(*keys, *measures, F.lit(True).alias("_b")).unionByName(
        after.select(*keys, *measures, F.lit(False).alias("_b")))
    j = both.groupBy(*keys).agg(
        F.sum(F.when(F.col("_b"), 1)).alias("rows_before"),
        F.sum(F.when(~F.col("_b"), 1)).alias("rows_after"),
        *[F.sum(F.when(F.col("_b") == (t == "before"), F.col(m))).alias(f"{m}_{t}")
          for m in measures for t in ("before", "after")])
    diff = ~F.col("rows_before").eqNullSafe(F.col("rows_after"))
    for m in measures:
        diff = diff | ~F.col(f"{m}_before").eqNullSafe(F.col(f"{m}_after"))
    return j.where(diff)
