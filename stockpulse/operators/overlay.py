"""Stockout detection and quarantine overlay (W1-W8) -> view 4."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.functions import group_by_keys, norm_key, str_eq
from stockpulse.operators.demand import BEG_BAL, no_cut
from stockpulse.operators.quarantine import VIEW_LEVEL
from stockpulse.operators.suppress import ST_BEGBAL, by_item, is_demand
from stockpulse.params import Params

# FIXED VALUES: overlay status labels
LEDGER_ONLY = "LEDGER_ONLY"
WFQ_RESCUED = "WFQ_RESCUED"
WFQ_ENHANCED = "WFQ_ENHANCED"
WFQ_INSUFFICIENT = "WFQ_INSUFFICIENT"
NON_DEMAND = "NON_DEMAND_LEDGER_ROW"


def demand_ledger_frame(v2full: DataFrame) -> DataFrame:
    """View 2 under the names the overlay uses."""
    return (v2full.withColumnRenamed("Remaining", "Original_Required")
                  .withColumnRenamed("Demand_Status", "Suppression_Status"))


def demand_rows(led: DataFrame, p: Params) -> DataFrame:
    """Not Beg Bal, due date present, requirement != 0 (NULL order drops)."""
    return led.where(is_demand(p, "Original_Required"))


def supply_schedule(pipe: DataFrame, p: Params) -> DataFrame:
    """Positive quarantine on-hand per (item, site, release date)."""
    return group_by_keys(pipe.where((F.col("View_Level") == VIEW_LEVEL) & (F.col("QTY_ON_HAND") > 0)),
                         {"ITEMNMBR": F.col("Item_Number"), "SITE": F.col("SITE")}, ["Estimated_Release_Date"],
                         [F.sum("QTY_ON_HAND").alias("WFQ_Qty")], p.case_insensitive)


def cover_by_date(led: DataFrame, supply: DataFrame, p: Params, influx_only: bool = False) -> DataFrame:
    """W3 and W5 per (item, due date): the item's first stockout and all supply
    released at or before the date.

    Demand rows are aggregated to one row per (item, due date) first, supply to one
    per (item, release), so an item's timeline has as many rows as it has distinct
    dates, however many ledger rows it holds.  ``influx_only`` keeps the dates on which
    demand can get any supply, which is all that the overlay needs."""
    ci = p.case_insensitive
    out = F.when(F.col("Adjusted_Running_Balance") <= 0, F.col("Demand_Seq"))
    due = (demand_rows(led, p).groupBy(norm_key(F.col("ITEMNMBR"), ci).alias("_k"), F.col("DUEDATE").alias("_due"))
           .agg(F.min(out).alias("_out"))
           .select("_k", F.col("_due").cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_kind"), "_due", "_out",
                   F.lit(None).cast("decimal(38,5)").alias("_qty")))
    released = released_supply(supply, p).withColumn("_out", F.lit(None).cast("bigint"))
    item = Window.partitionBy("_k")
    return (due.unionByName(released)
            .withColumns({"_cum": cumulated(item), "Stockout_Seq": F.min("_out").over(item)})
            .where("_kind = 1" + " AND _cum > 0 AND Stockout_Seq IS NOT NULL" * influx_only)
            .select("_k", "_due", "_cum", "Stockout_Seq"))


def released_supply(supply: DataFrame, p: Params) -> DataFrame:
    """Supply per (item, release), as rows of an item's timeline (kind 0)."""
    return (supply.groupBy(norm_key(F.col("ITEMNMBR"), p.case_insensitive).alias("_k"),
                           F.col("Estimated_Release_Date").cast("timestamp_ntz").alias("_t"))
            .agg(F.sum("WFQ_Qty").cast("decimal(38,5)").alias("_qty"))
            .select("_k", "_t", F.lit(0).alias("_kind"), F.lit(None).cast("date").alias("_due"), "_qty")
            .where(F.col("_t").isNotNull()))


def cumulated(item: Window) -> Column:
    """Supply released up to a row of an item's timeline."""
    upto = item.orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.coalesce(F.sum("_qty").over(upto), F.lit(0))


def allocate_supply(led: DataFrame, supply: DataFrame, p: Params, influx_only: bool = False) -> DataFrame:
    """W3 + W5 on every ledger row (rewrite R2): Stockout_Seq and the influx, which
    demand rows at or after the stockout get; NULL on rows that are no demand.

    Rows keep their number and meet one row per (item, due date): no demand x supply
    product and no window over the ledger.  The demand sequence (W2) is the running
    count that the balance scan has left (``Demand_Seq``): on demand rows the ledger
    order is the order by due date, order number, audit key and sequence.  With
    ``influx_only`` Stockout_Seq stays NULL where no supply can come in."""
    ci = p.case_insensitive
    cover = cover_by_date(led, supply, p, influx_only)
    j = led.withColumn("_w1", is_demand(p, "Original_Required"))
    j = j.join(cover, F.col("_w1") & (norm_key(F.col("ITEMNMBR"), ci) == F.col("_k"))
               & (F.col("DUEDATE") == F.col("_due")), "left")
    gate = F.col("Stockout_Seq").isNotNull() & (F.col("Demand_Seq") >= F.col("Stockout_Seq"))
    influx = F.when(F.col("_w1"), F.when(gate, F.col("_cum")).otherwise(F.lit(0)))
    return j.withColumn("Ledger_WFQ_Influx", influx).drop("_w1", "_k", "_due", "_cum")


def supply_in_order(led: DataFrame, w: Window, v1: DataFrame, supply: DataFrame, p: Params) -> DataFrame:
    """W3 + W5 on view 2 where it is dealt out by its items' key ``_k``, with ``w`` the window of
    its order: ``Ledger_WFQ_Influx``, where the rows are.

    Demand rows stand in the order of their sequence, so a row is at or after the first
    stockout if a demand row up to it is short.  The due dates come from view 1, whose
    demand rows are the ledger's."""
    ci = p.case_insensitive
    due = (v1.where(is_demand(p)).select(norm_key(F.col("ITEMNMBR"), ci).alias("_k"), F.col("DUEDATE").alias("_due")).distinct()
           .select("_k", F.col("_due").cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_kind"), "_due",
                   F.lit(None).cast("decimal(38,5)").alias("_qty")))
    cover = (due.unionByName(released_supply(supply, p)).repartition("_k").withColumn("_cum", cumulated(Window.partitionBy("_k")))
             .where("_kind = 1 AND _cum > 0").select(F.col("_k").alias("_c_k"), "_due", "_cum").hint("shuffle_hash"))
    short = F.when(F.col("_w1") & (F.col("Adjusted_Running_Balance") <= 0), 1)
    j = led.withColumn("_w1", is_demand(p))
    j = j.withColumn("_short", F.max(short).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    j = j.join(cover, F.col("_w1") & (F.col("_k") == F.col("_c_k")) & (F.col("DUEDATE") == F.col("_due")), "left")
    influx = F.when(F.col("_w1"), F.when(F.col("_short").isNotNull(), F.coalesce("_cum", F.lit(0))).otherwise(F.lit(0)))
    return j.withColumn("Ledger_WFQ_Influx", influx).drop("_w1", "_short", "_c_k", "_due", "_cum")


def extended_status(df: DataFrame) -> DataFrame:
    """W6 + W7: extended balance and overlay status of demand rows, NULL on others."""
    infl, adj = F.col("Ledger_WFQ_Influx"), F.col("Adjusted_Running_Balance")
    ext = adj + infl
    return df.withColumns({
        "Ledger_Extended_Balance": ext,
        "WFQ_Extended_Status": F.when(infl.isNull(), F.lit(None)).when(infl <= 0, LEDGER_ONLY)
                                .when((adj <= 0) & (ext > 0), WFQ_RESCUED)
                                .when(ext > 0, WFQ_ENHANCED).otherwise(WFQ_INSUFFICIENT),
    })


OVERLAY = ("Ledger_WFQ_Influx", "Ledger_Extended_Balance", "WFQ_Extended_Status")


def final_ledger(ext: DataFrame, p: Params, key: str | None = None) -> DataFrame:
    """Every ledger row meets the overlay of each demand row of its (item, due date,
    order, audit key).  k duplicate demand rows give k^2 rows (T14), as in the source.

    The overlay already stands on the ledger's own rows; a window over the key hands
    each group's list of demand overlays to its rows, and only groups with several
    replicate.  A row whose key is NULL meets nothing; it gets a group of its own.
    The key is one struct, so that the exchange is by all of it and a date that very
    many rows share is spread by order number.  ``key`` names the item's key by which
    ``ext`` is dealt out, if it is; then the rows meet where they are."""
    ci = p.case_insensitive
    loose = F.col("DUEDATE").isNull() | F.col("ORDERNUMBER").isNull()
    by = [F.col("DUEDATE"), norm_key(F.col("ORDERNUMBER"), ci),
          norm_key(F.coalesce(F.col("Unified_Value"), F.lit("")), ci), F.when(loose, F.col("Seq"))]
    group = Window.partitionBy(key, *by) if key else Window.partitionBy(F.struct(norm_key(F.col("ITEMNMBR"), ci), *by))
    hits = F.collect_list(F.when(F.col("WFQ_Extended_Status").isNotNull(), F.struct(*OVERLAY))).over(group)
    own = [c for c in ext.columns if c not in OVERLAY]
    j = ext.select(*own, hits.alias("_hits")).select(*own, F.explode_outer("_hits").alias("_e"))
    begbal = str_eq(F.trim(F.col("ORDERNUMBER")), BEG_BAL, ci)
    return j.withColumns({
        "Ledger_WFQ_Influx": F.coalesce(F.col("_e.Ledger_WFQ_Influx"), F.lit(0)),
        "Ledger_Extended_Balance": F.col("_e.Ledger_Extended_Balance"),
        "WFQ_Extended_Status": F.when(begbal, ST_BEGBAL).when(F.col("_e").isNull(), NON_DEMAND)
                                .otherwise(F.col("_e.WFQ_Extended_Status")),
    }).drop("_e")


V4_COLUMNS = ["ITEMNMBR", "ItemDescription", "UOM", "ORDERNUMBER", "Construct", "DUEDATE",
              "Expiry_Dates", "Date_Expiry", "BEG_BAL", "Deductions", "Expiry", "POs",
              "Running_Balance", "Adjusted_Running_Balance", "MRP_IssueDate", "WCID_From_MO",
              "Issued", "Original_Required", "Net_Demand", "Inventory_Qty_Available",
              "Suppression_Status", "VendorItem", "PRIME_VNDR", "PURCHASING_LT", "PLANNING_LT",
              "ORDER_POINT_QTY", "SAFETY_STOCK", "FG", "FG_Desc", "STSDESCR", "MRPTYPE",
              "Unified_Value", "Ledger_WFQ_Influx", "Ledger_Extended_Balance",
              "WFQ_Extended_Status"]


def extended_ledger(v2full: DataFrame, pipe: DataFrame, p: Params,
                    cut: Callable[[DataFrame, str], DataFrame] = no_cut) -> DataFrame:
    """V4: 35 columns.  ``cut`` stores the ledger with its supply, before the overlay meets its rows.

    Only the columns that view 4 shows or orders by go through the exchanges."""
    led = demand_ledger_frame(v2full)
    own = [c for c in V4_COLUMNS if c not in OVERLAY] + ["Seq"]
    covered = cut(allocate_supply(led.select(*own, "Demand_Seq"), supply_schedule(pipe, p), p, influx_only=True)
                  .select(*own, "Ledger_WFQ_Influx"), "covered_ledger")
    return final_ledger(extended_status(covered), p).select(*V4_COLUMNS)


def extended_ledger_by_item(v1: DataFrame, bin_stock: DataFrame, pipe: DataFrame, p: Params,
                            columns: list[str] = V4_COLUMNS) -> DataFrame:
    """V4 (its ``columns``) from view 1 for items that fit a task: ``extended_ledger`` on
    ``suppress.by_item``, in the one exchange that deals the rows out by item."""
    v2, w, _ = by_item(v1, bin_stock, p)
    covered = demand_ledger_frame(supply_in_order(v2, w, v1, supply_schedule(pipe, p), p))
    meets = {"ITEMNMBR", "ORDERNUMBER", "DUEDATE", "Unified_Value", "Adjusted_Running_Balance"}
    own = [c for c in V4_COLUMNS if c not in OVERLAY and (c in columns or c in meets)] + ["Seq", "_k"]
    return final_ledger(extended_status(covered.select(*own, "Ledger_WFQ_Influx")), p, "_k").select(*columns)
