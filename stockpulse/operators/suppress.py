"""Suppression, inventory netting and the adjusted balance (I1-I10) -> view 2."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stockpulse.functions import collated, norm_key, str_eq, try_date, try_decimal, ts_lit
from stockpulse.operators.demand import BEG_BAL, V1_COLUMNS, no_cut, ordered
from stockpulse.operators.prefix import (
    BLOCK_CHUNKS, CHUNK_ROWS, attach, balance_offsets, chunk_of, chunk_window, lay_out)
from stockpulse.operators.slices import WHOLE, Slice
from stockpulse.params import Params

# FIXED VALUES: demand status labels
ST_BEGBAL = "BEGINNING BALANCE"
ST_STALE = "SUPPRESSED: Stale & Unissued"
ST_FENCE = "SUPPRESSED: Full Coverage in Fence"
ST_PARTIAL = "PARTIAL: Demand Netted"
ST_VALID = "VALID DEMAND"
NO_DATE = dt.date(9999, 12, 31)
D18_6 = DecimalType(18, 6)
#: More hot items than these are not told apart from the others.
MAX_HOT = 1000

# tie-breakers appended to the ledger sequence (I8)
SEQ_TIEBREAK = ("Issued", "Remaining", "WCID_From_MO", "MRP_IssueDate", "FG", "FG_Desc",
                "Construct", "ItemDescription", "UOM", "Running_Balance", "Deductions", "POs",
                "DUEDATE", "Date_Expiry", "PRIME_VNDR")


def wc_inventory(bin_stock: DataFrame, p: Params) -> DataFrame:
    """Recent work-centre stock per (item, site)."""
    ci = p.case_insensitive
    prefix = p.inventory_site_prefix
    since = ts_lit(dt.datetime.combine(p.today - dt.timedelta(days=p.inventory_window_days),
                                       dt.time()))
    site_ok = (F.upper(F.col("SITE")).startswith(prefix.upper()) if ci
               else F.col("SITE").startswith(prefix))
    return (bin_stock.where(site_ok & (F.col("DATERECD") >= since))
            .groupBy(norm_key(F.col("Item_Number"), ci).alias("Item_Number"),
                     norm_key(F.col("SITE"), ci).alias("SITE"))
            .agg(F.sum("QTY_Available").alias("Total_QTY_Available")))


def with_inventory(led: DataFrame, inv: DataFrame, p: Params, key: str | None = None) -> DataFrame:
    """Attach stock on (item, work centre); default 0.  Stock is attached
    to every row, not consumed.

    ``key`` names the item's key by which ``led`` is dealt out: the stock goes there by
    the item alone, and the ledger's rows stay where they are."""
    ci = p.case_insensitive
    i = inv.select(F.col("Item_Number").alias("_inv_item"), F.col("SITE").alias("_inv_site"),
                   "Total_QTY_Available")
    if key:
        i = i.repartition("_inv_item").hint("shuffle_hash")
    j = led.join(i, ((F.col(key) if key else norm_key(led.ITEMNMBR, ci)) == F.col("_inv_item"))
                 & (norm_key(led.WCID_From_MO, ci) == F.col("_inv_site")), "left")
    return j.withColumn("Inventory_Qty_Available",
                        F.coalesce(F.col("Total_QTY_Available"), F.lit(0))) \
        .drop("_inv_item", "_inv_site", "Total_QTY_Available")


def classify_demand(df: DataFrame, p: Params) -> DataFrame:
    """Net demand, Beg Bal flag, stale and fence rules, status."""
    ci = p.case_insensitive
    inv, rem = F.col("Inventory_Qty_Available"), F.col("Remaining")
    partial = (inv > 0) & (inv < rem)
    begbal = str_eq(F.trim(F.col("ORDERNUMBER")), BEG_BAL, ci)
    stale_cut = F.lit(p.today - dt.timedelta(days=p.stale_days))
    fence_cut = F.lit(p.today + dt.timedelta(days=p.fence_days))
    out = df.withColumns({
        "Net_Demand": F.when(partial, rem - inv).otherwise(rem),
        "Is_BegBal_Row": F.when(begbal, 1).otherwise(0),
        "Suppress_Stale": F.when(begbal, 0).when(
            (F.col("DUEDATE") <= stale_cut) & (F.coalesce(F.col("Issued"), F.lit(0)) == 0), 1)
            .otherwise(0),
        "Suppress_Fence": F.when(begbal, 0).when(
            (rem > 0) & (F.col("DUEDATE") <= fence_cut) & (inv >= rem), 1).otherwise(0),
    })
    stale, fence, bb = (F.col("Suppress_Stale") == 1), (F.col("Suppress_Fence") == 1), \
        (F.col("Is_BegBal_Row") == 1)
    return out.withColumns({
        "Is_Suppressed": F.when(bb, 0).when(stale | fence, 1).otherwise(0),
        "Demand_Status": F.when(bb, ST_BEGBAL).when(stale, ST_STALE).when(fence, ST_FENCE)
                          .when(partial, ST_PARTIAL).otherwise(ST_VALID),
        "Remaining_After_Suppression": F.when(bb, F.lit(None)).when(stale | fence, F.lit(0))
                                        .otherwise(rem),
    })


def is_demand(p: Params, required: str = "Remaining") -> Column:
    """Not Beg Bal, due date present, requirement not 0 (a NULL order is no demand)."""
    return F.coalesce(~str_eq(F.trim(F.col("ORDERNUMBER")), BEG_BAL, p.case_insensitive)
                      & F.col("DUEDATE").isNotNull() & (F.coalesce(F.col(required), F.lit(0)) != 0), F.lit(False))


def ledger_keys(p: Params) -> list[Column]:
    """What I8 orders an item's rows by, in turn, on view 1's columns: Beg Bal first, then
    effective date, order, audit key, status (then tie-breakers, so the order is total)."""
    begbal = str_eq(F.trim(F.col("ORDERNUMBER")), BEG_BAL, p.case_insensitive)
    date = F.coalesce(F.col("DUEDATE"), try_date(F.col("Date_Expiry"), p.date_formats),
                      F.col("MRP_IssueDate").cast("date"), F.lit(NO_DATE))
    return [F.when(begbal, 0).otherwise(1), date, *[collated(c, p.collation) for c in (
                F.col("ORDERNUMBER"), F.coalesce(F.col("Unified_Value"), F.lit("")), F.coalesce(F.col("STSDESCR"), F.lit("")))],
            *ordered(SEQ_TIEBREAK, p.collation)]


def ledger_order(p: Params) -> list[Column]:
    """I8 order within an item."""
    return [c.asc_nulls_first() for c in ledger_keys(p)]


def ordered_window(df: DataFrame, p: Params) -> tuple[DataFrame, Window, list[str]]:
    """``df`` with its item and ledger order as columns, the window over them, and the added
    columns.  Windows over the same columns sort their rows once."""
    keys = {f"_o{i}": c for i, c in enumerate(ledger_keys(p))}
    plain = {f"_o{5 + i}": c for i, c in enumerate(SEQ_TIEBREAK)} | {"_o2": "ORDERNUMBER"}
    if p.collation:
        plain = {}
    added = {n: c for n, c in keys.items() if n not in plain}
    if "_k" not in df.columns:
        added["_k"] = norm_key(F.col("ITEMNMBR"), p.case_insensitive)
    w = Window.partitionBy("_k").orderBy(*[F.col(plain.get(n, n)).asc_nulls_first() for n in keys])
    return df.withColumns(added), w, list(added)


def by_item(v1: DataFrame, bin_stock: DataFrame, p: Params) -> tuple[DataFrame, Window, list[str]]:
    """View 2 of items that fit a task: their rows, dealt out by the item's key ``_k`` once
    for the stock, the order and all that follows by item; see ``ordered_window``."""
    dealt = v1.withColumn("_k", norm_key(F.col("ITEMNMBR"), p.case_insensitive)).repartition("_k")
    df, w, added = ordered_window(classify_demand(with_inventory(dealt, wc_inventory(bin_stock, p), p, "_k"), p), p)
    return in_order_balance(df, w, p), w, [*added, "_k"]


def hot_items(v1: DataFrame, p: Params, rows: int) -> list[str] | None:
    """The keys of items with more than ``rows`` rows, None if these are very many."""
    key = norm_key(F.col("ITEMNMBR"), p.case_insensitive)
    hot = v1.groupBy(key.alias("_k")).count().where(F.col("count") > rows).limit(MAX_HOT + 1).collect()
    return [r["_k"] for r in hot] if len(hot) <= MAX_HOT else None


def item_slice(df: DataFrame, p: Params, part: Slice) -> DataFrame:
    """The rows of the items in a slice."""
    return part.rows(df, norm_key(F.col("ITEMNMBR"), p.case_insensitive))


def ledger_layout(v1: DataFrame, p: Params, cut: Callable[[DataFrame], DataFrame] | None = None,
                  part: Slice = WHOLE) -> DataFrame:
    """View 1 in ledger order (item, then I8's order) with the position ``Ledger_At``;
    with ``part`` the items of a slice."""
    key = norm_key(F.col("ITEMNMBR"), p.case_insensitive)
    return lay_out(item_slice(v1, p, part), [key.asc_nulls_first(), *ledger_order(p)], "Ledger_At", cut, part.no)


def _step(held: Column, now: Column, before: Column) -> Column:
    """The balance change onto a row: none for suppressed rows or unknown balances."""
    zero = F.lit(0).cast(D18_6)
    return F.when(held == 1, zero).otherwise(F.coalesce((now - before).cast(DecimalType(19, 6)), zero))


def adjusted_balance(df: DataFrame, p: Params) -> DataFrame:
    """I8-I10 and W2 in single windows per item: sequence, balance delta, the
    suppression-aware running balance, and the sequence of demand rows.

    anchor = first parsed balance of the item (NULL stays NULL); each row adds
    its delta to the previous row unless it is the first row or suppressed.
    """
    df, w, added = ordered_window(df, p)
    return in_order_balance(df, w, p).drop(*added)


def in_order_balance(df: DataFrame, w: Window, p: Params) -> DataFrame:
    """``adjusted_balance`` over the window of ``ordered_window``."""
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({"RB_Num": try_decimal(F.col("Running_Balance"), 18, 6), "_dem": is_demand(p).cast("int")})
    rb = F.col("RB_Num")
    seq = df.withColumns({
        "Seq": F.row_number().over(w),
        "RB_Delta": rb - F.lag(rb).over(w),
        "RB_Anchor": F.first(rb).over(w),
        "Demand_Seq": F.when(F.col("_dem") == 1, F.sum("_dem").over(upto)),
    })
    zero = F.lit(0).cast(D18_6)
    adj = seq.withColumn("RB_Delta_Adjusted", F.when((F.col("Seq") == 1) | (F.col("Is_Suppressed") == 1), zero)
                         .otherwise(F.coalesce(F.col("RB_Delta"), zero)))
    return adj.withColumn("Adjusted_Running_Balance",
                          (F.col("RB_Anchor") + F.sum("RB_Delta_Adjusted").over(upto)).cast(D18_6)).drop("_dem")


def adjusted_balance_split(df: DataFrame, p: Params, chunk_rows: int = CHUNK_ROWS,
                           block_chunks: int = BLOCK_CHUNKS) -> DataFrame:
    """I8-I10 and W2 on rows laid out in ledger order (``Ledger_At``): same result as
    ``adjusted_balance`` without putting a hot item into one task (see ``operators.prefix``).

    Per (item, chunk): local sequence, local lag, local running sum of steps with the
    first row's counted 0.  The step onto a chunk's first row and all that precedes
    the chunk come from the tree of chunk aggregates."""
    zero = F.lit(0).cast(D18_6)
    demand = is_demand(p).cast("int")
    d = df.withColumns({"_k": norm_key(F.col("ITEMNMBR"), p.case_insensitive), "_c": chunk_of("Ledger_At", chunk_rows),
                        "RB_Num": try_decimal(F.col("Running_Balance"), 18, 6), "_dem": demand})
    w = chunk_window("_k", "_c", "Ledger_At")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({"_lseq": F.row_number().over(w), "_llag": F.lag("RB_Num").over(w),
                       "_ldem": F.sum("_dem").over(upto)})
    d = d.withColumn("_step", F.when(F.col("_lseq") == 1, zero)
                     .otherwise(_step(F.col("Is_Suppressed"), F.col("RB_Num"), F.col("_llag"))))
    d = d.withColumn("_lrun", F.sum("_step").over(upto))
    chunks = d.groupBy("_k", "_c").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_dem").alias("dem"), F.sum("_step").alias("total"),
        F.min_by("RB_Num", "_lseq").alias("first"), F.max_by("RB_Num", "_lseq").alias("last"),
        F.min_by("Is_Suppressed", "_lseq").alias("held"))
    offsets = balance_offsets(chunks, "_k", "_c", _step, ["n", "dem"], block_chunks)
    j = attach(d, offsets, "_k", "_c")
    first = F.col("_lseq") == 1
    delta = F.when(first, F.col("RB_Num") - F.col("before")).otherwise(F.col("RB_Num") - F.col("_llag"))
    running = F.col("off_total") + F.col("lead") + F.col("_lrun")
    j = j.withColumns({"Seq": (F.col("_lseq") + F.col("off_n")).cast("int"), "RB_Delta": delta,
                       "RB_Anchor": F.col("anchor"),
                       "Demand_Seq": F.when(F.col("_dem") == 1, F.col("_ldem") + F.col("off_dem")),
                       "Adjusted_Running_Balance": (F.col("anchor") + running).cast(D18_6)})
    j = j.withColumn("RB_Delta_Adjusted", F.when((F.col("Seq") == 1) | (F.col("Is_Suppressed") == 1), zero)
                     .otherwise(F.coalesce(F.col("RB_Delta"), zero)))
    return j.drop("_k", "_c", "_dem", "_lseq", "_llag", "_ldem", "_step", "_lrun", *offsets.columns[2:])


V2_COLUMNS = ["ITEMNMBR", "ItemDescription", "UOM", "ORDERNUMBER", "Construct", "DUEDATE",
              "Expiry_Dates", "Date_Expiry", "BEG_BAL", "Deductions", "Expiry", "POs",
              "Running_Balance", "Adjusted_Running_Balance", "MRP_IssueDate", "WCID_From_MO",
              "Issued", "Remaining", "Net_Demand", "Inventory_Qty_Available", "Is_Suppressed",
              "Demand_Status", "Remaining_After_Suppression", "Has_Issued", "IssueDate_Mismatch",
              "Early_Issue_Flag", "VendorItem", "PRIME_VNDR", "PURCHASING_LT", "PLANNING_LT",
              "ORDER_POINT_QTY", "SAFETY_STOCK", "FG", "FG_Desc", "STSDESCR", "MRPTYPE",
              "Unified_Value"]


def suppressed_ledger_full(v1: DataFrame, bin_stock: DataFrame, p: Params,
                           split: bool = True, cut: Callable[[DataFrame, str], DataFrame] = no_cut) -> DataFrame:
    """V2 with internal columns (Seq, Demand_Seq, Is_BegBal_Row) kept for later stages.

    ``split=True`` scans view 1 as laid out by ``ledger_layout`` in bounded pieces;
    False uses the single per-item window (cheaper when no item is hot).  ``cut`` stores
    the ledger with its stock, which the split balance reads twice."""
    at = ["Ledger_At"] if split else []
    assert v1.columns == V1_COLUMNS + at, v1.columns
    led = classify_demand(cut(with_inventory(v1, wc_inventory(bin_stock, p), p), "stocked_ledger"), p)
    return adjusted_balance_split(led, p).drop(*at) if split else adjusted_balance(led, p)
