"""Demand ledger (L1-L11) -> view 1.

Window orders in the source are not total.  Every ``row_number`` here gets
tie-breakers after the source's own keys so results are deterministic; the
DuckDB oracle uses the same lists.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.functions import (
    clean_order,
    collated,
    first_non_blank,
    norm_key,
    not_like_prefix,
    str_eq,
    to_decimal_or_zero,
    try_date,
    varchar,
)
from stockpulse.operators.slices import WHOLE, Slice
from stockpulse.params import Params

# FIXED VALUES
BEG_BAL = "Beg Bal"
BEG_BAL_CLEAN = "BEGBAL"  # its clean order number
EXCLUDED_STATUSES = ("Partially Received", "SCRAP")
EXCLUDED_SERIES = ("60.", "70.")
ACTIVE = "Yes"
OPEN_MO_STATUSES = (2, 3)
NO_ISSUE_DATE = dt.date(1900, 1, 1)  # ISNULL(date, '') yields 1900-01-01
YES, NO = "YES", "NO"
SEP = " - "

# tie-breakers appended to the core-ledger dedup order
CORE_TIEBREAK = ("DUEDATE", "Date_Expiry", "Original_Deductions", "Original_POs",
                 "Original_Running_Balance", "ItemDescription", "UOMSCHDL", "PRIME_VNDR",
                 "VendorItem", "CleanOrder")


#: Columns of the orders below that are no text.
NO_TEXT = frozenset(("DUEDATE", "MRP_IssueDate", "Issued", "Remaining", "Recommended_PO_Qty", "Unit_Cost",
                     "Total_Carrying_Cost"))


def ordered(cols: tuple[str, ...], collation: str | None) -> list[Column]:
    """Columns to compare in turn: text by the collation, then, where that takes
    spellings as equal, by code points, so that an order stays as total as it was."""
    if not collation:
        return [F.col(c) for c in cols]
    text = [c for c in cols if c not in NO_TEXT]
    return [F.col(c) if c in NO_TEXT else collated(F.col(c), collation) for c in cols] + [F.col(c) for c in text]


def asc(*cols: str, collation: str | None = None) -> list[Column]:
    return [c.asc_nulls_first() for c in ordered(cols, collation)]


def named_struct(cols: list[Column]) -> Column:
    """A struct that compares as the columns do in turn."""
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])


def clean_columns(p: Params) -> dict[str, Column]:
    """What follows from a demand row's own columns."""
    return {"CleanOrder": clean_order(F.col("ORDERNUMBER"), p.case_insensitive), "CleanItem": F.trim(F.col("ITEMNMBR")),
            "CleanDeductions": to_decimal_or_zero(F.col("Deductions"), 18, 5)}


def filter_demand(planning: DataFrame, p: Params) -> DataFrame:
    """L1 + N1-N3: drop excluded statuses and series; add clean keys.

    Rows with a NULL status or item drop too (three-valued logic)."""
    ci = p.case_insensitive
    item = F.trim(F.col("ITEMNMBR"))
    cond = F.lit(True)
    for s in EXCLUDED_STATUSES:
        cond = cond & ~str_eq(F.col("STSDESCR"), s, ci)
    for s in EXCLUDED_SERIES:
        cond = cond & not_like_prefix(item, s, ci)
    return planning.where(cond).withColumns(clean_columns(p))


def dedupe_fg(fg_orders: DataFrame, p: Params) -> DataFrame:
    """L2: one row per (clean order, FG): first by customer, FG description, order no.

    A pure top-1 per (clean order, FG): Spark plans a partial WindowGroupLimit
    before the shuffle, so copies of one key are cut down map-side, and no window
    stands between the reduced map and the demand join (L4), which adaptive
    execution can therefore split where many demand rows share a clean order
    (blank order numbers all do)."""
    ci = p.case_insensitive
    m = fg_orders.withColumn("CleanOrder", clean_order(F.col("ORDERNUMBER"), ci))
    w = Window.partitionBy("CleanOrder", norm_key(F.col("FG"), ci)) \
        .orderBy(*asc("Customer", "FG_Desc", "ORDERNUMBER", collation=p.collation))
    return (m.withColumn("rn_fg", F.row_number().over(w)).where("rn_fg = 1")
             .select("CleanOrder", "ORDERNUMBER", "FG", "Customer", "FG_Desc"))


def item_lookup(vendor_items: DataFrame, p: Params) -> DataFrame:
    """L3: active item description and UOM."""
    return (vendor_items.where(str_eq(F.col("Active"), ACTIVE, p.case_insensitive))
            .select(F.col("Item_Number").alias("ItemNumber"),
                    F.col("ITEMDESC").alias("ItemDescription"), "UOMSCHDL"))


def join_demand(pn: DataFrame, fg: DataFrame, il: DataFrame | None, p: Params) -> DataFrame:
    """L4: demand ⟕ FG map (on clean order) ⟕ item lookup (on untrimmed item).

    What follows from a demand row's own columns is made after the joins, so that the
    exchanges do not carry it.  ``il`` is None if ``pn`` has it already (``with_lookup``) or
    ``described`` attaches it later."""
    ci = p.case_insensitive
    m = fg.select(F.col("CleanOrder").alias("_m_clean"), F.col("ORDERNUMBER").alias("_m_order"),
                  F.col("FG").alias("_m_fg"), F.col("Customer").alias("_m_cust"),
                  F.col("FG_Desc").alias("_m_desc"))
    j = pn.join(m, pn.CleanOrder == m._m_clean, "left")
    if il is not None:
        j = with_lookup(j, il, p)
    e = F.lit("")
    named = [] if "_i_desc" not in j.columns else [varchar(F.coalesce("_i_desc", e), 500).alias("ItemDescription"),
                                   varchar(F.coalesce("_i_uom", e), 50).alias("UOMSCHDL")]
    return j.select(
        varchar(first_non_blank(F.col("ORDERNUMBER"), F.col("_m_order")), 255).alias("ORDERNUMBER"),
        varchar(F.coalesce("_m_cust", e), 255).alias("Construct"),
        varchar(F.coalesce("_m_fg", e), 255).alias("FG"),
        varchar(F.coalesce("_m_desc", e), 255).alias("FG_Desc"),
        varchar(F.coalesce("ITEMNMBR", e), 255).alias("ITEMNMBR"),
        *named, "STSDESCR", "DUEDATE", "Expiry_Dates", "Date_Expiry", "MRPTYPE", "VendorItem",
        "PRIME_VNDR", "PURCHASING_LT", "PLANNING_LT", "ORDER_POINT_QTY", "SAFETY_STOCK",
        F.col("Deductions").alias("Original_Deductions"), F.col("Expiry").alias("Original_Expiry"),
        F.col("POs").alias("Original_POs"),
        F.col("Running_Balance").alias("Original_Running_Balance"),
        to_decimal_or_zero(F.col("BEG_BAL"), 18, 6).alias("BEG_BAL_Num"),
        "CleanOrder", *[clean_columns(p)[c].alias(c) for c in ("CleanItem", "CleanDeductions")])


def with_lookup(rows: DataFrame, il: DataFrame, p: Params) -> DataFrame:
    """The item lookup on rows with an item, as columns that ``join_demand`` shows."""
    ci = p.case_insensitive
    i = il.select(norm_key(F.col("ItemNumber"), ci).alias("_i_key"),
                  F.col("ItemDescription").alias("_i_desc"), F.col("UOMSCHDL").alias("_i_uom"))
    return rows.join(i, norm_key(F.col("ITEMNMBR"), ci) == F.col("_i_key"), "left").drop("_i_key")


def dedupe_ledger(joined: DataFrame, p: Params) -> DataFrame:
    """First row per (order, FG, item) by construct, FG description, status.

    Blank order numbers became NULL and collapse into one row per (FG, item),
    as in the source."""
    ci = p.case_insensitive
    w = Window.partitionBy(norm_key(F.col("ORDERNUMBER"), ci), norm_key(F.col("FG"), ci),
                           norm_key(F.col("ITEMNMBR"), ci)) \
        .orderBy(*asc("Construct", "FG_Desc", "STSDESCR", *[c for c in CORE_TIEBREAK if c in joined.columns], collation=p.collation))
    return joined.withColumn("rn_final", F.row_number().over(w)).where("rn_final = 1") \
        .drop("rn_final")


def first_demand(pn: DataFrame, p: Params, rank: bool = True) -> DataFrame:
    """The demand row that L5 can choose of each (order number, clean order, item).

    All of them meet the same FG rows and the same item descriptions, so L5's choice
    among them is made on demand columns alone, before the join.  The clean order leads the
    window's keys, so that rows dealt out by it come out in its order.

    A ``rank`` is limited before the exchange too, which cuts copies down but sorts every
    row there; without it rows that hardly repeat are sorted once."""
    ci = p.case_insensitive
    w = Window.partitionBy(F.col("CleanOrder"), norm_key(varchar(first_non_blank(F.col("ORDERNUMBER")), 255), ci),
                           norm_key(F.col("ITEMNMBR"), ci)) \
        .orderBy(*asc("STSDESCR", "DUEDATE", "Date_Expiry", "Deductions", "POs", "Running_Balance", "PRIME_VNDR",
                      "VendorItem", collation=p.collation))
    if rank:
        return pn.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return pn.withColumn("_before", F.lag(F.lit(1)).over(w)).where("_before IS NULL").drop("_before")


def first_description(il: DataFrame, p: Params) -> DataFrame:
    """The description and UOM that L5 can choose of each item: the least pair."""
    e = F.lit("")
    pair = il.select("ItemNumber", varchar(F.coalesce("ItemDescription", e), 500).alias("d"),
                     varchar(F.coalesce("UOMSCHDL", e), 50).alias("u"))
    least = F.min(F.struct(named_struct(ordered(("d", "u"), p.collation)).alias("o"), F.struct("d", "u").alias("r")))
    return (pair.groupBy(norm_key(F.col("ItemNumber"), p.case_insensitive).alias("ItemNumber")).agg(least["r"].alias("_p"))
            .select("ItemNumber", F.col("_p.d").alias("ItemDescription"), F.col("_p.u").alias("UOMSCHDL")))


def named_fg(fg_orders: DataFrame, p: Params) -> DataFrame:
    """L2 for orders with a clean number, one row per (clean order, FG as L4 shows it).

    L2 keeps a NULL and a blank FG apart, L4 shows both as blank and L5 keeps one: both
    choices are least values of one aggregate."""
    ci = p.case_insensitive
    m = fg_orders.withColumn("CleanOrder", clean_order(F.col("ORDERNUMBER"), ci)).where(F.col("CleanOrder") != "")
    row = F.struct(named_struct(ordered(("Customer", "FG_Desc", "ORDERNUMBER"), p.collation)).alias("o"),
                   F.struct("Customer", "FG_Desc", "ORDERNUMBER", "FG").alias("r"))
    g = m.groupBy("CleanOrder", norm_key(F.coalesce("FG", F.lit("")), ci).alias("_fg")).agg(
        F.min(F.when(F.col("FG").isNull(), row))["r"].alias("_null"),
        F.min(F.when(F.col("FG").isNotNull(), row))["r"].alias("_text"))

    def shown(c: str) -> Column:
        text = [F.coalesce(F.col(f"{c}.{f}"), F.lit("")) for f in ("Customer", "FG_Desc")]
        # the order of L5: both by the collation; beyond that, which of the two is shown is the same
        return named_struct([F.col(c).isNull(), *[collated(t, p.collation) for t in text], *text])
    pick = F.when(shown("_null") < shown("_text"), F.col("_null")).otherwise(F.col("_text"))
    return g.withColumn("_m", pick).select("CleanOrder", *[F.col(f"_m.{c}").alias(c)
                                                           for c in ("ORDERNUMBER", "FG", "Customer", "FG_Desc")])


def no_cut(df: DataFrame, name: str) -> DataFrame:
    """A step that is not stored."""
    return df


def core_ledger(pn: DataFrame, fg_orders: DataFrame, vendor_items: DataFrame, p: Params) -> DataFrame:
    """L4 + L5 without the fan-out: equals ``dedupe_ledger(join_demand(...))``.

    The demand rows and descriptions among which L5 would choose after the join are
    chosen before it, so a demand row meets each FG row of its order once and a
    (order, FG, item) comes out once.  Only demand without a clean order number can
    still meet in L5, because it takes the FG rows' order numbers: those rows (one per
    item and spelling) are deduplicated apart.  Order numbers, items and FG codes are
    taken to be no longer than the 255 characters that the source gives them.

    Demand is dealt out by its clean order once, for the choice and for the FG join alike.
    The beginning balances, one per item under a single order number, would meet in one
    task there; they go with the demand without an order number.  The description, one per
    item, comes first, so that no exchange carries a row for each FG of its order."""
    pn = with_lookup(pn, first_description(item_lookup(vendor_items, p), p), p)
    return named_ledger(pn, fg_orders, p).unionByName(loose_ledger(pn, fg_orders, p))


#: Clean order numbers that very many demand rows share.
SHARED = ("", BEG_BAL_CLEAN)


def is_loose() -> Column:
    return F.coalesce("CleanOrder", F.lit("")).isin(*SHARED)


def named_ledger(pn: DataFrame, fg_orders: DataFrame, p: Params) -> DataFrame:
    """The part of ``core_ledger`` with an order number, dealt out by it."""
    named = first_demand(pn.where(~is_loose()).repartition("CleanOrder"), p, rank=False)
    return join_demand(named, named_fg(fg_orders, p), None, p)


def loose_ledger(pn: DataFrame, fg_orders: DataFrame, p: Params) -> DataFrame:
    """The other part of ``core_ledger``.  A group of L5 is of one item, which has one
    description, so it may come later."""
    few = dedupe_fg(fg_orders, p).where(F.col("CleanOrder").isin(*SHARED))
    return dedupe_ledger(join_demand(first_demand(pn.where(is_loose()), p), few, None, p), p)


def described(led: DataFrame, il: DataFrame, p: Params) -> DataFrame:
    """The item lookup, of one row per item, on rows of L5 that came without it."""
    e = F.lit("")
    i = il.select(norm_key(F.col("ItemNumber"), p.case_insensitive).alias("_i_key"),
                  varchar(F.coalesce("ItemDescription", e), 500).alias("_i_desc"), varchar(F.coalesce("UOMSCHDL", e), 50).alias("_i_uom")).hint("shuffle_hash")
    return (led.join(i, norm_key(F.col("ITEMNMBR"), p.case_insensitive) == F.col("_i_key"), "left")
            .withColumns({"ItemDescription": F.coalesce("_i_desc", e), "UOMSCHDL": F.coalesce("_i_uom", e)})
            .drop("_i_key", "_i_desc", "_i_uom"))


def open_mo_issues(mo_issues: DataFrame, mo_status: DataFrame, p: Params) -> DataFrame:
    """Issue rows whose manufacture order is open (status 2 or 3); semi join.  ``_mo`` is
    the order's key, by which the rows are dealt out then."""
    ci = p.case_insensitive
    w = mo_status.where(F.col("MANUFACTUREORDERST_I").isin(*OPEN_MO_STATUSES)) \
        .select(norm_key(F.trim("MANUFACTUREORDER_I"), ci).alias("_wo"))
    return mo_issues.withColumn("_mo", norm_key(F.trim("MANUFACTUREORDER_I"), ci)).join(w, F.col("_mo") == F.col("_wo"), "left_semi")


def issue_metrics(issues: DataFrame) -> DataFrame:
    """Total issued and remaining requirement."""
    iss, bf = F.col("QTY_ISSUED_I"), F.col("QTY_BACKFLUSHED_I")
    return issues.select(
        *[c for c in issues.columns if c == "_mo"], F.trim("MANUFACTUREORDER_I").alias("CleanMO"), F.trim("ITEMNMBR").alias("ITEMNMBR"),
        F.to_date("MRPISSUEDATE_I").alias("MRP_IssueDate"), "WCID_I",
        (iss + bf).alias("Total_Issued"),
        (F.col("MRPAMOUNT_I") - F.col("ATYALLOC") - iss - bf).alias("Remaining_Required"),
        F.col("MRPAMOUNT_I").alias("Required_Qty"))


def rank_issues(m: DataFrame, p: Params) -> DataFrame:
    """L8 + R1: the issue rows that can match.

    rn_qty = 1: latest row per (MO, item, required qty); rn_any = 1: per
    (MO, item) the issued row first, then largest |qty|, then latest date.
    Both are least rows under an order written as a struct.  One aggregate per (MO,
    item, required qty), combined map-side, finds the group's first row by either
    order; the best of these by the second order is the (MO, item)'s.  Rows carry
    their flags (0/1): a row that is first by both comes once, and rows identical
    in every column count once, which makes the match deterministic where the
    source's choice among identical rows is not.
    """
    ci = p.case_insensitive
    mo = F.col("_mo") if "_mo" in m.columns else norm_key(F.col("CleanMO"), ci).alias("_mo")
    keys = [mo, norm_key(F.col("ITEMNMBR"), ci).alias("_it")]

    def last(c: Column) -> list[Column]:
        """Descending, NULL last."""
        return [c.isNull(), -c]
    by_date = [*last(F.unix_date("MRP_IssueDate")), *ordered(("WCID_I",), p.collation), *last(F.col("Total_Issued")), F.col("Remaining_Required")]
    by_use = [F.when(F.col("Total_Issued") > 0, 1).otherwise(2), *last(F.abs(F.col("Required_Qty"))), *by_date]
    row = F.struct(*[c for c in m.columns if c != "_mo"])
    g = m.groupBy(*keys, "Required_Qty").agg(
        F.min(F.struct(named_struct(by_date).alias("o"), row.alias("r"))).alias("q"),
        F.min(F.struct(named_struct(by_use).alias("o"), row.alias("r"))).alias("a"))
    g = g.withColumn("best", F.min("a").over(Window.partitionBy("_mo", "_it"))["r"])
    both = F.col("q.r").eqNullSafe(F.col("best"))

    def flagged(r: str, qty: int, any_: Column) -> Column:
        return F.struct(F.col(r).alias("r"), F.lit(qty).alias("rn_qty"), any_.cast("int").alias("rn_any"))
    more = F.when(F.col("a.r").eqNullSafe(F.col("best")) & ~both, flagged("best", 0, F.lit(1)))
    return (g.select(F.explode(F.array_compact(F.array(flagged("q.r", 1, both), more))).alias("x"))
            .select("x.r.*", "x.rn_qty", "x.rn_any"))


def match_issues(core: DataFrame, ranked: DataFrame, p: Params, dealt: bool = False) -> DataFrame:
    """Core ⟕ issues on (order, item) and (exact qty & rn_qty=1 or rn_any=1).

    A core row can match two issue rows (T7) and then appears twice.  The issue's
    order number is only trimmed, as in the source, unless ``normalize_issue_mo``.  If the
    core rows are ``dealt`` out by their clean order, the issues go there."""
    ci = p.case_insensitive
    mo = clean_order(F.col("CleanMO"), ci) if p.normalize_issue_mo else F.col("CleanMO")
    r = ranked.select(norm_key(mo, ci).alias("_mo"),
                      norm_key(F.col("ITEMNMBR"), ci).alias("_it"),
                      F.col("MRP_IssueDate").alias("_ml_date"), F.col("WCID_I").alias("_ml_wc"),
                      F.col("Total_Issued").alias("_ml_issued"),
                      F.col("Remaining_Required").alias("_ml_rem"),
                      F.col("Required_Qty").alias("_ml_req"), "rn_qty", "rn_any")
    if dealt:
        r = r.repartition("_mo")
    # N1 leaves a clean order number that is its own key
    cond = ((core.CleanOrder == r._mo) & (norm_key(core.CleanItem, ci) == r._it)
            & (((core.CleanDeductions == r._ml_req) & (r.rn_qty == 1)) | (r.rn_any == 1)))
    return core.join(r, cond, "left")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def issue_flags(df: DataFrame, p: Params) -> DataFrame:
    """L10 + L11: issue columns, flags and the Unified_Value audit key."""
    issued = F.coalesce(F.col("_ml_issued"), F.lit(0))
    # both flags read it, on rows that met an issue
    df = df.withColumn("_dx", F.when(F.col("_ml_date").isNotNull() | (issued > 0), try_date(F.col("Date_Expiry"), p.date_formats)))
    dx = F.col("_dx")
    early_cut = F.lit(p.today - dt.timedelta(days=p.early_issue_days))
    uv_tail = F.when(F.col("_ml_req").isNull(), _text(F.col("CleanDeductions"))) \
        .otherwise(_text(F.col("_ml_req") - F.col("_ml_issued")))
    return df.withColumns({
        "MRP_IssueDate": F.coalesce(F.col("_ml_date"), F.lit(NO_ISSUE_DATE)),
        "WCID_From_MO": F.coalesce(F.col("_ml_wc"), F.lit("")),
        "Issued": issued,
        "Remaining": F.coalesce(F.col("_ml_rem"), F.lit(0)),
        "Has_Issued": F.when(issued > 0, YES).otherwise(NO),
        "IssueDate_Mismatch": F.when(F.col("_ml_date").isNull() | F.col("Date_Expiry").isNull(), NO)
                               .when(F.col("_ml_date") != dx, YES).otherwise(NO),
        "Early_Issue_Flag": F.when((issued > 0) & F.col("Date_Expiry").isNotNull() & (dx < early_cut),
                                   YES).otherwise(NO),
        "Unified_Value": F.concat(_text(F.col("ITEMNMBR")), F.lit(SEP), _text(F.col("Date_Expiry")),
                                  F.lit(SEP), uv_tail),
    })


V1_COLUMNS = ["ITEMNMBR", "ItemDescription", "UOM", "ORDERNUMBER", "Construct", "DUEDATE",
              "Expiry_Dates", "Date_Expiry", "BEG_BAL", "Deductions", "Expiry", "POs",
              "Running_Balance", "MRP_IssueDate", "WCID_From_MO", "Issued", "Remaining",
              "Has_Issued", "IssueDate_Mismatch", "Early_Issue_Flag", "VendorItem", "PRIME_VNDR",
              "PURCHASING_LT", "PLANNING_LT", "ORDER_POINT_QTY", "SAFETY_STOCK", "FG", "FG_Desc",
              "STSDESCR", "MRPTYPE", "Unified_Value"]


def order_slice(t: dict[str, DataFrame], p: Params, part: Slice) -> dict[str, DataFrame]:
    """The tables with the rows of the orders in a slice.

    Demand meets FG rows and issues of its clean order number only, and L5 compares rows
    of one order number, which has one clean number; none and a blank one are one slice's."""
    ci = p.case_insensitive

    def rows(name: str, order: Column) -> DataFrame:
        return part.rows(t[name], F.coalesce(norm_key(order, ci), F.lit("")))

    def mo(c: str) -> Column:
        return clean_order(F.trim(c), ci) if p.normalize_issue_mo else F.trim(c)
    return t | {"planning": rows("planning", clean_order(F.col("ORDERNUMBER"), ci)),
                "fg_orders": rows("fg_orders", clean_order(F.col("ORDERNUMBER"), ci)),
                "mo_issues": rows("mo_issues", mo("MANUFACTUREORDER_I")), "mo_status": rows("mo_status", mo("MANUFACTUREORDER_I"))}


def demand_ledger_dealt(t: dict[str, DataFrame], p: Params,
                        cut: Callable[[DataFrame, str], DataFrame] = no_cut, part: Slice = WHOLE) -> DataFrame:
    """``demand_ledger`` with two exchanges of the demand rows: by clean order for their choice, FG rows and
    issues alike, and by item for the description.  Rows without an order number go apart, as in ``core_ledger``.

    Issues are dealt out by their manufacture order once, for both ranks; ``cut`` stores them ranked."""
    t = order_slice(t, p, part)
    pn = filter_demand(t["planning"], p)
    issues = issue_metrics(open_mo_issues(t["mo_issues"], t["mo_status"], p))
    ranked = cut(rank_issues(issues, p), "ranked_issues")
    il = first_description(item_lookup(t["vendor_items"], p), p)
    rows = (match_issues(named_ledger(pn, t["fg_orders"], p), ranked, p, dealt=True)
            .unionByName(match_issues(loose_ledger(pn, t["fg_orders"], p), ranked, p)))
    return shown(described(rows, il, p), p)


def shown(matched: DataFrame, p: Params) -> DataFrame:
    """View 1 of core rows with their issues."""
    return issue_flags(matched, p).select(
        "ITEMNMBR", "ItemDescription", F.col("UOMSCHDL").alias("UOM"), "ORDERNUMBER", "Construct",
        "DUEDATE", "Expiry_Dates", "Date_Expiry", varchar(F.col("BEG_BAL_Num"), 50).alias("BEG_BAL"),
        F.col("Original_Deductions").alias("Deductions"), F.col("Original_Expiry").alias("Expiry"),
        F.col("Original_POs").alias("POs"), F.col("Original_Running_Balance").alias("Running_Balance"),
        *V1_COLUMNS[13:])


def demand_ledger(t: dict[str, DataFrame], p: Params,
                  cut: Callable[[DataFrame, str], DataFrame] = no_cut, part: Slice = WHOLE) -> DataFrame:
    """V1: the demand ledger, 31 columns.

    ``cut`` stores a step under a name: the core ledger and the ranked issues, so that the exchanges of one step are gone
    before the next one has its own.  ``part`` is a slice of the orders."""
    t = order_slice(t, p, part)
    pn = filter_demand(t["planning"], p)
    core = cut(core_ledger(pn, t["fg_orders"], t["vendor_items"], p), "core_ledger")
    # The source also left-joins the item master to the issue rows without
    # using a column of it; with one master row per item that join is a no-op
    # and is left out.
    ranked = cut(rank_issues(issue_metrics(open_mo_issues(t["mo_issues"], t["mo_status"], p)), p), "ranked_issues")
    return shown(match_issues(core, ranked, p), p)
