"""

Every query reads the driver's tables through the test-data adapter (whole
tables, no sampling) and runs the library's operators.  ``oracle_sql()``
gives independent DuckDB SQL for each (see ``oracle_sql.py``).  Non-integer
numeric columns are reported as DOUBLE rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import atexit
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_sql as O  # noqa: E402
from stockpulse.functions import try_date  # noqa: E402
from stockpulse.operators import (  # noqa: E402
    action, buyer, demand, overlay, risk, safety, suppress)
from stockpulse.plans import LedgerRun  # noqa: E402
from stockpulse.plans import reports as R  # noqa: E402
from stockpulse.sources.testdata import load_testdata, testdata_params  # noqa: E402

FLAGSHIP_SF = "/root/testdata/sf0.001"

V2_NUM = ["Adjusted_Running_Balance", "Issued", "Remaining", "Net_Demand", "Inventory_Qty_Available",
          "Remaining_After_Suppression"]
V4_NUM = ["Adjusted_Running_Balance", "Issued", "Original_Required", "Net_Demand",
          "Inventory_Qty_Available", "Ledger_WFQ_Influx", "Ledger_Extended_Balance"]
V5_NUM = V4_NUM + ["Deficit_Qty", "POs_On_Order_Qty", "Additional_Order_Qty"]
VS_NUM = ["TotalQtyShipped", "TotalCost", "AverageCost", "AvgWeeklyDemand", "StdDevWeekly",
          "MaxWeeklyDemand", "CalculatedSS_MfgUOM", "SSValue", "PURUOM", "CalculatedSS_PurchasingUOM"]
V7_NUM = ["Recommended_PO_Qty", "Vendor_Total_Exposure", "CalculatedSS_PurchasingUOM", "Holding_Cost_Pct",
          "Unit_Cost", "Holding_Cost_Annual", "Order_Cost_Estimate", "Total_Carrying_Cost",
          "Recommended_PO_Qty_Optimized"]


_RUNS: dict[tuple[str, str], LedgerRun] = {}


def _run(spark: SparkSession, sf_dir: str) -> LedgerRun:
    """One run per (session, data dir): the shared intermediates (views 2, 4,
    5 and safety stock) are computed once for all registered queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        # tables in the session's shared folder, or a cache when it names none
        _RUNS[key] = LedgerRun(load_testdata(spark, sf_dir), testdata_params(), split="hot")
        atexit.register(_RUNS[key].release_quietly)
    return _RUNS[key]


def _norm(df: DataFrame, numeric: list[str]) -> DataFrame:
    if not numeric:
        return df
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in numeric})


# name -> (spark builder taking a LedgerRun, oracle final select, oracle deps, numeric columns)
_Q: dict[str, tuple[Callable[[LedgerRun], DataFrame] | None, str, list[str], list[str]]] = {}


def _reg(name: str, build: Callable[[LedgerRun], DataFrame] | None, sql: str, deps: list[str],
         numeric: list[str] | None = None) -> None:
    _Q[name] = (build, sql, deps, numeric or [])


# ---- composed outputs
_reg("v1_demand_ledger", lambda r: r.v1, "SELECT * FROM v1", ["v1"], ["Issued", "Remaining"])
_reg("v2_suppressed_ledger", lambda r: r.v2, "SELECT * FROM v2", ["v2"], V2_NUM)
_reg("v3_quarantine_pipe", lambda r: r.v3, "SELECT * FROM v3", ["v3"], ["QTY_ON_HAND"])
_reg("v4_extended_ledger", lambda r: r.v4, "SELECT * FROM v4", ["v4"], V4_NUM)
_reg("v5_supply_action", lambda r: r.v5_rows,
     f"SELECT {', '.join(O.V5_COLS)} FROM v5", ["v5"], V5_NUM)
_reg("vs_safety_stock", lambda r: r.vs, "SELECT * FROM ss_calc", ["ss_calc"], VS_NUM)
_reg("v6_run_risk", lambda r: r.v6, "SELECT * FROM v6", ["v6"], ["Total_Deficit_Qty"])
_reg("v7_buyer_control", lambda r: r.v7(), "SELECT * FROM v7", ["v7"], V7_NUM)

# ---- operator-level tables
_L1 = ["ORDERNUMBER", "ITEMNMBR", "STSDESCR", "CleanOrder", "CleanItem", "CleanDeductions"]
_reg("n4_text_dates",
     lambda r: r.t["planning"].select("ORDERNUMBER", "ITEMNMBR", "Date_Expiry", try_date(F.col("Date_Expiry")).alias("Expiry_Date")),
     f"SELECT ORDERNUMBER, ITEMNMBR, Date_Expiry, {O.date_of('Date_Expiry')} AS Expiry_Date FROM planning", ["planning"])
_reg("l1_demand_filter", lambda r: demand.filter_demand(r.t["planning"], r.p).select(*_L1),
     f"SELECT {', '.join(_L1)} FROM demand", ["demand"], ["CleanDeductions"])
_reg("l2_fg_map", lambda r: demand.dedupe_fg(r.t["fg_orders"], r.p),
     "SELECT CleanOrder, ORDERNUMBER, FG, Customer, FG_Desc FROM fg_map", ["fg_map"])
_reg("l3_item_lookup", lambda r: demand.item_lookup(r.t["vendor_items"], r.p),
     "SELECT * FROM active_items", ["active_items"])
_L5 = ["ORDERNUMBER", "FG", "ITEMNMBR", "Construct", "FG_Desc", "ItemDescription", "UOMSCHDL",
       "STSDESCR", "DUEDATE", "Original_Running_Balance", "CleanOrder", "CleanItem", "CleanDeductions",
       "BEG_BAL_Num"]


def _core(r: LedgerRun) -> DataFrame:
    t, p = r.t, r.p
    pn = demand.filter_demand(t["planning"], p)
    return demand.core_ledger(pn, t["fg_orders"], t["vendor_items"], p)


_reg("l5_core_ledger", lambda r: _core(r).select(*_L5), f"SELECT {', '.join(_L5)} FROM ledger", ["ledger"],
     ["CleanDeductions", "BEG_BAL_Num"])
_L8 = ["CleanMO", "ITEMNMBR", "MRP_IssueDate", "WCID_I", "Total_Issued", "Remaining_Required",
       "Required_Qty", "rn_qty", "rn_any"]
_reg("l8_ranked_issues",
     lambda r: demand.rank_issues(demand.issue_metrics(
         demand.open_mo_issues(r.t["mo_issues"], r.t["mo_status"], r.p)), r.p).select(*_L8),
     f"SELECT {', '.join(_L8)} FROM issue_picks", ["issue_picks"],
     ["Total_Issued", "Remaining_Required", "Required_Qty"])
_reg("i1_wc_inventory", lambda r: suppress.wc_inventory(r.t["bin_stock"], r.p),
     "SELECT * FROM stock", ["stock"], ["Total_QTY_Available"])
_I10 = ["ITEMNMBR", "ORDERNUMBER", "Seq", "RB_Num", "RB_Delta", "RB_Anchor", "Is_Suppressed",
        "Adjusted_Running_Balance"]
_reg("i10_adjusted_balance", lambda r: r.v2_full.select(*_I10),
     f"SELECT {', '.join(_I10)} FROM v2full", ["v2full"],
     ["RB_Num", "RB_Delta", "RB_Anchor", "Adjusted_Running_Balance"])


def _alloc(r: LedgerRun) -> DataFrame:
    led = overlay.demand_ledger_frame(r.v2_full)
    return overlay.demand_rows(overlay.allocate_supply(led, overlay.supply_schedule(r.v3, r.p), r.p), r.p)


_reg("w3_first_stockout",
     lambda r: _alloc(r).select("ITEMNMBR", "ORDERNUMBER", "DUEDATE", "Demand_Seq", "Stockout_Seq"),
     "SELECT ITEMNMBR, ORDERNUMBER, DUEDATE, Demand_Seq, Stockout_Seq FROM covered", ["covered"])
_reg("w4_supply_schedule", lambda r: overlay.supply_schedule(r.v3, r.p),
     "SELECT Item_Number AS ITEMNMBR, SITE, Estimated_Release_Date, WFQ_Qty FROM supply", ["supply"], ["WFQ_Qty"])
_reg("w5_allocate_supply",
     lambda r: _alloc(r).select("ITEMNMBR", "Demand_Seq", "DUEDATE",
                                F.col("Adjusted_Running_Balance").alias("Ledger_Base_Balance"),
                                "Stockout_Seq", "Ledger_WFQ_Influx"),
     "SELECT ITEMNMBR, Demand_Seq, DUEDATE, Adjusted_Running_Balance AS Ledger_Base_Balance, Stockout_Seq, "
     "Ledger_WFQ_Influx FROM covered", ["covered"], ["Ledger_Base_Balance", "Ledger_WFQ_Influx"])
_reg("a4_turnaround", lambda r: action.turnaround(r.v3, r.p), "SELECT * FROM turnaround", ["turnaround"])
_reg("k1_avg_receipt_cost",
     lambda r: safety.avg_receipt_cost(r.t["receipts"], r.t["receipt_lines"], r.p),
     "SELECT * FROM avg_cost", ["avg_cost"], ["TotalQtyShipped", "TotalCost", "AverageCost"])
_reg("k2_weekly_demand", lambda r: safety.weekly_demand(r.t["consumption"], r.p),
     "SELECT * FROM weekly_demand", ["weekly_demand"], ["WeeklyDemand"])
_reg("k3_demand_stats",
     lambda r: safety.demand_stats(safety.weekly_demand(r.t["consumption"], r.p), r.p),
     "SELECT * FROM demand_stats", ["demand_stats"],
     ["AvgWeeklyDemand", "StdDevWeekly", "MaxWeeklyDemand", "TotalDemand"])
_reg("r3_client_summary",
     lambda r: risk.client_summary(risk.threatened_clients(r.deficits, r.p), r.p),
     "SELECT * FROM client_summary", ["client_summary"])
_R4 = ["ITEMNMBR", "PRIME_VNDR", "ItemDescription", "UOM", "First_Stockout_Date", "Total_Deficit_Qty",
       "WFQ_Dependency_Flag"]
_reg("r4_risk_metrics", lambda r: risk.risk_metrics(r.deficits, r.p),
     f"SELECT {', '.join(_R4)} FROM risk_rows", ["risk_rows"], ["Total_Deficit_Qty"])
_reg("b2_consolidate", lambda r: buyer.consolidate(r.vs_first().deficits, r.vs, r.decisions, r.p),
     "SELECT * FROM buys", ["buys"],
     ["Total_Deficit_Qty", "CalculatedSS_PurchasingUOM", "Annual_Demand_Estimate"])
_reg("b3_po_unit_cost",
     lambda r: buyer.po_unit_cost(r.t["receipt_lines"], r.p).select(
         F.col("_p_item").alias("ITEMNMBR"), F.col("_p_vnd").alias("PRIME_VNDR"),
         F.col("_p_cost").alias("UnitCost")),
     "SELECT * FROM po_cost", ["po_cost"], ["UnitCost"])

# ---- documented reports and checks
_reg("p1_critical_items", lambda r: R.critical_items(r.v6),
     "SELECT * FROM v6 WHERE Schedule_Threat = 1", ["v6"], ["Total_Deficit_Qty"])
_reg("p2_rescue_dependent", lambda r: R.rescue_dependent(r.v6),
     "SELECT * FROM v6 WHERE WFQ_Dependency_Flag = 1", ["v6"], ["Total_Deficit_Qty"])
_reg("p3_high_impact", lambda r: R.high_impact(r.v6),
     "SELECT * FROM v6 WHERE Client_Exposure_Count >= 5", ["v6"], ["Total_Deficit_Qty"])
_reg("p4_place_now", lambda r: R.place_now(r.v7()),
     "SELECT * FROM v7 WHERE Urgency = 'PLACE_NOW'", ["v7"], V7_NUM)
_reg("p5_high_consolidation", lambda r: R.high_consolidation(r.v7()),
     "SELECT * FROM v7 WHERE Demand_Lines_In_Bucket >= 10", ["v7"], V7_NUM)
_reg("p6_vendor_exposure_summary", lambda r: R.vendor_exposure_summary(r.v7(sort=False)),
     f"SELECT {O.spelled('PRIME_VNDR')}, MAX(Vendor_Total_Exposure) AS Total_Exposure, COUNT(*) AS Item_Count "
     f"FROM v7 GROUP BY {O.key('PRIME_VNDR')}", ["v7"], ["Total_Exposure"])
_reg("p7_action_sample", lambda r: R.action_sample(r.action_rows),
     "SELECT ITEMNMBR, Supply_Action_Recommendation, Additional_Order_Qty FROM v5 ORDER BY "
     "ITEMNMBR NULLS FIRST, Supply_Action_Recommendation NULLS FIRST, Additional_Order_Qty NULLS FIRST "
     "LIMIT 10", ["v5"], ["Additional_Order_Qty"])
_reg("d1_row_counts",
     lambda r: R.row_counts({"supply_action": r.vs_first().action_rows, "run_risk": r.v6, "buyer_control": r.v7(sort=False)}),
     "SELECT 'supply_action' AS View_Name, COUNT(*) AS Row_Count FROM v5 UNION ALL "
     "SELECT 'run_risk', COUNT(*) FROM v6 UNION ALL SELECT 'buyer_control', COUNT(*) FROM v7",
     ["v5", "v6", "v7"])
_reg("d2_null_vendors", lambda r: R.null_vendor_counts(r.v6, r.v7(sort=False)),
     "SELECT 'run_risk' AS View_Name, COUNT(*) FILTER (WHERE PRIME_VNDR IS NULL) AS Null_Vendors FROM v6 "
     "UNION ALL SELECT 'buyer_control', COUNT(*) FILTER (WHERE PRIME_VNDR IS NULL) FROM v7", ["v6", "v7"])
_D3 = ["Supply_Action_Recommendation", "Deficit_Qty", "POs_On_Order_Qty", "Additional_Order_Qty",
       "WFQ_Extended_Status"]
_reg("d3_action_completeness", lambda r: R.action_completeness(r.action_rows),
     "SELECT COUNT(*) AS Row_Count, " + ", ".join(
         f"COUNT(*) FILTER (WHERE {c} IS NULL) AS Null_{c}" for c in _D3) + " FROM v5", ["v5"])

_reg("d4_rollup_diff",
     lambda r: R.rollup_diff(r.decisions, r.action_rows, ["ITEMNMBR", "PRIME_VNDR"], ["Net_Demand"]),
     "SELECT * FROM rollup_diff", ["rollup_diff"], ["Net_Demand_before", "Net_Demand_after"])
_reg("d4_regression_diff",  # run risk as the source counts it against each ledger row counted once
     lambda r: R.regression_diff(r.v6, r.risk_without_copies, ["ITEMNMBR", "PRIME_VNDR", "ItemDescription", "UOM"]),
     "SELECT * FROM risk_diff", ["risk_diff"], ["Total_Deficit_Qty"])
_reg("d4_vendor_gaps", lambda r: R.vendor_gaps(r.v7(sort=False), [r.decisions, r.vs]),
     "SELECT * FROM vendor_gaps", ["vendor_gaps"])


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the buyer queue (view 7) over sf0.001."""
    return _norm(_run(spark, FLAGSHIP_SF).v7(), V7_NUM)


# ---- training-data queries: only where their subpackage and the pipeline exist
try:
    import corpus_pipeline
    from stockpulse.llm.queries import QUERIES as LLM_QUERIES
    from stockpulse.llm.sql import ORACLE as LLM_ORACLE
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "stockpulse.llm", "stockpulse.llm.queries", "stockpulse.llm.sql"):
        raise
    LLM_QUERIES, LLM_ORACLE = {}, {}
else:
    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLE = LLM_ORACLE | {"pipeline": corpus_pipeline.ORACLE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def make(name: str) -> Callable[[SparkSession, str], DataFrame]:
        build, _, _, numeric = _Q[name]
        return lambda spark, sf_dir: _norm(build(_run(spark, sf_dir)), numeric)
    return {name: make(name) for name, spec in _Q.items() if spec[0] is not None} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    own = {name: O.build(sql, deps, numeric) for name, (_, sql, deps, numeric) in _Q.items()}
    return own | LLM_ORACLE
