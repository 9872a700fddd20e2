"""What goes through the exchanges of the core ledger and of view 4."""

import datetime as dt

from conftest import make_tables
from stockpulse.operators import demand, overlay
from stockpulse.plans import LedgerRun


def tables(spark):
    planning = [dict(ORDERNUMBER=o, ITEMNMBR=f"10.{i}", STSDESCR=s, DUEDATE=dt.date(2026, 1, 1 + i), Deductions=str(i),
                     BEG_BAL="7", Running_Balance=str(9 - i), PRIME_VNDR="V1")
                for i in range(6) for o in ("Beg Bal", "beg bal ", "BEG-BAL", "MO-1", "mo 1", "MO-2", "", None, "#")
                for s in ("Released", "Firm")]
    fg = [dict(ORDERNUMBER=o, FG=f, Customer=c, FG_Desc="d")
          for o in ("Beg Bal", "begbal", "MO1", "MO-1", "", "MO-#", None) for f in ("F1", "f1 ", "", None) for c in ("Acme", "Best")]
    items = [dict(Item_Number=f"10.{i}", ITEMDESC=d, UOMSCHDL="EA", Active="Yes") for i in range(4) for d in ("Bolt", "Nut")]
    return make_tables(spark, planning=planning, fg_orders=fg, vendor_items=items)


def test_beginning_balances_with_an_fg_order_of_their_name(spark, params):
    t = tables(spark)
    pn = demand.filter_demand(t["planning"], params)
    whole = demand.dedupe_ledger(demand.join_demand(
        pn, demand.dedupe_fg(t["fg_orders"], params), demand.item_lookup(t["vendor_items"], params), params), params)
    core = demand.core_ledger(pn, t["fg_orders"], t["vendor_items"], params)
    assert core.where("CleanOrder = 'BEGBAL' AND FG = 'F1'").count() > 0
    assert core.count() == whole.count()
    assert core.exceptAll(whole).isEmpty() and whole.exceptAll(core).isEmpty()


def test_demand_is_dealt_out_once_for_its_choice_and_the_fg_join(spark, params):
    t = tables(spark)
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        core = demand.core_ledger(demand.filter_demand(t["planning"], params), t["fg_orders"], t["vendor_items"], params)
        plan = core._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set(name, was)
    at = next(i for i, line in enumerate(plan) if "SortMergeJoin [CleanOrder" in line)
    choice = next(i for i, line in enumerate(plan) if i > at and "Window [lag" in line)
    assert not [line for line in plan[at:choice] if "Exchange" in line or "+- Sort [" in line or ":- Sort [" in line]


def test_no_exchange_of_the_core_ledger_carries_a_row_for_each_fg(spark, params):
    t = tables(spark)
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        core = demand.core_ledger(demand.filter_demand(t["planning"], params), t["fg_orders"], t["vendor_items"], params)
        plan = core._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set(name, was)
    fg = next(i for i, line in enumerate(plan) if "SortMergeJoin [CleanOrder" in line)
    assert fg < next(i for i, line in enumerate(plan) if "Exchange" in line)
    assert next(i for i, line in enumerate(plan) if "SortMergeJoin [upper(rtrim(ITEMNMBR" in line) > fg


def test_view_4_stores_only_the_columns_it_needs(spark, params):
    run = LedgerRun(tables(spark), params, materialize=None)
    stored = {}

    def cut(df, name):
        stored[name] = df.columns
        return df
    v4 = overlay.extended_ledger(run.v2_full, run.v3, params, cut)
    assert v4.columns == overlay.V4_COLUMNS
    assert set(stored["covered_ledger"]) == set(overlay.V4_COLUMNS) - {"Ledger_Extended_Balance", "WFQ_Extended_Status"} | {"Seq"}


def test_issues_are_exchanged_once_for_open_orders_and_ranks(spark, params):
    t = tables(spark)
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        ranked = demand.rank_issues(demand.issue_metrics(demand.open_mo_issues(t["mo_issues"], t["mo_status"], params)), params)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, was)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2  # issues and order states
