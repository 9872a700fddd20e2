"""Text order by a collation (T1): goldens where it differs from the order of code points."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import make_tables
from stockpulse.functions import collated, text_max
from stockpulse.operators import buyer, demand, risk, suppress
from stockpulse.plans import LedgerRun


@pytest.fixture
def ci(params):
    return replace(params, collation="UNICODE_CI")


def test_text_max_and_order(spark):
    df = spark.createDataFrame([("Zeta",), ("acme",), ("Éclair",), (None,)], "t string")
    assert df.select(text_max("t", None)).first()[0] == "Éclair"
    top = df.select(text_max("t", "UNICODE_CI").alias("t"))
    assert top.first()[0] == "Zeta" and top.schema[0].dataType.simpleString() == "string"
    rows = [r.t for r in df.orderBy(collated(F.col("t"), "UNICODE_CI").asc_nulls_first()).collect()]
    assert rows == [None, "acme", "Éclair", "Zeta"]


def test_first_fg_row_by_collation(spark, params, ci):
    t = make_tables(spark, fg_orders=[dict(ORDERNUMBER="MO-1", FG="F", Customer=c, FG_Desc="d") for c in ("Zeta", "acme", "Beta")])
    pick = lambda p: demand.dedupe_fg(t["fg_orders"], p).first()["Customer"]
    assert (pick(params), pick(ci)) == ("Beta", "acme")
    named = lambda p: demand.named_fg(t["fg_orders"], p).first()["Customer"]
    assert (named(params), named(ci)) == ("Beta", "acme")


def test_ledger_sequence_by_collation(spark, params, ci):
    due = dt.date(2026, 3, 1)
    planning = [dict(ORDERNUMBER=o, ITEMNMBR="10.A", STSDESCR="Open", DUEDATE=due, Deductions="1", Running_Balance=str(9 - i))
                for i, o in enumerate(("C-3", "b-2", "A-1", "ä-4"))]
    t = make_tables(spark, planning=planning)
    for p, want in ((params, ["A-1", "C-3", "b-2", "ä-4"]), (ci, ["A-1", "ä-4", "b-2", "C-3"])):
        for split in (True, False):
            rows = LedgerRun(t, p, materialize=None, split=split).v2_full.orderBy("Seq").collect()
            assert [r.ORDERNUMBER for r in rows] == want


def test_descriptions_and_clients_by_collation(spark, params, ci):
    schema = "ITEMNMBR string, PRIME_VNDR string, ItemDescription string, UOM string, Construct string"
    f = spark.createDataFrame([("10.A", "V1", "Zinc", "EA", "Öl AG"), ("10.A", "V1", "alloy", "kg", "Zeta"), ("10.A", "V1", "alloy", "kg", "acme")], schema)
    def summary(p):
        return risk.client_summary(risk.threatened_clients(f, p), p).select("ItemDescription", "UOM", "Threatened_Clients").first()
    assert tuple(summary(params)) == ("alloy", "kg", "acme, Zeta, Öl AG")
    assert tuple(summary(ci)) == ("Zinc", "kg", "acme, Öl AG, Zeta")


def test_core_ledger_equals_its_plain_form_under_a_collation(spark, ci):
    orders, items = ["MO-1", "mo-1", "", "#"], ["10.A", "10.a "]
    planning = [dict(ORDERNUMBER=orders[i % 4], ITEMNMBR=items[i % 2], STSDESCR=("open", "Open", "Ärger")[i % 3], Deductions=str(i % 5),
                     PRIME_VNDR=("v", "V")[i % 2]) for i in range(60)]
    fg = [dict(ORDERNUMBER=orders[i % 4], FG=("f", "F ", None, "")[i % 4], Customer=("Zeta", "acme", "ACME")[i % 3], FG_Desc=("x", "B")[i % 2])
          for i in range(40)]
    lookup = [dict(Item_Number="10.A", ITEMDESC=d, UOMSCHDL="EA", Active="Yes") for d in ("Zinc", "alloy", "Alloy")]
    t = make_tables(spark, planning=planning, fg_orders=fg, vendor_items=lookup)
    pn = demand.filter_demand(t["planning"], ci)
    a = demand.core_ledger(pn, t["fg_orders"], t["vendor_items"], ci)
    b = demand.dedupe_ledger(demand.join_demand(pn, demand.dedupe_fg(t["fg_orders"], ci), demand.item_lookup(t["vendor_items"], ci), ci), ci)
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() >= 3


def test_buyer_rows_tie_by_collation(spark, params, ci):
    df = spark.createDataFrame([("PLAN", 1.0, dt.date(2026, 1, 1), v, "10.A", 1.0, Decimal(1), Decimal(1)) for v in ("Zeta", "acme")],
                               "Urgency string, Vendor_Total_Exposure double, Earliest_Demand_Date date, PRIME_VNDR string, ITEMNMBR string, "
                               "Recommended_PO_Qty double, Unit_Cost decimal(18,6), Total_Carrying_Cost decimal(18,2)")
    assert [r.PRIME_VNDR for r in buyer.buyer_sort(df, params).collect()] == ["Zeta", "acme"]
    assert [r.PRIME_VNDR for r in buyer.buyer_sort(df, ci).collect()] == ["acme", "Zeta"]


def test_issue_pick_by_collation(spark, params, ci):
    rows = [("1", "A", dt.date(2026, 1, 1), w, Decimal(1), Decimal(1), Decimal(5)) for w in ("WC-Z", "wc-a")]
    m = spark.createDataFrame(rows, "CleanMO string, ITEMNMBR string, MRP_IssueDate date, WCID_I string, Total_Issued decimal(21,5), "
                                    "Remaining_Required decimal(23,5), Required_Qty decimal(19,5)")
    assert [[r.WCID_I for r in demand.rank_issues(m, p).collect()] for p in (params, ci)] == [["WC-Z"], ["wc-a"]]
    assert suppress.ledger_order(ci)
