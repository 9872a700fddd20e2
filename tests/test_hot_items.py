"""A run that splits only hot items equals the run that splits all, and deals its ledger out by item once."""

import datetime as dt
from decimal import Decimal

import pytest

from conftest import make_tables
from stockpulse.operators import overlay, suppress
from stockpulse.plans import LedgerRun, views


def tables(spark):
    """Items of one to twenty rows, with spellings, copies, blank orders, no dates, unknown balances, stock and lots."""
    planning = [dict(ORDERNUMBER=o, ITEMNMBR=i, STSDESCR=s, DUEDATE=None if n % 6 == 5 else dt.date(2026, 1, 1) + dt.timedelta(days=25 * n), Date_Expiry="2026-01-07",
                     Deductions="4", Running_Balance="x" if n == 3 else str(9 - 3 * n), POs="2", PRIME_VNDR=v)
                for n, (o, s, v) in enumerate((("MO-1", "Released", "V1"), ("mo 1", "Firm", "V1 "), ("MO-2", "Released", None), ("", "Released", "V2"),
                                               (None, "Firm", "V1"), ("MO-3", "Released", "v1"), ("MO-4", "Released", "V1")))
                for i in ("10.1", "10.1 ", "a1", "A1", " 10.1", "10.3")[: 6 - n % 3]]
    planning += [dict(ORDERNUMBER="Beg Bal", ITEMNMBR=i, STSDESCR="Beg Bal", Deductions="0", BEG_BAL="7", Running_Balance="7")
                 for i in ("10.1", "A1", "10.9")]
    fg = [dict(ORDERNUMBER=o, FG=f, Customer=c, FG_Desc="d") for o, c in (("MO1", "Acme"), ("MO-2", "acme "), ("", "Best")) for f in ("F1", "F2", None)]
    issues = [dict(MANUFACTUREORDER_I=str(m), ITEMNMBR=i, WCID_I=w, QTY_ISSUED_I=Decimal(m % 2), MRPAMOUNT_I=Decimal(4), QTY_BACKFLUSHED_I=Decimal(0),
                   ATYALLOC=Decimal(0), MRPISSUEDATE_I=dt.datetime(2026, 1, 3)) for m in (1, 2, 3, 4) for i in ("10.1", "a1 ") for w in ("WC-W1", "wc-w2")]
    status = [dict(MANUFACTUREORDER_I=str(m), MANUFACTUREORDERST_I=2) for m in (1, 2, 3, 4)]
    stock = [dict(Item_Number=i, SITE=w, QTY_Available=Decimal(q), DATERECD=dt.datetime(2026, 1, 10))
             for i, q in (("10.1", 2), ("A1", 5)) for w in ("WC-W1", "WC-W2")]
    lots = [dict(ITEMNMBR=i, LOCNCODE="WF-Q", LOTNUMBR=f"L{i}{k}", DATERECD=dt.datetime(2025, 12, 20), QTYRECVD=Decimal(30), QTYSOLD=Decimal(0))
            for i in ("10.1", "A1") for k in range(2)]
    return make_tables(spark, planning=planning, fg_orders=fg, mo_issues=issues, mo_status=status, bin_stock=stock, lots=lots,
                       vendor_items=[dict(Item_Number="10.1", ITEMDESC=d, UOMSCHDL="EA", Active="Yes") for d in ("Nut", "Bolt")])


@pytest.mark.parametrize("kind, slices, hot_rows", [("table", 2, 5), (None, 1, 1000)])
def test_splitting_hot_items_only_gives_the_same_rows(spark, params, monkeypatch, kind, slices, hot_rows):
    monkeypatch.setattr(views, "HOT_ROWS", hot_rows)
    t = tables(spark)
    run, plain = LedgerRun(t, params, materialize=kind, split="hot", slices=slices), LedgerRun(t, params, materialize=None)
    try:
        for view in ("v2", "v4", "v5_rows"):
            a, b = getattr(run, view), getattr(plain, view)
            assert a.columns == b.columns and a.count() > 1 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), view
        kept = ["ITEMNMBR", "ORDERNUMBER", "FG", "Seq", "Demand_Seq", "RB_Num", "RB_Delta", "RB_Anchor", "Adjusted_Running_Balance"]
        assert run.v2_full.select(kept).exceptAll(plain.v2_full.select(kept)).isEmpty()
        assert bool(run._hot) == (hot_rows == 5) and plain.v4.where("Ledger_WFQ_Influx > 0").count() > 1
    finally:
        run.release()


def test_too_many_hot_items_are_all_split(spark, params, monkeypatch):
    monkeypatch.setattr(views, "HOT_ROWS", 1)
    monkeypatch.setattr(suppress, "MAX_HOT", 1)
    t = tables(spark)
    run, plain = LedgerRun(t, params, materialize="table", split="hot", slices=2), LedgerRun(t, params, materialize=None)
    try:
        assert run._hot is None
        for view in ("v2", "v4"):
            a, b = getattr(run, view), getattr(plain, view)
            assert a.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), view
    finally:
        run.release()


def test_view_4_comes_from_view_1_in_one_exchange_by_item(spark, params):
    run = LedgerRun(tables(spark), params, materialize="table", split="hot")
    joins, all_keys = "spark.sql.autoBroadcastJoinThreshold", views.ALL_KEYS
    was = spark.conf.get(joins), spark.conf.get(all_keys, None)
    try:
        run.v4
        path = spark._jvm.org.apache.hadoop.fs.Path(run._scratch)
        stored = {f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}
        assert stored == {"demand_ledger_full", "quarantine_pipe", "extended_ledger"}  # neither a layout nor view 2
        assert spark.conf.get(all_keys, None) == was[1]
        spark.conf.set(joins, "-1")
        spark.conf.set(all_keys, "false")
        v4 = overlay.extended_ledger_by_item(run.v1_full, run.t["bin_stock"], run.v3, params)
        plan = v4._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set(joins, was[0])
        run._restore(all_keys, was[1])
        run.release()
    leaf = next(i for i, line in enumerate(plan) if "FileScan" in line)  # the leftmost: the ledger
    spine, least = [], len(plan[leaf]) - len(plan[leaf].lstrip(" :"))
    for line in reversed(plan[:leaf]):
        at = len(line) - len(line.lstrip(" :"))
        if at < least:
            spine, least = [*spine, line], at
    assert sum("Exchange" in line for line in spine) == 1
    assert sum("Sort [" in line for line in spine) == 2  # the ledger's order, and the groups of the re-attach


def test_reports_store_the_columns_that_they_read(spark, params):
    run, plain = LedgerRun(tables(spark), params, materialize="table", split="hot"), LedgerRun(tables(spark), params, materialize=None)
    try:
        run.deficits
        path = spark._jvm.org.apache.hadoop.fs.Path(run._scratch)
        stored = {f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}
        assert stored == {"demand_ledger_full", "quarantine_pipe", "decision_ledger", "deficit_rows"}
        a, b = run.decisions, plain.v4.select(views.DECISION_COLUMNS)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    finally:
        run.release()
