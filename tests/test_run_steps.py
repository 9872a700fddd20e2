"""A stored run keeps its tables, not the exchanges and steps that made them."""

import datetime as dt
from decimal import Decimal

from conftest import make_tables
from stockpulse.operators import demand
from stockpulse.plans import LedgerRun, views


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def rows():
    planning = [dict(ORDERNUMBER=f"MO-{i % 7}", ITEMNMBR=f"10.{i % 5}", STSDESCR="Released", DUEDATE=dt.date(2026, 1, 1 + i % 20),
                     Deductions="3", Running_Balance=str(9 - i), PRIME_VNDR="V1") for i in range(40)]
    planning += [dict(ORDERNUMBER=o, ITEMNMBR="10.1", STSDESCR="Released", Deductions="1") for o in ("", None, " ")]
    fg = [dict(ORDERNUMBER=f"MO{i}", FG=f"F{k}", Customer="Acme", FG_Desc="d") for i in range(7) for k in range(2)]
    items = [dict(Item_Number=f"10.{i}", ITEMDESC="Bolt", UOMSCHDL="EA", Active="Yes") for i in range(4)]
    stock = [dict(Item_Number="10.1", SITE="WC-W1", QTY_Available=Decimal(5), DATERECD=dt.datetime(2026, 1, 10))]
    return dict(planning=planning, fg_orders=fg, vendor_items=items, bin_stock=stock)


def listed(spark, run):
    path = spark._jvm.org.apache.hadoop.fs.Path(run._scratch)
    return {f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}


def test_stored_run_leaves_no_shuffle_files_and_no_steps(spark, params):
    t = make_tables(spark, **rows())
    before = shuffle_files(spark)
    run = LedgerRun(t, params, materialize="table")
    try:
        run.v4
        assert not shuffle_files(spark) - before
        assert listed(spark, run) == {"demand_ledger_full", "suppressed_ledger_full", "quarantine_pipe", "extended_ledger"}
        lazy = LedgerRun(t, params, materialize=None)
        for a, b in ((run.v1, lazy.v1), (run.v2, lazy.v2), (run.v4, lazy.v4)):
            assert a.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    finally:
        run.release()


def test_run_restores_the_sessions_shuffle_cleanup(spark, params):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    run = LedgerRun(make_tables(spark, **rows()), params, materialize="table")
    try:
        run.v3
        assert spark.conf.get(name, None) == was
    finally:
        run.release()


def test_first_demand_with_and_without_rank(spark, params):
    pn = demand.filter_demand(make_tables(spark, **rows())["planning"], params)
    a, b = (demand.first_demand(pn, params, rank=r) for r in (True, False))
    assert a.count() == 37 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_sliced_run_equals_the_whole_one_and_stores_its_steps_by_slice(spark, params, monkeypatch):
    data = rows()
    data["planning"] += [dict(ORDERNUMBER=o, ITEMNMBR=i, STSDESCR="Released", DUEDATE=dt.date(2026, 1, 9), Deductions="2", Running_Balance="1")
                         for o in ("Beg Bal", "mo 3", "MO-3 ", "#", "MO") for i in ("10.1", " 10.1", "10.2 ", "a1", "A1")]
    data["mo_issues"] = [dict(MANUFACTUREORDER_I=f"{m}{i}", ITEMNMBR=f"10.{i % 5}", WCID_I="WC-W1", QTY_ISSUED_I=Decimal(1), MRPAMOUNT_I=Decimal(k),
                              QTY_BACKFLUSHED_I=Decimal(0), ATYALLOC=Decimal(0)) for i in range(7) for m in ("MO", "mo ", "") for k in (2, 3)]
    data["mo_status"] = [dict(MANUFACTUREORDER_I=f"{m}{i}", MANUFACTUREORDERST_I=2) for i in range(7) for m in ("MO", "mo ", "")]
    data["lots"] = [dict(ITEMNMBR=f"10.{i}", LOCNCODE="WF-Q", LOTNUMBR=f"L{i}{k}", DATERECD=dt.datetime(2026, 1, 2), QTYRECVD=Decimal(9),
                         QTYSOLD=Decimal(0)) for i in range(3) for k in range(2)]
    stored = {}
    store = LedgerRun._store

    def counted(self, df, name, *mode):
        out = store(self, df, name, *mode)
        stored.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(LedgerRun, "_store", counted)
    t = make_tables(spark, **data)
    run, once = (LedgerRun(t, params, materialize="table", slices=n) for n in (2, 1))
    try:
        for view in ("v1", "v2", "v4", "v5", "deficits"):
            a, b = getattr(run, view), getattr(once, view)
            assert a.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), view
        for step in ("core_ledger", "ranked_issues", "stocked_ledger", "covered_ledger"):
            *parts, whole = stored[step]
            assert len(parts) == 2 and 0 < min(parts) and sum(parts) == whole, step
        assert listed(spark, run) == {"demand_ledger_full", "suppressed_ledger_full", "quarantine_pipe", "extended_ledger",
                                      "supply_action", "deficit_rows"}
    finally:
        run.release()
        once.release()


def test_safety_stock_is_stored_before_the_ledger(spark, params, monkeypatch):
    stored = []
    monkeypatch.setattr(LedgerRun, "_store", lambda self, df, name, *mode: stored.append(name) or df)
    monkeypatch.setattr(LedgerRun, "_drop", lambda self, *names: None)
    for view in ("v6", "_v7_rows"):
        stored.clear()
        getattr(LedgerRun(make_tables(spark), params, materialize="table"), view)
        assert stored.index("safety_stock") < stored.index("demand_rows"), view


def test_a_run_is_sliced_by_the_size_of_its_stored_demand(spark, params, tmp_path, monkeypatch):
    t = make_tables(spark, **rows())
    assert LedgerRun(t, params, materialize="table").slices == 1  # rows whose size Spark does not know
    t["planning"].write.parquet(f"{tmp_path}/planning")
    t["planning"] = spark.read.parquet(f"{tmp_path}/planning")
    assert LedgerRun(t, params, materialize="table").slices == 1
    monkeypatch.setattr(views, "SLICE_BYTES", 1000)
    assert LedgerRun(t, params, materialize="table").slices == views.MAX_SLICES
    assert LedgerRun(t, params, materialize=None).slices == 1
