"""The balance scanned in bounded pieces equals the single-window form, also for a hot
item spread over many partitions; the overlay equals its plain product form."""

import datetime as dt
from decimal import Decimal

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_tables
from stockpulse.functions import norm_key
from stockpulse.operators import overlay, suppress
from stockpulse.operators.prefix import balance_offsets, chunk_of
from stockpulse.plans import LedgerRun
from stockpulse.sources.testdata import load_testdata
from stockpulse.sources.testdata import testdata_params as td_params


def _same(a, b):
    cols = sorted(a.columns)
    x = sorted(map(tuple, a.select(*cols).collect()), key=repr)
    y = sorted(map(tuple, b.select(*cols).collect()), key=repr)
    assert x == y


def test_split_equals_window_on_testdata(spark):
    t = load_testdata(spark, SF_SMALL)
    p = td_params()
    a = LedgerRun(t, p, materialize=None, split=True)
    b = LedgerRun(t, p, materialize=None, split=False)
    _same(a.v2_full.drop("Seq", "Demand_Seq"), b.v2_full.drop("Seq", "Demand_Seq"))
    sequences = ["ITEMNMBR", "Seq", "Demand_Seq", "Adjusted_Running_Balance"]
    _same(a.v2_full.select(*sequences), b.v2_full.select(*sequences))
    _same(a.v4, b.v4)
    led = overlay.demand_ledger_frame(b.v2_full)
    supply = overlay.supply_schedule(b.v3, p)
    mine = overlay.demand_rows(overlay.allocate_supply(led, supply, p), p).select(
        "ITEMNMBR", "ORDERNUMBER", F.col("Demand_Seq").alias("W2"), F.col("Stockout_Seq").alias("Out"),
        F.col("Ledger_WFQ_Influx").alias("Influx"))
    _same(mine, _plain_overlay(led, supply, p))
    assert mine.where("Influx > 0").count() > 100


def _hot_rows(n=400, dates="many"):
    """One item; due dates on 120 days, all on one day, or none at all.  Order numbers
    share their first twelve characters."""
    item = "10.HOT"
    planning = [dict(ORDERNUMBER="Beg Bal", ITEMNMBR=item, STSDESCR="Beg Bal", Deductions="0",
                     BEG_BAL="1000", Running_Balance="1000")]
    issues, status = [], []
    bal = 1000
    for i in range(n):
        due = dt.date(2025, 12, 1) + dt.timedelta(days=i % 120 if dates == "many" else 90)
        bal -= 7
        mo = f"PLANT7LINE12{i:05d}"
        rb = "x" if i == 37 else str(bal)  # one unparsable balance (T25)
        planning.append(dict(ORDERNUMBER=f"MO-{mo}", ITEMNMBR=item, STSDESCR="Released",
                             DUEDATE=None if dates == "none" else due,
                             Date_Expiry="N/A" if dates == "none" else due.isoformat(),
                             Deductions="7", Running_Balance=rb))
        issues.append(dict(MANUFACTUREORDER_I=mo, ITEMNMBR=item, WCID_I="WC-W1",
                           MRPISSUEDATE_I=None if dates == "none" else dt.datetime.combine(due, dt.time()),
                           QTY_ISSUED_I=Decimal(i % 3), QTY_BACKFLUSHED_I=Decimal(0),
                           MRPAMOUNT_I=Decimal(7), ATYALLOC=Decimal(0)))
        status.append(dict(MANUFACTUREORDER_I=mo, MANUFACTUREORDERST_I=2))
    lots = [dict(ITEMNMBR=item, LOCNCODE="WF-Q", LOTNUMBR=f"L{k}", EXPNDATE=dt.datetime(2026, 9, 1),
                 DATERECD=dt.datetime(2026, 1, 1), QTYRECVD=Decimal(50 + k), QTYSOLD=Decimal(0))
            for k in range(3)]
    return dict(planning=planning, mo_issues=issues, mo_status=status, lots=lots,
                item_master=[dict(ITEMNMBR=item, UOMSCHDL="EA")],
                bin_stock=[dict(Item_Number=item, SITE="WC-W1", QTY_Available=Decimal(10),
                                DATERECD=dt.datetime(2026, 1, 10))])


def _plain_overlay(led, supply, p):
    """W2, W3 and W5 by single windows and the demand x supply product."""
    k = norm_key(F.col("ITEMNMBR"))
    order = [F.col("DUEDATE"), F.col("ORDERNUMBER").asc_nulls_first(), F.coalesce("Unified_Value", F.lit("")), F.col("Seq")]
    dem = overlay.demand_rows(led, p).withColumn("W2", F.row_number().over(Window.partitionBy(k).orderBy(*order)))
    dem = dem.withColumn("Out", F.min(F.when(F.col("Adjusted_Running_Balance") <= 0, F.col("W2"))).over(Window.partitionBy(k)))
    s = supply.select(norm_key(F.col("ITEMNMBR")).alias("_s"), "Estimated_Release_Date", "WFQ_Qty")
    hit = (k == F.col("_s")) & (F.col("Estimated_Release_Date") <= F.col("DUEDATE").cast("timestamp_ntz")) \
        & (F.col("W2") >= F.col("Out"))
    return (dem.join(s, hit, "left").groupBy("ITEMNMBR", "ORDERNUMBER", "W2", "Out")
            .agg(F.coalesce(F.sum("WFQ_Qty"), F.lit(0)).alias("Influx")))


@pytest.fixture
def uncoalesced(spark):
    """Small tables keep their shuffle partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.usefixtures("uncoalesced")
@pytest.mark.parametrize("dates", ["many", "one", "none"])
def test_hot_item_spans_partitions_and_matches(spark, params, dates):
    t = make_tables(spark, **_hot_rows(1200, dates))
    v1 = LedgerRun(t, params, materialize=None).v1_full
    led = suppress.classify_demand(suppress.with_inventory(
        v1, suppress.wc_inventory(t["bin_stock"], params), params), params).persist()
    plain = suppress.adjusted_balance(led, params)
    cols = ["ORDERNUMBER", "Seq", "RB_Num", "RB_Delta", "RB_Anchor", "Adjusted_Running_Balance", "Demand_Seq"]
    for rows, chunks in ((7, 4), (64, 1024), (100, 1)):
        split = suppress.adjusted_balance_split(led, params, rows, chunks).select(*cols, "Ledger_At")
        _same(split.drop("Ledger_At"), plain.select(*cols))
        assert split.groupBy(chunk_of("Ledger_At", rows)).count().agg(F.max("count")).first()[0] <= rows
    pieces = split.withColumn("part", F.expr("Ledger_At div 8589934592")).agg(F.countDistinct("part")).first()[0]
    assert pieces > 1  # the one hot item lies in several partitions, with one date as well
    led4 = overlay.demand_ledger_frame(suppress.adjusted_balance_split(led, params))
    supply = overlay.supply_schedule(LedgerRun(t, params, materialize=None).v3, params)
    mine = overlay.demand_rows(overlay.allocate_supply(led4, supply, params), params).select(
        "ITEMNMBR", "ORDERNUMBER", F.col("Demand_Seq").alias("W2"), F.col("Stockout_Seq").alias("Out"),
        F.col("Ledger_WFQ_Influx").alias("Influx"))
    _same(mine, _plain_overlay(led4, supply, params))
    assert mine.count() == (0 if dates == "none" else 1200)


def test_offsets_of_chunks_equal_one_scan(spark):
    """The tree of chunk aggregates against a plain loop, with unknown and held values."""
    import random
    rnd = random.Random(9)
    data = [(k, c, rnd.choice([None, 1.0, 2.0, 5.0]), rnd.choice([None, 1.0, 3.0]), rnd.randint(0, 1), float(rnd.randint(-3, 3)), rnd.randint(1, 9))
            for k in "abc" for c in sorted(rnd.sample(range(60), 25))]
    chunks = spark.createDataFrame(data, "k string, c long, first double, last double, held int, total double, n int")

    def step(held, now, before):
        return F.when(held == 1, F.lit(0.0)).otherwise(F.coalesce(now.cast("double") - before.cast("double"), F.lit(0.0)))
    expected = []
    for k in "abc":
        total, n, before, anchor = 0.0, 0, None, None
        for i, (_, c, first, last, held, inner, size) in enumerate(r for r in data if r[0] == k):
            anchor = first if i == 0 else anchor
            lead = 0.0 if i == 0 or held == 1 or first is None or before is None else first - before
            expected.append((k, c, before, lead, total, n, anchor))
            total, n, before = total + lead + inner, n + size, last
    for block in (1, 4, 1000):
        got = balance_offsets(chunks, "k", "c", step, ["n"], block).select("k", "c", "before", "lead", "off_total", "off_n", "anchor")
        assert sorted(map(tuple, got.collect())) == sorted(expected)
