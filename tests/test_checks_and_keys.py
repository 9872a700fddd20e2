"""D4 regression diffs, and T1 key collation (trailing blanks, case)."""

import datetime as dt
import os
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_tables
from stockpulse.functions import str_eq, try_decimal
from stockpulse.operators import buyer, demand, risk, safety
from stockpulse.plans import LedgerRun
from stockpulse.plans import reports as R
from stockpulse.sources.io import conform
from stockpulse.sources.testdata import load_testdata
from stockpulse.sources.testdata import testdata_params as td_params
from test_ledger_goldens import ITEM, _rows


def test_regression_diff_and_rollup(spark):
    a = spark.createDataFrame([("V1", "I1", Decimal(5)), ("V1", "I2", Decimal(7)), ("V2", "I3", Decimal(1))],
                              "PRIME_VNDR string, ITEMNMBR string, Total_Deficit_Qty decimal(18,2)")
    assert R.regression_diff(a, a, ["ITEMNMBR"]).count() == 0
    b = a.where("ITEMNMBR <> 'I3'").unionByName(
        spark.createDataFrame([("V2", "I3", Decimal(2))], a.schema))
    d = {r["Side"]: r["ITEMNMBR"] for r in R.regression_diff(a, b, ["ITEMNMBR"]).collect()}
    assert d == {"before": "I3", "after": "I3"}
    roll = R.rollup_diff(a, b, ["PRIME_VNDR"], ["Total_Deficit_Qty"]).collect()
    assert [r["PRIME_VNDR"] for r in roll] == ["V2"]


def test_str_eq_collation(spark):
    df = spark.createDataFrame([("Yes  ",), ("yes",), ("No",), (None,)], "x string")
    got = [r["m"] for r in df.select(str_eq(df.x, "Yes").alias("m")).collect()]
    assert got == [True, True, False, None]
    got_cs = [r["m"] for r in df.select(str_eq(df.x, "Yes", False).alias("m")).collect()]
    assert got_cs == [True, False, False, None]


def test_keys_ignore_trailing_blanks_and_case(spark, params):
    rows = _rows()
    rows["vendor_items"] = [dict(Item_Number=ITEM.lower() + "   ", ITEMDESC="Widget", UOMSCHDL="EACH",
                                 Active="YES ")]
    rows["bin_stock"][0]["SITE"] = "wc-w1 "
    v2 = LedgerRun(make_tables(spark, **rows), params, materialize=None).v2
    got = {r["ORDERNUMBER"]: (r["ItemDescription"], r["Inventory_Qty_Available"]) for r in v2.collect()}
    assert got["MO-A3"] == ("Widget", Decimal(25))


def test_identical_issue_rows_count_once(spark, params):
    rows = _rows()
    a4 = [r for r in rows["mo_issues"] if r["MANUFACTUREORDER_I"] == "A4"][0]
    rows["mo_issues"].append(dict(a4))  # exact duplicate issue row
    v1 = LedgerRun(make_tables(spark, **rows), params, materialize=None).v1
    assert v1.where("ORDERNUMBER = 'MO-A4'").count() == 1


def test_rollup_diff_with_null_keys(spark):
    a = spark.createDataFrame([(None, "I1", Decimal(5)), (None, None, Decimal(1)), ("V1", "I1", None)],
                              "PRIME_VNDR string, ITEMNMBR string, q decimal(18,2)")
    assert R.rollup_diff(a, a, ["PRIME_VNDR", "ITEMNMBR"], ["q"]).count() == 0
    b = a.where("ITEMNMBR IS NOT NULL")
    assert [r["rows_after"] for r in R.rollup_diff(a, b, ["PRIME_VNDR", "ITEMNMBR"], ["q"]).collect()] == [None]


def test_vendor_gaps(spark):
    v7 = spark.createDataFrame([("I1", "UNASSIGNED"), ("I2", "V2"), ("I3", None), ("I4", "UNASSIGNED")],
                               "ITEMNMBR string, PRIME_VNDR string")
    src = spark.createDataFrame([("i1 ", "V9"), ("I1", "V1"), ("I3", None), ("I3", "V3"), ("I4", None)], v7.schema)
    got = {r["ITEMNMBR"]: r["Known_Vendor"] for r in R.vendor_gaps(v7, [src]).collect()}
    assert got == {"I1": "V1", "I3": "V3"}


def _deficits(spark, copies=1):
    """Two deficit rows of one item, with two spellings of its vendor."""
    cols = ("ITEMNMBR PRIME_VNDR ItemDescription UOM Construct Demand_Due_Date Deficit_Qty WFQ_Extended_Status Copies").split()
    rows = [("10.A", "V1", "Widget", "EACH", "Acme", dt.date(2026, 3, 1), Decimal(5), "LEDGER_ONLY"),
            ("10.a ", "v1  ", "WIDGET", "each", "Beta", dt.date(2026, 3, 2), Decimal(7), "LEDGER_ONLY"),
            ("10.A", "V1", "widget ", "EACH ", "ACME", dt.date(2026, 3, 1), Decimal(0), "LEDGER_ONLY")]
    return spark.createDataFrame([(*r, copies) for r in rows], ", ".join(f"{c} {t}" for c, t in zip(cols, (
        "string", "string", "string", "string", "string", "date", "decimal(18,2)", "string", "long"))))


def test_grouping_compares_keys_like_the_joins(spark, params):
    ss = spark.createDataFrame([], "ITEMNMBR string, PRIME_VNDR string, LeadDays int, CalculatedSS_PurchasingUOM double")
    f = _deficits(spark)
    rows = risk.run_risk(f, ss, params).collect()
    assert len(rows) == 1
    assert (rows[0]["Threatened_Clients"], rows[0]["Client_Exposure_Count"], rows[0]["Total_Deficit_Qty"]) == (
        "ACME, Beta", 2, Decimal(12))
    v4 = spark.createDataFrame([("10.A", "V1"), ("10.A", "v1 ")], "ITEMNMBR string, PRIME_VNDR string")
    b2 = buyer.consolidate(f, ss, v4, params).collect()
    assert [r["Total_Deficit_Qty"] for r in b2] == [Decimal(24)]


def test_copies_weigh_the_sums_only(spark, params):
    """A deficit row that view 5 repeats three times counts three times in sums, once elsewhere."""
    ss = spark.createDataFrame([], "ITEMNMBR string, PRIME_VNDR string, LeadDays int, CalculatedSS_PurchasingUOM double")
    row = risk.run_risk(_deficits(spark, 3), ss, params).first()
    assert (row["Total_Deficit_Qty"], row["Client_Exposure_Count"]) == (Decimal(36), 2)
    v4 = spark.createDataFrame([("10.A", "V1"), ("10.A", "v1 ")], "ITEMNMBR string, PRIME_VNDR string")
    b2 = buyer.consolidate(_deficits(spark, 3), ss, v4, params).first()
    assert (b2["Total_Deficit_Qty"], b2["Demand_Lines_In_Bucket"]) == (Decimal(72), 2)


def test_deficits_of_view_4_equal_those_of_view_5(spark):
    t = load_testdata(spark, SF_SMALL)
    for p in (td_params(), td_params(dedupe_timing=True)):
        run = LedgerRun(t, p, materialize=None)
        rows = run.v5.where("Suppression_Status <> 'BEGINNING BALANCE' AND Deficit_Qty > 0 AND Demand_Due_Date IS NOT NULL")
        once = run.deficits
        many = once.select("*", F.explode(F.sequence(F.lit(1), F.col("Copies").cast("int")))).select(*risk.DEFICIT_COLUMNS)
        plain = rows.select(*risk.DEFICIT_COLUMNS)
        assert many.exceptAll(plain).count() == 0 and plain.exceptAll(many).count() == 0
        assert once.count() > 100 and (p.dedupe_timing or many.count() > once.count())


def test_list_of_a_hundred_thousand_clients(spark, params):
    """One (item, vendor) with 100,000 clients, each named three times in other spellings."""
    n = 100_000
    name = F.concat(F.lit("Client "), F.lpad(((F.col("id") * 7919) % n).cast("string"), 6, "0"))
    rows = spark.range(0, 3 * n, 1, 16).select(
        F.lit("10.A").alias("ITEMNMBR"), F.lit("V1").alias("PRIME_VNDR"), F.lit("w").alias("ItemDescription"), F.lit("EA").alias("UOM"),
        F.when(F.col("id") < n, name).when(F.col("id") < 2 * n, F.upper(name)).otherwise(F.concat(name, F.lit(" "))).alias("Construct"))
    row = risk.client_summary(risk.threatened_clients(rows, params), params).first()
    assert row["Client_Exposure_Count"] == n
    assert row["Threatened_Clients"] == ", ".join(f"CLIENT {i:06d}" for i in range(n))


def test_demand_stats_group_spellings_together(spark, params):
    used = spark.createDataFrame(
        [("10.A", "EACH", dt.datetime(2024, 1, 3), Decimal(1)), ("10.a ", "each", dt.datetime(2024, 1, 4), Decimal(2))],
        "Component string, UoM string, IssueDate timestamp_ntz, IssueQty decimal(19,5)")
    weekly = safety.weekly_demand(used, params)
    assert [(r["Component"], r["WeeklyDemand"]) for r in weekly.collect()] == [("10.A", Decimal(3))]
    assert safety.demand_stats(weekly, params).count() == 1


def test_second_safety_stock_row_repeats_the_buyer_row(spark, params):
    """Two safety-stock rows per (item, vendor) with different quantities."""
    ss = spark.createDataFrame(
        [("10.A", "V1", 60, 4.0, Decimal(2), Decimal(8), Decimal(4)), ("10.A", "v1 ", 60, 6.0, Decimal(3), Decimal(8), Decimal(4))],
        "ITEMNMBR string, PRIME_VNDR string, LeadDays int, CalculatedSS_PurchasingUOM double, "
        "AverageCost decimal(38,6), SSValue decimal(18,2), CalculatedSS_MfgUOM decimal(18,6)")
    v4 = spark.createDataFrame([("10.A", "V1")], "ITEMNMBR string, PRIME_VNDR string")
    lines = spark.createDataFrame([], "ITEMNMBR string, PRIME_VNDR string, UNITCOST decimal(19,5)")
    rows = buyer.buyer_control(_deficits(spark), ss, v4, lines, params).collect()
    # two consolidated rows (their quantities differ), each meeting both cost rows again
    assert sorted((r["Recommended_PO_Qty"], r["Unit_Cost"]) for r in rows) == [
        (16.0, Decimal(2)), (16.0, Decimal(3)), (18.0, Decimal(2)), (18.0, Decimal(3))]


def test_issue_metrics_take_allocations_off(spark):
    row = [("M1", "I1", dt.datetime(2026, 1, 1), "WC-W1", Decimal(10), Decimal(1), Decimal(2), Decimal(3))]
    got = demand.issue_metrics(spark.createDataFrame(
        row, "MANUFACTUREORDER_I string, ITEMNMBR string, MRPISSUEDATE_I timestamp_ntz, WCID_I string, "
             "MRPAMOUNT_I decimal(19,5), ATYALLOC decimal(19,5), QTY_ISSUED_I decimal(19,5), "
             "QTY_BACKFLUSHED_I decimal(19,5)")).first()
    assert (got["Total_Issued"], got["Remaining_Required"]) == (5, 4)


def test_try_decimal_takes_no_exponent(spark):
    df = spark.createDataFrame([(" 12.5 ",), ("1e3",), ("x",), (None,), ("-.5",)], "x string")
    got = [r[0] for r in df.select(try_decimal(df.x, 18, 6)).collect()]
    assert got == [Decimal("12.5"), None, None, None, Decimal("-0.5")]


def test_conform_wants_its_columns(spark):
    schema = "ITEMNMBR string, UOMSCHDL string"
    frame = spark.createDataFrame([("10.A",)], "ITEM_NUMBER string")
    target = spark.createDataFrame([], schema).schema
    with pytest.raises(ValueError, match="ITEMNMBR"):
        conform(frame, target)
    assert conform(frame, target, ["itemnmbr", "UOMSCHDL"]).first() == (None, None)


def test_run_removes_its_tables(spark, params, tmp_path):
    run = LedgerRun(make_tables(spark, **_rows()), params, materialize="table", output_path=f"file://{tmp_path}/out")
    assert run.v3.count() == 2 and run.v2_full.count() == 5
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"quarantine_pipe"}  # the ledger tables are the run's own
    scratch = run._scratch.removeprefix("file://")
    assert os.path.isdir(scratch)
    run.release()
    assert not os.path.exists(scratch) and (tmp_path / "out" / "quarantine_pipe").exists()


def test_fg_map_is_cut_down_before_the_shuffle(spark, params):
    t = make_tables(spark, fg_orders=[dict(ORDERNUMBER="MO1", FG="F")])
    plan = demand.dedupe_fg(t["fg_orders"], params)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_opt_in_flags(spark, params):
    rows = _rows()
    for r in rows["mo_issues"]:
        r["MANUFACTUREORDER_I"] = f"MO-{r['MANUFACTUREORDER_I']}"
    for r in rows["mo_status"]:
        r["MANUFACTUREORDER_I"] = f"MO-{r['MANUFACTUREORDER_I']}"
    plain = LedgerRun(make_tables(spark, **rows), params, materialize=None)
    assert plain.v1.where("Remaining <> 0").count() == 0
    flags = replace(params, normalize_issue_mo=True, dedupe_timing=True, dedupe_vendor_join=True)
    run = LedgerRun(make_tables(spark, **rows), flags, materialize=None)
    assert run.v1.where("Remaining <> 0").count() == 4
    assert run.v5.count() == 5  # two quarantine rows, but no copies
    assert run.v7().first()["Vendor_Total_Exposure"] == 40  # one copy, not times the ledger rows
