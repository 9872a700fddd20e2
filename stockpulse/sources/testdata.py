"""Adapter: the driver's TPC-H-style test tables -> the twelve sources.

Pure DataFrame expressions over whole tables (no sampling, no id subsets),
so the work grows with the scale factor.  The same rules are written as SQL
in ``oracle_sql.py`` for the DuckDB cross-check.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stockpulse.functions import ts_lit
from stockpulse.params import Params
from stockpulse.sources.io import conform
from stockpulse.sources.schemas import SOURCE_SCHEMAS

AS_OF = dt.datetime(1998, 6, 15, 10, 0, 0)
FIRST_DAY = dt.date(1992, 1, 1)
RECEIPTS_SINCE = dt.datetime(1996, 1, 1)
DEMAND_YEARS = (1996, 1997)
Q = DecimalType(19, 5)

TPCH_TABLES = ("part", "orders", "lineitem", "customer")


def testdata_params(**overrides) -> Params:
    return Params(as_of=AS_OF, receipts_since=RECEIPTS_SINCE,
                  demand_years=DEMAND_YEARS, **overrides)


def read_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TPCH_TABLES}


def _pad(c: Column, n: int = 7) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _txt(c: Column) -> Column:
    """Text of a whole-number double."""
    return c.cast("bigint").cast("string")


def _days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n, ts)


def items(part: DataFrame) -> DataFrame:
    """Per part: item number ``SS.NNNNNN`` (with a letter for every fourth), vendor, UOM."""
    k = F.col("p_partkey")
    series = (F.when(F.col("p_size") == 50, "70")
              .when(F.col("p_type").startswith("ECONOMY"), "10")
              .when(F.col("p_type").startswith("SMALL"), "20")
              .when(F.col("p_type").startswith("MEDIUM"), "30")
              .when(F.col("p_type").startswith("LARGE"), "40")
              .when(F.col("p_type").startswith("STANDARD"), "50")
              .otherwise("60"))
    return part.select(
        k, "p_name", "p_brand", "p_size", "p_retailprice",
        F.concat(series, F.lit("."), _pad(k, 6), F.when(k % 4 == 0, "R").otherwise("")).alias("itm"),
        F.when(k % 29 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("V"), _pad(k % 100, 3))).alias("vnd"),
        F.when(k % 3 == 0, "EACH").when(k % 3 == 1, "CASE").otherwise("KG").alias("uom"),
    )


def _date_text(day: Column, style: Column) -> Column:
    """A day as text, written in one of ten ways, or no date."""
    out = F.when(style == 0, "N/A")
    for i, pattern in enumerate(("yyyy-MM-dd 00:00:00", "yyyy-MM-dd'T'10:30:00", "d MMM yyyy", "yyyy/MM/dd", "yyyy-M-d",
                                 "M/d/yyyy", "yyyyMMdd", "MMMM d, yyyy h:mm a", "MM-dd-yyyy"), 1):
        out = out.when(style == i, F.date_format(day, pattern))
    return out.otherwise(day.cast("string"))


def _respell(cond: Column, text: Column) -> Column:
    """Another spelling of the same key where ``cond`` holds: lower case, trailing blank."""
    return F.when(cond, F.concat(F.lower(text), F.lit(" "))).otherwise(text)


def adapt(tpch: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The twelve sources.  Every row of the four tables is kept; rules on keys only
    set attributes (spellings, statuses, sites, blanks, unparsable text)."""
    part, orders, lineitem, customer = (tpch[t] for t in TPCH_TABLES)
    it = items(part)
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    lines = lineitem.select(ok, ln, pk, F.col("l_suppkey").alias("supp"), F.col("l_quantity").alias("q"),
                            F.col("l_returnflag").alias("rf"), F.to_date("l_shipdate").alias("sd"))
    lwi = lines.join(it, pk == F.col("p_partkey")).withColumns({
        "itv": _respell(ok % 37 == 0, F.col("itm")),
        "vnv": F.when(ok % 47 == 0, F.lit(None).cast("string")).otherwise(_respell(ok % 31 == 0, F.col("vnd"))),
        "uov": _respell(ok % 43 == 0, F.col("uom"))})
    nul = F.lit(None).cast("string")

    # a balance that falls by one a week and by the line's quantity: a row's own values only
    weeks = F.floor(F.datediff(F.col("sd"), F.lit(FIRST_DAY)) / 7)
    demand = lwi.select(
        F.when(ok % 41 == 0, "")
         .when(ok % 5 == 0, F.concat(F.lit("mo #"), _pad(ok)))
         .otherwise(F.concat(F.lit("MO-"), _pad(ok))).alias("ORDERNUMBER"),
        F.col("itv").alias("ITEMNMBR"),
        F.when((ok + ln) % 17 == 0, "Partially Received")
         .when((ok + ln) % 19 == 0, "SCRAP")
         .otherwise("Released").alias("STSDESCR"),
        F.when(ln == 7, F.lit(None).cast("date")).otherwise(F.col("sd")).alias("DUEDATE"),
        nul.alias("Expiry_Dates"),
        _date_text(F.col("sd"), ok % 11).alias("Date_Expiry"),
        F.when(ok % 23 == 0, "N/A").otherwise(_txt(F.col("q"))).alias("Deductions"),
        nul.alias("BEG_BAL"), nul.alias("Expiry"),
        F.when(pk % 3 == 0, _txt(4 * F.col("q"))).when(pk % 3 == 1, "")
         .when(pk % 15 == 2, "-5").when(pk % 15 == 5, "N/A").otherwise("3").alias("POs"),
        F.when(ok % 97 == 0, "N/A").when(ok % 101 == 0, "1e3")
         .otherwise(_txt(2 * F.col("p_size") + 200 - weeks - F.col("q"))).alias("Running_Balance"),
        F.lit("MRP").alias("MRPTYPE"), F.col("p_brand").alias("VendorItem"),
        F.col("vnv").alias("PRIME_VNDR"),
    )
    begbal = it.select(F.lit("Beg Bal").alias("ORDERNUMBER"), F.col("itm").alias("ITEMNMBR"),
                       F.lit("Beg Bal").alias("STSDESCR"), F.lit("0").alias("Deductions"),
                       _txt(2 * F.col("p_size")).alias("BEG_BAL"),
                       _txt(2 * F.col("p_size")).alias("Running_Balance"),
                       F.lit("MRP").alias("MRPTYPE"), F.col("p_brand").alias("VendorItem"),
                       F.col("vnd").alias("PRIME_VNDR"))
    unused = SOURCE_SCHEMAS["planning"].names
    planning = conform(demand, SOURCE_SCHEMAS["planning"], unused).unionByName(
        conform(begbal, SOURCE_SCHEMAS["planning"], unused))

    okey = F.col("o_orderkey")
    fg_base = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.when(okey % 17 == 0, "XX").otherwise("MO"), _pad(okey)).alias("ORDERNUMBER"),
        F.when(okey % 29 == 0, F.concat(F.upper("c_name"), F.lit(" "))).otherwise(F.col("c_name")).alias("Customer"),
        F.col("c_mktsegment").alias("FG_Desc"), okey)
    fg_orders = fg_base.select("ORDERNUMBER", F.concat(F.lit("FG"), (okey % 20).cast("string")).alias("FG"),
                               "Customer", "FG_Desc").unionByName(
        fg_base.where(okey % 13 == 0).select("ORDERNUMBER", F.lit("FGX").alias("FG"),
                                             "Customer", "FG_Desc")).unionByName(
        # orders without a number, which all demand without one meets
        fg_base.where(okey % 211 == 0).select(
            F.when(okey % 2 == 0, " ").otherwise("MO-#").alias("ORDERNUMBER"),
            F.when(okey % 2 == 0, "FGY").otherwise("FGZ").alias("FG"), "Customer", "FG_Desc"))

    pkey = F.col("p_partkey")
    vendor_items = it.select(F.col("itm").alias("Item_Number"), F.col("p_name").alias("ITEMDESC"),
                             F.col("uom").alias("UOMSCHDL"),
                             F.when(pkey % 31 == 0, "No").otherwise("Yes").alias("Active")) \
        .unionByName(it.where(pkey % 37 == 0).select(
            F.col("itm").alias("Item_Number"),
            F.concat(F.col("p_name"), F.lit(" ALT")).alias("ITEMDESC"),
            F.col("uom").alias("UOMSCHDL"), F.lit("Yes").alias("Active")))

    iss = lwi.select(
        _pad(ok).alias("MANUFACTUREORDER_I"), F.col("itv").alias("ITEMNMBR"),
        F.concat(F.lit("WC-W"), (F.col("supp") % 3).cast("string")).alias("WCID_I"),
        F.col("sd").cast("timestamp_ntz").alias("MRPISSUEDATE_I"),
        F.when(F.col("rf") == "R", F.floor(F.col("q") / 2)).otherwise(0).cast(Q).alias("QTY_ISSUED_I"),
        F.when(ok % 4 == 0, 2).otherwise(0).cast(Q).alias("QTY_BACKFLUSHED_I"),
        F.col("q").cast(Q).alias("MRPAMOUNT_I"),
        F.when(ok % 3 == 0, 1).otherwise(0).cast(Q).alias("ATYALLOC"), ok)
    mo_issues = iss.drop("l_orderkey").unionByName(
        iss.where(ok % 7 == 0).withColumn("MRPAMOUNT_I", (F.col("MRPAMOUNT_I") + 1).cast(Q))
           .withColumn("QTY_ISSUED_I", F.lit(1).cast(Q)).drop("l_orderkey"))

    st = F.col("o_orderstatus")
    mo_status = orders.select(_pad(okey).alias("MANUFACTUREORDER_I"),
                              F.when(st == "O", 2).when(st == "P", 3).otherwise(5)
                               .cast("int").alias("MANUFACTUREORDERST_I"))

    item_master = it.select(F.col("itm").alias("ITEMNMBR"), F.col("uom").alias("UOMSCHDL"))

    asof = ts_lit(AS_OF)
    bin_base = it.select(F.col("itm").alias("Item_Number"),
                         ((pkey * 7) % 60).cast(Q).alias("QTY_Available"),
                         _days(asof, -(pkey % 70)).alias("DATERECD"), pkey)
    bin_stock = bin_base.select("Item_Number", F.concat(F.lit("WC-W"), (pkey % 3).cast("string")).alias("SITE"),
                                "QTY_Available", "DATERECD").unionByName(
        bin_base.select("Item_Number", F.lit("MAIN").alias("SITE"), "QTY_Available", "DATERECD"))

    def lot(k: int) -> DataFrame:
        recvd = 2 * F.col("p_size") + 3 * k
        held = (F.when(pkey % 8 == 0, "wf-q ").otherwise("WF-Q") if k == 1
                else F.when(pkey % 5 == 0, "MAIN").otherwise("UNDERINV"))
        return it.select(
            _respell((pkey % 9 == 0) & F.lit(k == 2), F.col("itm")).alias("ITEMNMBR"),
            F.when(pkey % 2 == 1, "MAIN").otherwise(held).alias("LOCNCODE"),
            F.concat(F.lit("L"), pkey.cast("string"), F.lit(f"-{k}")).alias("LOTNUMBR"),
            _days(asof, (pkey * 11) % 200).alias("EXPNDATE"),
            _days(asof, -(pkey % 90)).alias("DATERECD"),
            recvd.cast(Q).alias("QTYRECVD"),
            F.when(pkey % 10 == 0, recvd).otherwise(F.col("p_size")).cast(Q).alias("QTYSOLD"))
    lots = lot(1).unionByName(lot(2))

    ss_one = it.select(F.col("itm").alias("ITEMNMBR"),
                       F.when(pkey % 43 == 0, "").when(pkey % 47 == 0, "A**B")
                        .otherwise(F.col("p_brand")).alias("VendorItem"),
                       F.col("vnd").alias("PRIME_VNDR"),
                       F.when(pkey % 53 == 0, "NO").otherwise("YES").alias("INCLUDE_MRP"))
    # a second row for the same (item, vendor), spelled differently
    ss_two = it.where(pkey % 61 == 0).select(
        F.col("itm").alias("ITEMNMBR"), F.concat(F.col("p_brand"), F.lit("-2")).alias("VendorItem"),
        _respell(F.lit(True), F.col("vnd")).alias("PRIME_VNDR"), F.lit("YES").alias("INCLUDE_MRP"))
    ss_items = ss_one.unionByName(ss_two)

    receipts = lwi.select(
        F.col("itv").alias("Item_Number"), F.col("p_name").alias("Item_Description"),
        F.col("uov").alias("U_Of_M"),
        F.when(pk % 59 == 0, "None").otherwise("Lot").alias("Item_Tracking_Option"),
        F.concat(F.lit("R"), ok.cast("string")).alias("POP_Receipt_Number"),
        F.col("q").cast(Q).alias("QTY_Shipped"), ln.alias("Receipt_Line_Number"),
        F.col("sd").cast("timestamp_ntz").alias("Created_Date"))
    receipt_lines = lwi.select(
        F.concat(F.lit("R"), ok.cast("string")).alias("POPRCTNM"), ln.alias("RCPTLNNM"),
        F.col("itm").alias("ITEMNMBR"),
        F.when(ok % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("S"), ok.cast("string"))).alias("SERLTNUM"),
        (F.col("p_retailprice") / 20).cast(Q).alias("UNITCOST"), F.col("vnv").alias("PRIME_VNDR"))
    consumption = lwi.select(F.col("itv").alias("Component"), F.col("uov").alias("UoM"),
                             F.col("sd").cast("timestamp_ntz").alias("IssueDate"),
                             F.col("q").cast(Q).alias("IssueQty"))

    raw = dict(planning=planning, fg_orders=fg_orders, vendor_items=vendor_items,
               mo_issues=mo_issues, mo_status=mo_status, item_master=item_master, lots=lots,
               bin_stock=bin_stock, ss_items=ss_items, receipts=receipts,
               receipt_lines=receipt_lines, consumption=consumption)
    return {k: conform(v, SOURCE_SCHEMAS[k]) for k, v in raw.items()}


def load_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return adapt(read_tpch(spark, sf_dir))
