"""Run risk (R1-R5) -> view 6.

Rewrite R3: the source computes per-(item, vendor) window aggregates on
every deficit row and then takes DISTINCT.  Here the deficit rows are
aggregated once at (item, vendor, description, UOM) grain (map-side partial
aggregation, so a hot item never lands whole in one task), and the small
aggregate is rolled up to (item, vendor) with a window.  NULL vendors form
their own group, as window partitions do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.functions import collated, group_by_keys, norm_key, str_eq, text_max
from stockpulse.operators.action import balance_analysis, timing_copies, turnaround
from stockpulse.operators.overlay import WFQ_ENHANCED, WFQ_RESCUED
from stockpulse.operators.suppress import ST_BEGBAL
from stockpulse.params import Params

# FIXED VALUES
CLIENT_SEPARATOR = ", "
RESCUE_STATUSES = (WFQ_RESCUED, WFQ_ENHANCED)
RISK_KEYS = ("ITEMNMBR", "PRIME_VNDR", "ItemDescription", "UOM")
DEFICIT_COLUMNS = [*RISK_KEYS, "Construct", "Demand_Due_Date", "Deficit_Qty", "WFQ_Extended_Status"]


def deficit_rows(v4: DataFrame, pipe: DataFrame, p: Params) -> DataFrame:
    """Demand rows with a deficit and a demand date (suppressed rows stay, T13),
    narrowed to what views 6 and 7 read.

    The source reads them from view 5, where a row repeats once per quarantine row of
    its item (T15).  Here they come from view 4 and carry that number as ``Copies``,
    which is the same on all rows of an item: sums are weighted by it, least and
    greatest values and distinct counts do not feel it."""
    d = balance_analysis(v4, p).where(
        ~str_eq(F.col("Suppression_Status"), ST_BEGBAL, p.case_insensitive)
        & (F.col("Deficit_Qty") > 0) & F.col("Demand_Due_Date").isNotNull()).select(*DEFICIT_COLUMNS)
    copies = timing_copies(turnaround(pipe, p), p)
    return (d.join(copies, norm_key(F.col("ITEMNMBR"), p.case_insensitive) == F.col("_t_item"), "left")
            .select(*DEFICIT_COLUMNS, F.coalesce("Copies", F.lit(1).cast("bigint")).alias("Copies")))


def copied_sum(df: DataFrame, qty: str) -> Column:
    """SUM of ``qty`` over the rows that ``Copies`` stands for, in a group of one item."""
    kind = df.select(F.sum(qty)).schema[0].dataType
    return (F.sum(qty) * F.max("Copies")).cast(kind)


def threatened_clients(f: DataFrame, p: Params) -> DataFrame:
    """R2: distinct (item, vendor, description, UOM, client).  Blank clients count."""
    return group_by_keys(f.where(F.col("Construct").isNotNull()),
                         {c: F.col(c) for c in (*RISK_KEYS, "Construct")}, [], [], p.case_insensitive)


def client_summary(tc: DataFrame, p: Params) -> DataFrame:
    """Ordered client list, client count, MAX description / UOM per (item, vendor).

    The list holds one entry per distinct client, as the source's STRING_AGG does,
    so a row is as long as the item's clients are many; it is not cut."""
    named = tc.withColumn("_client", norm_key(F.col("Construct"), p.case_insensitive))
    return group_by_keys(
        named, {"ITEMNMBR": F.col("ITEMNMBR"), "PRIME_VNDR": F.col("PRIME_VNDR")}, [],
        [text_max("ItemDescription", p.collation).alias("ItemDescription"), text_max("UOM", p.collation).alias("UOM"),
         F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(
             collated(F.col("_client"), p.collation).alias("_client"), "Construct"))),
                                  lambda c: c["Construct"]), CLIENT_SEPARATOR).alias("Threatened_Clients"),
         F.count(F.lit(1)).alias("Client_Exposure_Count")], p.case_insensitive)


def risk_metrics(f: DataFrame, p: Params) -> DataFrame:
    """First stockout date, total deficit and rescue dependency per
    (item, vendor), reported on each (item, vendor, description, UOM)."""
    g = group_by_keys(f, {c: F.col(c) for c in RISK_KEYS}, [], [
        F.min("Demand_Due_Date").alias("_first"),
        copied_sum(f, "Deficit_Qty").alias("_deficit"),
        F.max(F.when(F.col("WFQ_Extended_Status").isin(*RESCUE_STATUSES), 1).otherwise(0))
         .alias("_dep")], p.case_insensitive)
    w = Window.partitionBy(*[norm_key(F.col(c), p.case_insensitive) for c in RISK_KEYS[:2]])
    return g.select("ITEMNMBR", "PRIME_VNDR", "ItemDescription", "UOM",
                    F.min("_first").over(w).alias("First_Stockout_Date"),
                    F.sum("_deficit").over(w).alias("Total_Deficit_Qty"),
                    F.max("_dep").over(w).alias("WFQ_Dependency_Flag"))


def schedule_threat(d: DataFrame, ss: DataFrame, p: Params) -> DataFrame:
    """Lead days (default 30), days to stockout, schedule threat.

    The safety-stock join needs equal vendors, so a NULL vendor stays NULL."""
    ci = p.case_insensitive
    s = ss.select(norm_key(F.col("ITEMNMBR"), ci).alias("_s_item"),
                  norm_key(F.col("PRIME_VNDR"), ci).alias("_s_vnd"),
                  F.col("PRIME_VNDR").alias("_s_vendor"), F.col("LeadDays").alias("_s_lead"))
    j = d.join(s, (norm_key(d.ITEMNMBR, ci) == s._s_item)
               & (norm_key(d.PRIME_VNDR, ci) == s._s_vnd), "left")
    lead = F.coalesce(F.col("_s_lead"), F.lit(p.default_lead_days))
    first = F.col("First_Stockout_Date")
    return j.select(
        "ITEMNMBR", F.coalesce(F.col("PRIME_VNDR"), F.col("_s_vendor")).alias("PRIME_VNDR"),
        "ItemDescription", "UOM", "Threatened_Clients", "Client_Exposure_Count",
        "First_Stockout_Date", F.datediff(first, F.lit(p.today)).alias("Days_To_Stockout"),
        "Total_Deficit_Qty", "WFQ_Dependency_Flag",
        F.when(first.isNotNull() & (first <= F.date_add(F.lit(p.today), lead)), 1)
         .otherwise(0).alias("Schedule_Threat"),
        lead.alias("LeadDays"))


V6_COLUMNS = ["ITEMNMBR", "PRIME_VNDR", "ItemDescription", "UOM", "Threatened_Clients",
              "Client_Exposure_Count", "First_Stockout_Date", "Days_To_Stockout",
              "Total_Deficit_Qty", "WFQ_Dependency_Flag", "Schedule_Threat", "LeadDays"]


def run_risk(f: DataFrame, ss: DataFrame, p: Params) -> DataFrame:
    """V6 from the deficit rows (R1): 12 columns, distinct rows."""
    ci = p.case_insensitive
    m = risk_metrics(f, p)
    cs = client_summary(threatened_clients(f, p), p).select(
        norm_key(F.col("ITEMNMBR"), ci).alias("_c_item"),
        norm_key(F.col("PRIME_VNDR"), ci).alias("_c_vnd"),
        "Threatened_Clients", "Client_Exposure_Count")
    d = m.join(cs, (norm_key(m.ITEMNMBR, ci) == cs._c_item)
               & (norm_key(m.PRIME_VNDR, ci) == cs._c_vnd), "left")
    return schedule_threat(d, ss, p).select(*V6_COLUMNS).distinct()
