"""Versioned publishing, the catalog loader, and the signed regression diff."""

import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from conftest import make_tables
from stockpulse.plans.reports import regression_diff
from stockpulse.sources import load_tables, publish, read_published, register_published, register_views
from stockpulse.sources.publish import current, new_version, prune, switch
from stockpulse.sources.schemas import SOURCE_SCHEMAS


def rows(spark, tag, n=200):
    df = spark.range(n).select(F.concat(F.lit("I"), (F.col("id") % 17).cast("string")).alias("ITEMNMBR"),
                               F.concat(F.lit("V"), (F.col("id") % 3).cast("string")).alias("PRIME_VNDR"),
                               F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("Demand_Due_Date"))
    return df.withColumn("tag", F.lit(tag))


def test_readers_see_the_old_version_or_the_new_one(spark):
    base = tempfile.mkdtemp(prefix="stockpulse-publish-")
    assert current(spark, base) is None
    with pytest.raises(FileNotFoundError):
        read_published(spark, base, "supply_action")
    publish(spark, {"supply_action": rows(spark, "a"), "other": rows(spark, "a")}, base)
    before = read_published(spark, base, "supply_action")
    # a version that is written but not switched to, as after a failure, is invisible
    half = new_version(base)
    rows(spark, "lost").write.parquet(f"{half}/supply_action")
    assert {r.tag for r in read_published(spark, base, "supply_action").select("tag").distinct().collect()} == {"a"}
    seen, stop = set(), threading.Event()

    def reads():
        while not stop.is_set():
            tags = {r.tag for r in read_published(spark, base, "supply_action").select("tag").distinct().collect()}
            seen.add(tuple(sorted(tags)))

    reader = threading.Thread(target=reads)
    reader.start()
    publish(spark, {"supply_action": rows(spark, "b"), "other": rows(spark, "b")}, base, keep=3)
    stop.set()
    reader.join()
    assert seen <= {("a",), ("b",)}
    assert read_published(spark, base, "other").first().tag == "b"
    assert before.count() == 200  # a frame stays on its version while that is kept
    register_published(spark, base, ["supply_action"], "pub_")
    assert spark.sql("SELECT max(tag) FROM pub_supply_action").first()[0] == "b"


def test_old_versions_go_and_the_current_stays(spark):
    base = tempfile.mkdtemp(prefix="stockpulse-publish-")
    folders = [publish(spark, {"x": rows(spark, str(i), 3)}, base, keep=2) for i in range(4)]
    assert current(spark, base) == folders[-1]
    assert sorted(os.listdir(f"{base}/versions")) == [f.rsplit("/", 1)[1] for f in folders[2:]]
    switch(spark, base, folders[2])  # back to the version before
    assert read_published(spark, base, "x").first().tag == "2"
    assert prune(spark, base, 1) == [] and os.path.isdir(folders[3])  # newer folders are left alone


def test_layout_lets_readers_skip_files(spark):
    base = tempfile.mkdtemp(prefix="stockpulse-publish-")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = publish(spark, {"supply_action": rows(spark, "a", 5000)}, base)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = spark.read.parquet(f"{folder}/supply_action").groupBy(F.input_file_name()).agg(
        F.min("ITEMNMBR").alias("lo"), F.max("ITEMNMBR").alias("hi")).orderBy("lo").collect()
    assert len(spans) > 1 and all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))


def test_load_from_catalog_tables_and_register_views(spark):
    t = make_tables(spark, planning=[dict(ORDERNUMBER="MO-1", ITEMNMBR="10.A", STSDESCR="Open")])
    register_views(t, "src_")
    loaded = load_tables(spark, "", fmt="table", names={n: f"src_{n}" for n in SOURCE_SCHEMAS})
    assert loaded["planning"].collect() == t["planning"].collect()
    assert all(loaded[n].schema.names == SOURCE_SCHEMAS[n].names for n in SOURCE_SCHEMAS)
    raw = t["planning"].withColumnRenamed("Date_Expiry", "Date + Expiry").withColumnRenamed("POs", "PO's")
    raw.createOrReplaceTempView("src_planning")  # the source's own column names
    assert load_tables(spark, "", fmt="table", names={n: f"src_{n}" for n in SOURCE_SCHEMAS})["planning"].count() == 1
    raw.drop("ITEMNMBR").createOrReplaceTempView("src_planning")
    with pytest.raises(ValueError, match="ITEMNMBR"):
        load_tables(spark, "", fmt="table", names={n: f"src_{n}" for n in SOURCE_SCHEMAS})


def test_regression_diff_classes_rows(spark):
    def run(*data):
        return spark.createDataFrame(list(data), "k string, v int, w string")
    before = run(("a", 1, "x"), ("a", 1, "x"), ("b", 1, "x"), ("c", 1, None), (None, 1, "n"), ("e", 5, "x"), ("f", 1, "x"))
    after = run(("a", 1, "x"), ("b", 2, "x"), ("c", 1, None), (None, 2, "n"), ("d", 1, "x"), ("d", 1, "x"), ("f", 1, "x"))
    diff = regression_diff(before, after, ["k"])
    got = sorted(((r.k or "", r.v, r.Side, r.Change, r.Copies) for r in diff.collect()))
    assert got == [("", 1, "before", "changed", 1), ("", 2, "after", "changed", 1), ("a", 1, "before", "removed", 1),
                   ("b", 1, "before", "changed", 1), ("b", 2, "after", "changed", 1), ("d", 1, "after", "added", 2),
                   ("e", 5, "before", "removed", 1)]
    assert regression_diff(before, before, ["k"]).count() == 0
    plan = diff._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
