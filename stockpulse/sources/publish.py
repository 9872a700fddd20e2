"""Versioned publishing (S2): readers see the old outputs or the new ones, never none.

A version is a folder ``{base}/versions/{id}`` with one Parquet table per output.  It is
written completely before the pointer ``{base}/CURRENT``, a one-line file that names the
version, is replaced by an atomic rename.  Whatever fails before that leaves readers on
the version before; what it has written is one folder that nobody points to, removed
with the other old ones by ``prune``.

``LAYOUT`` lists the outputs that are looked up by key and the order they are laid out
in: range-partitioned and sorted by (item, vendor, date), so that the row groups' minima
and maxima let a reader of one item skip the rest, as a covering index would.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"
VERSIONS = "versions"
#: Lookup order of the outputs that have one.
LAYOUT: dict[str, tuple[str, ...]] = {
    "supply_action": ("ITEMNMBR", "PRIME_VNDR", "Demand_Due_Date"),
    "extended_ledger": ("ITEMNMBR", "PRIME_VNDR", "DUEDATE"),
    "safety_stock": ("ITEMNMBR", "PRIME_VNDR"),
}


def _fs(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def laid_out(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Range-partitioned and sorted for lookups by ``columns``."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns) if columns else df


def new_version(base: str) -> str:
    """The folder of a version to be written; its name sorts by time."""
    return f"{base}/{VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def switch(spark: SparkSession, base: str, folder: str) -> None:
    """Make a completely written version the current one."""
    fs, target = _fs(spark, f"{base}/{POINTER}")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/.{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.writeBytes(folder.rsplit("/", 1)[1])
    out.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark._sc._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()) \
        .rename(fs.makeQualified(draft), fs.makeQualified(target), over)


def current(spark: SparkSession, base: str) -> str | None:
    """The folder of the current version, None before the first."""
    fs, pointer = _fs(spark, f"{base}/{POINTER}")
    if not fs.exists(pointer):
        return None
    return f"{base}/{VERSIONS}/{spark.read.text(f'{base}/{POINTER}').first()[0]}"


def publish(spark: SparkSession, outputs: Mapping[str, DataFrame], base: str, keep: int = 2) -> str:
    """Write ``outputs`` as a new version, switch to it, and keep the last ``keep``."""
    folder = new_version(base)
    for name, df in outputs.items():
        laid_out(df, LAYOUT.get(name, ())).write.parquet(f"{folder}/{name}")
    switch(spark, base, folder)
    prune(spark, base, keep)
    return folder


def prune(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Remove all but the ``keep`` newest versions (never the current one, nor newer
    ones that may still be being written); returns the names removed."""
    now = current(spark, base)
    if now is None:
        return []
    at = now.rsplit("/", 1)[1]
    fs, top = _fs(spark, f"{base}/{VERSIONS}")
    older = sorted(s.getPath().getName() for s in fs.listStatus(top) if s.getPath().getName() < at)
    gone = older[:max(0, len(older) - (keep - 1))]
    for name in gone:
        fs.delete(_fs(spark, f"{base}/{VERSIONS}/{name}")[1], True)
    return gone


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """An output of the current version.  A DataFrame stays on the version it was made from."""
    folder = current(spark, base)
    if folder is None:
        raise FileNotFoundError(f"nothing is published under {base}")
    return spark.read.parquet(f"{folder}/{name}")


def register_published(spark: SparkSession, base: str, names: list[str], prefix: str = "") -> None:
    """Views over the current version's outputs for SQL users of this session."""
    for name in names:
        read_published(spark, base, name).createOrReplaceTempView(f"{prefix}{name}")
