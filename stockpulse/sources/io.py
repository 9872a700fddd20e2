"""Loader (S1) and sinks."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockpulse.sources.schemas import SOURCE_SCHEMAS


def normalize_name(name: str) -> str:
    """``Date + Expiry`` -> ``Date_Expiry``; ``PO's`` -> ``POs``; ``U Of M`` -> ``U_Of_M``."""
    n = name.replace("'", "")
    n = re.sub(r"\s*\+\s*|\s+", "_", n.strip())
    return n


def conform(df: DataFrame, schema: StructType, optional: Iterable[str] = ()) -> DataFrame:
    """Rename to normalised names, cast to the declared types and drop the rest
    (column pruning starts here).  Absent columns are an error, but for those in
    ``optional``, which become NULL."""
    may_lack = {c.lower() for c in optional}
    have = {normalize_name(c).lower() for c in df.columns}
    lacking = [f.name for f in schema.fields if f.name.lower() not in have | may_lack]
    if lacking:
        raise ValueError(f"required columns are absent: {', '.join(lacking)}; found {', '.join(df.columns)}")
    by_norm = {normalize_name(c).lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = by_norm.get(f.name.lower())
        col = F.col(f"`{src}`") if src is not None else F.lit(None)
        cols.append(col.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def load_tables(spark: SparkSession, base: str, fmt: str = "parquet",
                names: dict[str, str] | None = None, options: dict[str, str] | None = None,
                table_options: dict[str, dict[str, str]] | None = None,
                optional: dict[str, Iterable[str]] | None = None) -> dict[str, DataFrame]:
    """Read the twelve sources, ``{base}/{file}`` per logical table.

    ``names`` maps a logical name to a file/table name when they differ.  For
    ``fmt='table'`` it is a catalog table; for ``fmt='jdbc'`` the ``dbtable`` at
    the URL ``base``, with ``options`` for all tables and ``table_options`` for one
    (for instance ``partitionColumn`` and its bounds, to read in parallel).
    ``optional`` lists, per logical table, the columns that may be absent.
    """
    names, table_options, optional = names or {}, table_options or {}, optional or {}
    out = {}
    for logical, schema in SOURCE_SCHEMAS.items():
        target = names.get(logical, logical)
        if fmt == "table":
            df = spark.table(target)
        else:
            own = {**(options or {}), **table_options.get(logical, {})}
            reader = spark.read.format(fmt).options(**own)
            df = (reader.option("url", base).option("dbtable", own.get("dbtable", target)).load()
                  if fmt == "jdbc" else reader.load(f"{base}/{target}"))
        out[logical] = conform(df, schema, optional.get(logical, ()))
    return out


def register_views(outputs: dict[str, DataFrame], prefix: str = "") -> None:
    """Publish outputs as temp views for SQL users."""
    for name, df in outputs.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def write_outputs(outputs: dict[str, DataFrame], path: str, fmt: str = "parquet",
                  mode: str = "overwrite", partition_by: dict[str, list[str]] | None = None,
                  workers: int = 1) -> None:
    """Write each output to ``{path}/{name}``.  Writes are idempotent
    (overwrite), so a job restarted after executor loss re-runs cleanly.
    ``workers > 1`` submits the writes as concurrent Spark jobs."""
    partition_by = partition_by or {}

    def write(item: tuple[str, DataFrame]) -> None:
        name, df = item
        w = df.write.mode(mode).format(fmt)
        if name in partition_by:
            w = w.partitionBy(*partition_by[name])
        w.save(f"{path}/{name}")

    if workers <= 1:
        for item in outputs.items():
            write(item)
        return
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=workers) as pool:
        list(pool.map(write, outputs.items()))
