"""Ordered running computations per key, in bounded pieces.

A window ``partitionBy(key).orderBy(...)`` puts every row of a key into one task.
When one key holds a large share of all rows (a hot item), that task becomes the
job.  Here the order is laid out once and scanned as a tree:

  1. ``lay_out`` range-partitions the rows by (key, order), sorts within the
     partitions and numbers them.  Split points fall anywhere in a key's order, so
     a key spans as many partitions as its rows need, whatever its values share.
     A content hash ends the order, so only identical rows are interchangeable.
     The rows are materialised once; every later read sees the same numbers.
  2. Chunks are cut by position: ``CHUNK_ROWS`` rows of a partition, exactly
     counted.  Windows run per (key, chunk).
  3. Per (key, chunk) one partial aggregate; chunks form blocks of
     ``BLOCK_CHUNKS``, blocks one aggregate each, and a key's blocks (at most one
     per partition and 64 million rows) are scanned last.
  4. Offsets come back down from blocks to chunks to rows.  Rows and their chunk
     share one partitioning, so attaching the offsets does not shuffle rows again.

So no task orders more than ``CHUNK_ROWS`` rows, ``BLOCK_CHUNKS`` chunks, or the
blocks of one key.  Exact: equal to the single window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 1 << 16
BLOCK_CHUNKS = 1 << 10
#: Rows a partition's numbering has room for (``monotonically_increasing_id``).
_PARTITION_ROWS = 1 << 33
#: Numbers of a slice of the keys, if they are laid out slice by slice: up to a million partitions each.
_SLICE_NUMBERS = _PARTITION_ROWS << 20


def lay_out(df: DataFrame, order: list[Column], at: str, cut: Callable[[DataFrame], DataFrame] | None = None,
            part: int = 0) -> DataFrame:
    """``df`` in the given total order over range partitions, numbered by ``at``.

    The number's order is the rows' order; ``part`` numbers the slices of the keys if ``df`` is one of them.  ``cut`` materialises the result (a run
    writes it as a table); without one the rows are checkpointed, or cached where
    the session names no checkpoint folder."""
    order = [*order, F.xxhash64(*df.columns).asc()]
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id() + F.lit(part * _SLICE_NUMBERS))
    if cut is not None:
        return cut(laid)
    return laid.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else laid.persist()


def chunk_of(at: str, rows: int = CHUNK_ROWS) -> Column:
    """The chunk of a row: its partition and its position there, by ``rows``."""
    return F.expr(f"{at} div {_PARTITION_ROWS} * {_PARTITION_ROWS // rows} + {at} % {_PARTITION_ROWS} div {rows}")


def chunk_window(key: str, chunk: str, at: str) -> Window:
    return Window.partitionBy(key, chunk).orderBy(at)


def balance_offsets(chunks: DataFrame, key: str, chunk: str, step: Callable[[Column, Column, Column], Column],
                    counts: list[str], block_chunks: int = BLOCK_CHUNKS) -> DataFrame:
    """What every chunk of a key starts from.

    ``chunks`` has one row per (key, chunk): ``first`` and ``last`` value, ``held`` of
    its first row, the ``total`` of its inner steps, and the ``counts``.  The step
    between two neighbouring chunks is ``step(held of the later, its first value, last
    value of the earlier)``.  Result: key, chunk, and

      before     the value that precedes the chunk,
      lead       the step onto its first row (0 for a key's first chunk),
      off_total  the sum of all steps before the chunk,
      off_<c>    the sums of the counts before it,
      anchor     the first value of the key.

    Two levels: chunks within blocks, then the blocks of a key."""
    zero = step(F.lit(1), F.lit(None), F.lit(None))

    def level(d: DataFrame, by: list[str], order: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        d = d.withColumns({"_no": F.row_number().over(w), "_prev": F.lag("last").over(w)})
        d = d.withColumn("_lead", F.when(F.col("_no") == 1, zero).otherwise(
            step(F.col("held"), F.col("first"), F.col("_prev"))))
        return d.withColumns({"_sum": F.coalesce(F.sum(F.col("_lead") + F.col("total")).over(before), zero),
                              **{f"_n_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in counts}})

    inner = level(chunks.withColumn("_block", F.expr(f"{chunk} div {block_chunks}")), [key, "_block"], chunk)
    blocks = inner.groupBy(key, "_block").agg(
        F.min_by("first", chunk).alias("first"), F.max_by("last", chunk).alias("last"),
        F.min_by("held", chunk).alias("held"), F.sum(F.col("_lead") + F.col("total")).alias("total"),
        *[F.sum(c).alias(c) for c in counts])
    outer = level(blocks, [key], "_block").withColumn(
        "_anchor", F.first("first").over(Window.partitionBy(key).orderBy("_block")))
    outer = outer.select(F.col(key).alias("_b_key"), F.col("_block").alias("_b_block"), "_anchor",
                         F.col("_prev").alias("_b_prev"), F.col("_lead").alias("_b_lead"), F.col("_sum").alias("_b_sum"),
                         *[F.col(f"_n_{c}").alias(f"_b_{c}") for c in counts])
    j = inner.join(outer, (F.col(key) == F.col("_b_key")) & (F.col("_block") == F.col("_b_block")))
    opens = F.col("_no") == 1  # the block's own step onto its first row comes from the level above
    return j.select(
        key, chunk, F.when(opens, F.col("_b_prev")).otherwise(F.col("_prev")).alias("before"),
        F.when(opens, F.col("_b_lead")).otherwise(F.col("_lead")).alias("lead"),
        (F.col("_b_sum") + F.when(opens, zero).otherwise(F.col("_b_lead")) + F.col("_sum")).alias("off_total"),
        *[(F.col(f"_b_{c}") + F.col(f"_n_{c}")).alias(f"off_{c}") for c in counts],
        F.col("_anchor").alias("anchor"))


def attach(rows: DataFrame, offsets: DataFrame, key: str, chunk: str) -> DataFrame:
    """Each row with its chunk's offsets.  Key (never NULL) and chunk are the window's
    partitioning, so the rows stay where they are."""
    o = offsets.withColumnRenamed(key, "_o_key").withColumnRenamed(chunk, "_o_chunk")
    return rows.join(o, (F.col(key) == F.col("_o_key")) & (F.col(chunk) == F.col("_o_chunk"))) \
        .drop("_o_key", "_o_chunk")
