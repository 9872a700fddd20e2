"""Sharding by a two-pass external shuffle (DataFrame functions only).

Pass 1 scatters whole records into buckets that fit in memory, by a seeded hash
of their content.  Pass 2 gathers each bucket into one array, applies Fisher-
Yates to it (Spark's ``shuffle``), and gives its rows consecutive places in the
global order.  Shards are equal slices of that order, so their row counts are at
most one apart (law ``rows``).

Copies (equal id and text) are numbered, and every copy but the first is scattered by
its own number too, so however many there are, a bucket holds about ``bucket_bytes``
(more only if a single record does).  Buckets follow from the bytes of the table
alone, so places do not depend on the cluster or on how the input is partitioned.

Determinism: a bucket's rows are sorted by their hashes before they are shuffled,
and it sits alone in the partition of its own number, which is what the seeded
shuffle is keyed on; a recomputed task gives the same order.

Defined cases: null text counts 0 bytes (size 8) and CRC-32 of no bytes, which
is 0; null ids are ordinary values; copies are interchangeable; an empty table
gives no rows; extra columns of any type travel along, also those that are named
like the added ones (they are replaced).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import checkpointed, running_offsets

ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
#: Buckets up to which their first places (16 bytes each) are broadcast.
BROADCAST_BUCKETS = 500_000


def record_size(text_col: str = "text") -> Column:
    """UTF-8 bytes plus an 8-byte header."""
    return (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(8)).cast("long")


def _numbered_copies(copies: DataFrame) -> DataFrame:
    """Adds ``copy``, 0..n-1 among the rows of one ``h``: rows are numbered within the
    partitions of a checkpoint and shifted by the counts of those before, so copies of
    one record never meet in one task."""
    stored = checkpointed(copies.withColumn("part", F.spark_partition_id())
                          .withColumn("row", F.monotonically_increasing_id()))
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = stored.groupBy("h", "part").agg(F.count("*").alias("n")).select(
        "h", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    local = F.row_number().over(Window.partitionBy("h", "part").orderBy("row"))
    return (stored.withColumn("at", local).join(heads, ["h", "part"])
            .withColumn("copy", F.col("head") + F.col("at") - 1).drop("part", "row", "at", "head"))


def _scattered(records: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """``records`` with ``h``, the seeded hash of a record's id and text and of its number
    among copies; and (h, n, bytes), narrow and stored, of all of them."""
    hashed = records.withColumn("h", F.xxhash64(F.lit(seed), "id", "text"))
    keys = checkpointed(hashed.groupBy("h").agg(F.count("*").alias("n"), F.sum("record.size").alias("bytes")))
    repeated = keys.where("n > 1").select("h")
    if repeated.isEmpty():
        return hashed, keys
    own = F.when(F.col("copy") == 0, F.col("h")).otherwise(F.xxhash64("h", "copy"))
    copies = checkpointed(_numbered_copies(hashed.join(repeated, "h", "left_semi"))
                          .withColumn("h", own).select(*hashed.columns))
    sizes = copies.select("h", F.lit(1).cast("long").alias("n"), F.col("record.size").alias("bytes"))
    return (hashed.join(repeated, "h", "left_anti").select(*hashed.columns).unionByName(copies),
            keys.where("n = 1").unionByName(sizes))


def shuffle_into_shards(docs: DataFrame, n_shards: int = 24, seed: int = 17, bucket_bytes: int = 64 << 20,
                        least_buckets: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All records with ``size``, ``shard`` (0..n_shards-1) and ``slot`` (gapless
    from 0 in its shard), in shuffled order.

    Buckets hold ``bucket_bytes`` on average, or less where that makes under ``least_buckets``.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    # whole records as one column, so that no column of theirs clashes with ours
    records = docs.select(F.struct(*kept, record_size(text_col).alias("size")).alias("record"),
                          F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scattered, keys = _scattered(records, seed)
    total, n_rows = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_buckets = max(math.ceil(total / bucket_bytes), least_buckets)
    bucket = F.pmod("h", F.lit(n_buckets)).cast("int")
    # one row per bucket, at most total / bucket_bytes of them
    heads = running_offsets(keys.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")), "b", "n", "head").select("b", "head")

    buckets = (scattered.select(bucket.alias("b"), "h", "record").repartitionById(n_buckets, F.col("b"))
               .sortWithinPartitions("b", "h")  # the sort, not an array's, as a record may hold maps
               .groupBy("b").agg(F.collect_list("record").alias("rows"))
               .withColumn("rows", F.shuffle("rows", F.lit(seed))))
    placed = (buckets.join(F.broadcast(heads) if n_buckets <= BROADCAST_BUCKETS else heads, "b")
              .select("head", F.posexplode("rows").alias("at", "record")).withColumn("g", F.col("head") + F.col("at")))
    n = max(n_rows, 1)
    # shard s holds the places g with g * n_shards div n = s: from ceil(s * n / n_shards) on
    return (placed.withColumn("shard", F.expr(f"g * {n_shards}L div {n}L"))
            .withColumn("slot", F.expr(f"g - (shard * {n}L + {n_shards - 1}L) div {n_shards}L"))
            .select("record.*", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot")))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard; a bucket's rows lie in one or two of them, in slot order."""
    shuffled.write.partitionBy("shard").parquet(path)


def shard_digest(shuffled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of the sharding contract, from shuffled records."""
    return shuffled.select(
        F.col(id_col).alias("doc_id"), F.col("size").cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
