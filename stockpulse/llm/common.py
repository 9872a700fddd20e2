"""Helpers shared by the training-data operators.

* ``Stage``: run-scoped tables in the shared folder the session names in
  ``spark.checkpoint.dir`` (so they survive lost executors), removed at the end.
* ``dense_index``: gapless 0..n-1 numbering of rows without a single-task sort.
* ``connected_components``: large-star / small-star on an edge table.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The word class of the contracts, in Java's regex syntax.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a checked small table is broadcast.
BROADCAST_ROWS = 20_000
#: Spark's setting by which a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a private one is set only where
    the session names none and everything runs in one local JVM (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(named)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a narrow table; Spark's cleaner removes it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Stage:
    """Scope for tables written to the shared folder.

    ``with Stage(spark) as st: t = st.table(df, "name")`` writes Parquet and
    reads it back; leaving the scope deletes the folder, so a result that is
    returned from inside has to be checkpointed first.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/llm-stage-{uuid.uuid4().hex}"

    def __enter__(self) -> "Stage":
        return self

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, codec: str = "zstd", tidy: bool = False) -> DataFrame:
        """Store ``df``; with ``tidy`` its shuffle files go when the write ends."""
        own = self.spark.conf.get(SHUFFLE_CLEANUP, None)
        if tidy:
            self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.option("compression", codec).parquet(self.path(name))
        finally:
            if tidy and own is None:
                self.spark.conf.unset(SHUFFLE_CLEANUP)
            elif tidy:
                self.spark.conf.set(SHUFFLE_CLEANUP, own)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def __exit__(self, *exc: object) -> None:
        remove(self.spark, self.root)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, whichever that is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (for pure ASCII that is what ``lower`` does, and faster)."""
    mapped = F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(mapped)


def running_offsets(counts: DataFrame, key: str, value: str, out: str, fan: int = 1024) -> DataFrame:
    """Exclusive running sum of ``value`` over integer ``key``, in two levels so
    that no task orders more than ``fan`` keys or the list of blocks."""
    blocks = counts.withColumn("_block", F.floor(F.col(key) / F.lit(fan)))
    inner = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.groupBy("_block").agg(F.sum(value).alias("_sum")).withColumn(
        "_blockhead", F.coalesce(F.sum("_sum").over(
            Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (blocks.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(heads.select("_block", "_blockhead"), "_block")
            .withColumn(out, F.col("_blockhead") + F.col("_in")).drop("_block", "_in", "_blockhead"))


def dense_index(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Number rows 0..n-1 by ``order``: range partitions are numbered locally
    and shifted by the sizes of the partitions before them.  The ranged rows are
    checkpointed first, so both uses see the same ranges."""
    ranged = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", 33)
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per partition: bounded by the partition count, so safe to broadcast
    heads = running_offsets(sizes, "_part", "_n", "_offset").select("_part", "_offset")
    return (ranged.withColumn("_part", part).join(F.broadcast(heads), "_part")
            .withColumn(out, F.col("_offset") + local).drop("_part", "_offset", "_mid"))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v): root is the smallest node.

    Alternates large-star and small-star steps, each a map-side combined minimum
    and a join (adaptive execution splits hot nodes), until the edge set stands
    still.  The edge table is checkpointed each round; nothing but two numbers
    comes to the driver.
    """
    e = checkpointed(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    last = mark(e)
    for _ in range(rounds):
        if not last[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v"))
        e = checkpointed(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = mark(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
