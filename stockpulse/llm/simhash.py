"""SimHash near-dedup by a byte-position inverted index with count filtering.

A document's fingerprint holds, per bit, whether more than half of its shingles'
XXH64 values have that bit set.  Fingerprints that differ in two bits or fewer
agree in at least six of their eight positional bytes.  The index therefore
lists every distinct fingerprint under combinations of four positional bytes:
with the bytes taken as four pairs, two of the four pairs always agree, so six
lists per fingerprint find every link.  Pairs that meet in a list are tallied
(positional bytes in common), kept from six on, and verified bit by bit.

Lists longer than ``list_limit`` are not paired up.  Their members are instead
listed under themselves and each of their 64 one-bit neighbours: two fingerprints
share such a key exactly when they differ in two bits or fewer, and linking each
to the smallest one of the key keeps the components; work stays linear in the
members and nothing is skipped.

Documents with equal fingerprints are folded to one row before all this.
Defined cases: null or empty text has no words and fingerprint zero, linked like
any other; null ids are ignored by the minimum (the component of null ids alone
is null); repeated rows are all returned; an empty table gives no rows; extra
columns are not carried.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import checkpointed, connected_components, fresh

MAX_BITS = 2
MIN_BYTES = 8 - MAX_BITS
SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole text, as a signed integer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    stops = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(stops), _CHUNK):
        values = np.array([digest(joined[a:b - 1], SEED) for a, b in
                           zip(starts[at:at + _CHUNK], stops[at:at + _CHUNK])], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(votes * 2 > len(stops), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), simhash(F.col(text_col)).alias("fp"))


def _pair(fp: Column, k: int) -> Column:
    """Positional bytes 2k and 2k+1 of a fingerprint."""
    return F.shiftright(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))


def common_bytes(a: Column, b: Column) -> Column:
    """Tally: positional bytes that two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum((F.shiftright(x, 8 * k).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for k in range(8))


def fingerprint_links(fps: DataFrame, list_limit: int = 16) -> DataFrame:
    """(u, v): links between the distinct values ``fp`` that differ in at most
    two bits, enough of them to connect whatever is connected."""
    fp = F.col("fp")
    lists = [F.struct(F.lit(n).cast("byte").alias("list"),
                      F.shiftleft(_pair(fp, i), 16).bitwiseOR(_pair(fp, j)).alias("key"))
             for n, (i, j) in enumerate(combinations(range(4), 2))]
    index = fps.select("fp", F.explode(F.array(*lists)).alias("p")).select("fp", "p.list", "p.key")
    lengths = index.groupBy("list", "key").agg(F.count("*").alias("n")).where("n > 1")
    short = index.join(lengths.where(F.col("n") <= list_limit).select("list", "key"), ["list", "key"])
    pairs = (short.alias("a").join(short.alias("b"), ["list", "key"])
             .where(F.col("a.fp") < F.col("b.fp"))
             .where(common_bytes(F.col("a.fp"), F.col("b.fp")) >= MIN_BYTES)
             .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
    long_lists = lengths.where(F.col("n") > list_limit).select("list", "key")
    members = index.join(long_lists, ["list", "key"]).select("fp").distinct()
    near = members.select("fp", F.explode(F.array(fp, *[
        fp.bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)])).alias("key"))
    heads = near.groupBy("key").agg(F.min("fp").alias("head"), F.count("*").alias("n")).where("n > 1")
    stars = near.join(heads.select("key", "head"), "key").select(F.col("head").alias("u"), F.col("fp").alias("v"))
    return (pairs.unionByName(stars).where("u <> v")
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS).distinct())


def component_roots(fps: DataFrame, list_limit: int) -> DataFrame:
    """(fp, root) of every distinct value ``fp``: equal roots mean one component."""
    roots = connected_components(fingerprint_links(fps, list_limit))
    return fps.join(roots, fps.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 3, list_limit: int = 16,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    rows = checkpointed(fingerprints(docs, shingle, id_col, text_col))
    fps = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(fingerprint_links(fps, list_limit))
    linked = fps.join(roots, fps.fp == roots.node).select("fp", "root", "low")
    lowest = linked.groupBy("root").agg(F.min("low").alias("component"))
    of = linked.join(lowest, "root").select("fp", "component")
    # one row per fingerprint, stored, so that the join can split a fingerprint of very many copies
    named = checkpointed(fps.join(of, "fp", "left").select(
        "fp", F.coalesce("component", "low").alias("component_id")))
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """The rows of ``docs`` whose id names their component, one row per id: of components
    that the same id names, or a null id, one row stays (see ``one_row_per_component``)."""
    found = simhash_components(docs, id_col=id_col, **params)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    k = fresh(docs, "_key")
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias(k)).distinct()
    return docs.withColumn(k, key).join(heads, k, "left_semi").dropDuplicates([k]).drop(k)


def one_row_per_component(docs: DataFrame, shingle: int = 3, list_limit: int = 16,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, whatever the ids: the one with the
    smallest id (null last), then by hash of the text and of the row."""
    i, h = fresh(docs, "_key"), fresh(docs, "_hash")
    values = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    named = docs.withColumn(i, F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))).withColumn(
        h, F.xxhash64(*[F.struct(v.isNull(), v) for v in values]))

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    rows = checkpointed(named.select(
        simhash(F.col(text_col)).alias("fp"), F.col(id_col).isNull().alias("last"), F.col(i).alias("i"),
        F.xxhash64(F.col(text_col)).alias("t"), F.col(h).alias("h")))
    roots = checkpointed(component_roots(checkpointed(rows.select("fp").distinct()), list_limit))
    first = F.min(F.struct("last", "i", "t", "h"))
    # one row per fingerprint before the join, so that a fingerprint of very many copies meets in no task
    heads = (rows.groupBy("fp").agg(first.alias("head")).join(roots, "fp")
             .groupBy("root").agg(F.min("head").alias("head"))
             .select(F.col("head")["i"].alias(i), F.col("head")["h"].alias(h)))
    return named.join(heads, [i, h], "left_semi").dropDuplicates([i, h]).select(*docs.columns)
