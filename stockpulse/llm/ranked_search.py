"""Ranked lexical search over a term-partitioned index, one term owner after another.

``tokenise`` reads every text once.  Documents are dealt into blocks; within a block
the index holds one row per term (the documents that hold it, with the integer term
factor), and every term has one of ``owners`` owners.  Items travel in bundles: for
each block a bundle starts with its terms and no scores, and visits the owners in
turn.  A visit is a cogroup of the bundles with that owner's part of the index; it
takes the terms of this owner off the bundle and adds their integer contributions to
the bundle's sparse accumulators (item, document, score).  After the last owner the
best documents of each block are listed and the final selection is made per item.

A visit drops an accumulator only if its score plus all that the bundle's remaining
terms can still add stays below the score that ``top`` documents of the block have
already: such a document cannot be among the item's best.  A term's factor is below
1,000,000, which bounds what remains.  Nothing is approximated.

The formula: a term's weight w = floor(1000 ln((2N + 2) / (2 df + 1))); a document's
m = 10 + (90 n N) div L; its score is the sum of w * ((10^9 tf) div (1000 tf + 8 m))
over the distinct terms of the item.

Sizes: blocks hold ``block_docs`` documents and about ``block_postings`` postings on
average, bundles ``bundle_items`` items, so a cogrouped pair is bounded whatever the
tables' sizes; a very common term is spread over all blocks.  The term list that the
tokeniser asks is a bit table of fixed size (``terms``).

Defined cases: null texts and texts without a term hold nothing and are never found;
an item without a term that occurs in the corpus gets no row; equal scores come by
ascending doc_id, null ids first; repeated documents are ranked each by itself, and
repeated items are answered each by itself; empty tables give no rows; of ``docs``
and ``items`` only the id and the text column are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import Stage, checkpointed, dense_index
from stockpulse.llm.terms import TermFilter, term_bits

#: No document's term factor reaches this.
FACTOR_LIMIT = 1_000_000
#: Blocks that share one copy of a bundle's terms when bundles are dealt to blocks.
BLOCKS_A_COPY = 256

# A-Z lower-cased; other ASCII signs separate; bytes of longer characters stay.
_FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))

_HITS = "id long, n long, terms array<string>, counts array<int>"
_INDEX = "block int, owner int, term string, found int, docs binary, factors binary, ids array<long>"
_STATE = ("block int, bundle int, ids array<long>, owner array<int>, term array<string>, item array<int>, "
          "weight array<long>, scores binary")


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


def _tokenise(table: DataFrame, id_col: str, text_col: str, bits: np.ndarray | None) -> DataFrame:
    """(id, n, terms, counts) per row; of the distinct terms only those that pass ``bits``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = TermFilter(bits) if bits is not None else None
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                held = Counter(words)
                kept = [t for t in held if listed(t)] if listed else list(held)
                sizes.append(len(words))
                terms.append([t.decode() for t in kept])
                counts.append([held[t] for t in kept])
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.string())),
                                   pa.array(counts, pa.list_(pa.int32()))], ["id", "n", "terms", "counts"])

    return table.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(read, _HITS)


def _invert(total_docs: int, total_terms: int):
    """Documents of one block -> its index: a row of ids, then one row per term."""
    def invert(docs: pa.Table) -> pa.Table:
        rows = docs.to_pylist()
        rows.sort(key=lambda r: (r["id"] is not None, r["id"] or 0))
        lists: dict[str, tuple[list[int], list[int]]] = {}
        for at, row in enumerate(rows):
            m = 10 + 90 * row["n"] * total_docs // total_terms
            for term, tf in zip(row["terms"], row["counts"]):
                where, factors = lists.setdefault(term, ([], []))
                where.append(at)
                factors.append(1_000_000_000 * tf // (1000 * tf + 8 * m))
        block = rows[0]["block"]
        out = [(block, -1, None, len(rows), None, None, [r["id"] for r in rows])]
        for term, (where, factors) in lists.items():
            out.append((block, None, term, len(where), np.array(where, "<i4").tobytes(),
                        np.array(factors, "<i4").tobytes(), None))
        columns = list(zip(*out))
        return pa.table({
            "block": pa.array(columns[0], pa.int32()), "owner": pa.array(columns[1], pa.int32()),
            "term": pa.array(columns[2], pa.string()), "found": pa.array(columns[3], pa.int32()),
            "docs": pa.array(columns[4], pa.binary()), "factors": pa.array(columns[5], pa.binary()),
            "ids": pa.array(columns[6], pa.list_(pa.int64()))})
    return invert


def pack_scores(scores: np.ndarray) -> bytes:
    """The positions and values above 0 of a flat score table, byte planes compressed."""
    at = np.flatnonzero(scores)
    gaps = np.diff(at, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T
    values = scores[at].astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(gaps.tobytes() + values.tobytes())


def unpack_scores(packed: bytes | None, size: int) -> np.ndarray:
    scores = np.zeros(size, np.int64)
    if packed:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
        n = len(raw) // 12
        gaps = np.ascontiguousarray(raw[:4 * n].reshape(4, n).T).view("<u4").ravel()
        at = np.cumsum(gaps, dtype=np.int64)
        scores[at] = np.ascontiguousarray(raw[4 * n:].reshape(8, n).T).view("<i8").ravel()
    return scores


def _visit(owner: int, bundle_items: int, top: int):
    """One owner's turn: its terms leave the bundle, their contributions join the scores."""
    def visit(bundles: pa.Table, lists: pa.Table) -> pa.Table:
        held = {t: (d, f) for t, d, f in zip(*(lists.column(c).to_pylist() for c in ("term", "docs", "factors")))}
        out = []
        for b in bundles.to_pylist():
            width = len(b["ids"])
            scores = unpack_scores(b["scores"], bundle_items * width).reshape(bundle_items, width)
            entries = list(zip(b["owner"], b["term"], b["item"], b["weight"]))
            read: dict[str, tuple[np.ndarray, np.ndarray]] = {}
            for at, term, item, weight in entries:
                if at == owner and term in held:
                    if term not in read:
                        docs, factors = held[term]
                        read[term] = np.frombuffer(docs, "<i4"), np.frombuffer(factors, "<i4").astype(np.int64)
                    where, factors = read[term]
                    scores[item, where] += weight * factors
            rest = [e for e in entries if e[0] != owner]
            if width > top:  # what cannot reach the block's best any more goes
                open_ = np.zeros(bundle_items, np.int64)
                for _, _, item, weight in rest:
                    open_[item] += weight * FACTOR_LIMIT
                reached = np.partition(scores, width - top, axis=1)[:, width - top]
                scores[scores + open_[:, None] < reached[:, None]] = 0
            columns = list(zip(*rest)) or [[], [], [], []]
            out.append((b["block"], b["bundle"], b["ids"], *map(list, columns), pack_scores(scores.ravel())))
        columns = list(zip(*out)) if out else [[]] * 8
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()),
                 pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]
        names = ["block", "bundle", "ids", "owner", "term", "item", "weight", "scores"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)
    return visit


def _best(bundle_items: int, top: int):
    """The best documents of a block for each item of the bundle."""
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, ids, points = [], [], []
            for b in batch.to_pylist():
                width = len(b["ids"])
                scores = unpack_scores(b["scores"], bundle_items * width).reshape(bundle_items, width)
                for item in np.flatnonzero(scores.any(axis=1)).tolist():
                    # ids ascend within a block, so a stable order breaks ties by id
                    for at in np.argsort(-scores[item], kind="stable")[:top].tolist():
                        if scores[item, at] > 0:
                            items.append(b["bundle"] * bundle_items + item)
                            ids.append(b["ids"][at])
                            points.append(int(scores[item, at]))
            yield pa.record_batch([pa.array(items, pa.int64()), pa.array(ids, pa.int64()),
                                   pa.array(points, pa.int64())], ["item_no", "doc_id", "score"])
    return best


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 10, owners: int = 4, block_docs: int = 2048,
                  block_postings: int = 262_144, bundle_items: int = 128, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item."""
    spark = docs.sparkSession
    with Stage(spark) as stage:
        numbered = dense_index(items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")),
                               [F.col("item_id").asc_nulls_first(), F.col("text").asc_nulls_first()], "item_no")
        asked = stage.table(_tokenise(numbered, "item_no", "text", None)
                            .select(F.col("id").alias("item_no"), F.explode("terms").alias("term")), "asked")
        hits = stage.table(_tokenise(docs, id_col, text_col, term_bits(asked, "term"))
                           .withColumn("row", F.monotonically_increasing_id()), "hits")
        held, total, rows, postings = hits.agg(
            F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0)), F.count("*"),
            F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
        blocks = max(1, math.ceil(rows / block_docs), math.ceil(postings / block_postings))
        (hits.where(F.size("terms") > 0).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
         .groupBy("block").applyInArrow(_invert(held, total), _INDEX)
         .withColumn("owner", F.coalesce("owner", F.pmod(F.xxhash64("term"), F.lit(owners)).cast("int")))
         .write.partitionBy("owner").option("compression", "zstd").parquet(stage.path("index")))

        def index(rows: str) -> DataFrame:
            """A read of its own, so that a stage can be grouped with the next owner's lists."""
            return spark.read.schema(_INDEX).parquet(stage.path("index")).where(rows)

        frequency = index("owner >= 0").groupBy("term").agg(F.sum("found").alias("df"))
        weighted = (asked.join(frequency, "term").withColumn("weight", F.floor(
            F.lit(1000.0) * F.log((F.lit(2.0 * held + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long"))
            .withColumn("owner", F.pmod(F.xxhash64("term"), F.lit(owners)).cast("int"))
            .withColumn("bundle", F.expr(f"cast(item_no div {bundle_items} as int)"))
            .withColumn("item", F.expr(f"cast(item_no % {bundle_items} as int)")))
        copies = math.ceil(blocks / BLOCKS_A_COPY)
        bundles = (weighted.groupBy("bundle").agg(F.collect_list(F.struct("owner", "term", "item", "weight")).alias("e"))
                   .select("bundle", *[F.col(f"e.{c}").alias(c) for c in ("owner", "term", "item", "weight")],
                           F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")))
        last = asked.agg(F.max(F.expr(f"cast(item_no div {bundle_items} as int)"))).first()[0] or 0
        every = F.explode(F.sequence(F.lit(0), F.lit(last))).alias("bundle")
        state = (index("owner = -1").select("block", "ids", F.expr(f"block div {BLOCKS_A_COPY}").alias("copy"), every)
                 .join(bundles, ["bundle", "copy"])
                 .select("block", "bundle", "ids", "owner", "term", "item", "weight",
                         F.lit(None).cast("binary").alias("scores")))
        for owner in range(owners):
            lists = index(f"owner = {owner}").select("block", every, "term", "docs", "factors")
            state = (state.groupBy("block", "bundle").cogroup(lists.groupBy("block", "bundle"))
                     .applyInArrow(_visit(owner, bundle_items, top), _STATE))
        listed = state.mapInArrow(_best(bundle_items, top), "item_no long, doc_id long, score long")
        order = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        ranked = listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        return checkpointed(ranked.join(numbered.select("item_no", "item_id"), "item_no")
                            .select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
