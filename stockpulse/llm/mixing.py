"""Mixing sources to target weights.

Words are summed per source (map-side combined), every source gets a target by
water-filling its weighted share of the budget under a repetition limit, and a
document is emitted floor(rate) times plus one Bernoulli copy, whose coin is a
hash of (seed, document id) and whose probability is the rate's fraction.

Defined cases: null text has size 0; a null source is a source of its own, last
in order; rows equal in id share one coin, as do all rows with a null id and
equal text; empty sources get target 0; an empty table gives no rows; columns
that are named like the added ones are replaced in ``mix_plan`` and kept as they
are by ``mix_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import BROADCAST_ROWS, WORD, checkpointed, dense_index, fresh

#: Draws are multiples of 2**-52, from 13 hex digits of a digest.
COIN_RANGE = float(1 << 52)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(seed: int, id_col: Column, text: Column) -> Column:
    """Uniform in [0, 1): digest of seed and id (of seed and text for a null id)."""
    key = F.coalesce(F.concat(F.lit("i"), id_col.cast("string")), F.concat(F.lit("t"), text), F.lit("n"))
    digest = F.md5(F.encode(F.concat(F.lit(f"{seed}:"), key), "UTF-8"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(COIN_RANGE)


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, limit: float) -> DataFrame:
    """(source, source_size, target) from per-source sums ``sizes``.

    Each round resharess the budget that capped sources leave by weight among the
    others, until no source is above ``limit`` times its size; a round is two
    sums over one row per source.
    """
    ranked = dense_index(sizes, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("_rank") % len(weights) + 1).cast("int"))
    t = checkpointed(ranked.select("source", "source_size", weight.alias("_w"),
                                   (F.col("source_size") * F.lit(limit)).alias("_cap")))
    budget = (t.agg(F.sum("source_size")).first()[0] or 0) * share
    capped, level = F.lit(False), 0.0
    n_capped = 0
    while True:
        row = t.agg(F.sum(F.when(capped, F.col("_cap"))).alias("used"),
                    F.sum(F.when(~capped, F.col("_w"))).alias("free")).first()
        if not row["free"]:
            break
        level = (budget - (row["used"] or 0.0)) / row["free"]
        above = capped | (F.col("_w") * F.lit(level) > F.col("_cap"))
        now = t.where(above).count()
        capped = F.col("_w") * F.lit(level) > F.col("_cap")
        if now == n_capped:
            break
        n_capped = now
    return t.select("source", "source_size",
                    F.least(F.col("_cap"), F.col("_w") * F.lit(level)).alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, limit: float = 2.0,
             seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target and copies."""
    added = ("size", "source_size", "target", "copies")
    sized = docs.select(*[c for c in docs.columns if c not in added], word_count(F.col(text_col)).alias("size"))
    src = fresh(sized, "_source")
    sizes = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, limit).select(
        F.col("source").alias(src), "source_size", "target")
    if targets.count() <= BROADCAST_ROWS:  # one row per source; beyond that, a shuffled join
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    extra = (coin(seed, F.col(id_col), F.col(text_col)) < rate - whole).cast("int")
    return (sized.join(targets, F.col(source_col).eqNullSafe(F.col(src))).drop(src)
            .withColumn("copies", (whole + extra).cast("int")))


def mix_documents(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: every document as often as its plan says, with the columns of ``docs``."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"),
                         *[F.col(params.get(k, d)).alias(d) for k, d in
                           (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))])
    general = {k: v for k, v in params.items() if not k.endswith("_col")}
    plan = mix_plan(packed, **general)
    return (plan.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("_row.*"))
