"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised (lower case, white space folded to one blank).  A test item
of n characters may occur with up to k = floor(n * max_error) edits.  It is split
into k + 1 pieces; an occurrence within k edits holds at least one piece exactly
and in place up to k.  All pieces of a block of items go into one Aho-Corasick
automaton, which reads each document once; every piece hit is verified by Myers'
bit-parallel distance of the whole item against the stretch around it.

Items are taken in blocks of at most ``block_chars`` characters in total, by
range of their order, so what is broadcast is bounded whatever the benchmark's
size; every block scans all documents and the hits are united.  Distinct item
texts are matched once and joined back to their ids.

Defined cases: null or empty texts hold nothing; items with no characters match
nothing; items that are shorter than ``min_piece`` * (k + 1) get a smaller k, so
that a piece never has fewer than ``min_piece`` characters; repeated items and
repeated documents are all reported; empty tables give no hits; extra columns
are not carried by ``find_leaks`` and stay in ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.llm.common import checkpointed



def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str, max_error: float, min_piece: int) -> int:
    """Edits allowed for an item: its share of errors, as long as pieces stay long enough."""
    return max(0, min(int(len(item) * max_error), len(item) // min_piece - 1))


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): ``edits`` + 1 pieces of nearly equal length."""
    n, k = len(item), edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(pattern: str, text: str, edits: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of ``pattern`` anywhere in ``text``
    within ``edits``, by Myers' bit-parallel recurrence on whole-pattern words."""
    m = len(pattern)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        where[ch] = where.get(ch, 0) | (1 << i)
    plus, minus, score = ones, 0, m
    best: tuple[int, int] | None = (m, 0) if m <= edits else None
    for j, ch in enumerate(text):
        eq = where.get(ch, 0)
        d0 = (((eq & plus) + plus) ^ plus) | eq | minus
        hp = minus | (~(d0 | plus) & ones)
        hn = plus & d0
        if hp & top:
            score += 1
        if hn & top:
            score -= 1
        hp, hn = (hp << 1) & ones, (hn << 1) & ones
        plus, minus = hn | (~(d0 | hp) & ones), hp & d0
        if score <= edits and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], max_error: float, min_piece: int):
        self.items = {}
        self.automaton = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for key, item in items:
            if item:
                k = budget(item, max_error, min_piece)
                self.items[key] = (item, k)
                for offset, piece in pieces(item, k):
                    at.setdefault(piece, []).append((key, offset))
        for piece, owners in at.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if at:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, stop, edits): the best occurrence at each place that a piece points to."""
        if not self.items or not text:
            return []
        found: dict[int, list[tuple[int, int, int]]] = {}
        tried: set[tuple[int, int]] = set()
        for last, (size, owners) in self.automaton.iter(text):
            for key, offset in owners:
                item, k = self.items[key]
                begin = last + 1 - size - offset
                cell = (key, begin // (k + 1))
                if cell in tried or any(abs(b - len(item) - begin) <= k for _, b, _ in found.get(key, ())):
                    continue
                tried.add(cell)
                low = max(0, begin - 2 * k - 1)
                hit = myers(item, text[low:begin + len(item) + 2 * k + 1], k)
                if hit:
                    stop = low + hit[1]
                    if any(abs(b - stop) <= k for _, b, _ in found.get(key, ())):
                        continue  # the same occurrence, by another piece
                    found.setdefault(key, []).append((max(0, stop - len(item) - k), stop, hit[0]))
        return sorted((key, max(a, b - len(self.items[key][0])), b, e)
                      for key, spans in found.items() for a, b, e in spans)


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """(key, text) of distinct normalised items, in blocks of at most
    ``block_chars`` characters (or of one longer item)."""
    sized = items.select("key", "item", F.char_length("item").alias("_n"))
    total = sized.agg(F.sum("_n")).first()[0] or 0
    parts = total // block_chars + 1
    while True:  # keys are hashes; the largest block is checked before any is collected
        block = F.pmod(F.col("key"), F.lit(parts))
        over = sized.groupBy(block.alias("_b")).agg(F.sum("_n").alias("_sum"), F.count("*").alias("_k")).where(
            (F.col("_sum") > block_chars) & (F.col("_k") > 1))
        if over.isEmpty():
            break
        parts *= 2
    for p in range(parts):
        rows = sized.where(block == p).orderBy("key").collect()
        yield [(r["key"], r["item"]) for r in rows]


def _items(benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """(item_id, item, key): normalised items with a hash of their text."""
    normal = F.pandas_udf(lambda s: s.map(normalise), "string")
    named = benchmark.select(F.col(item_col).alias("item_id"), normal(F.col(item_text)).alias("item"))
    return checkpointed(named.where("item <> ''").withColumn("key", F.xxhash64("item")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_error: float = 0.05, min_piece: int = 12,
               block_chars: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, stop, edits): occurrences of items in documents;
    ``stop`` is the end in the normalised text, ``start`` that less the item's length."""
    named = _items(benchmark, item_col, item_text)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hits = None
    for block in item_blocks(named.select("key", "item").distinct(), block_chars):
        scan = _scanner(docs.sparkSession, block, max_error, min_piece)
        own = rows.select("doc_id", scan("text").alias("hits")).where(F.size("hits") > 0)
        hits = own if hits is None else hits.unionByName(own)
    keyed = hits.select("doc_id", F.inline("hits")).withColumnRenamed("item", "key")
    return keyed.join(named.select("key", "item_id"), "key").select("doc_id", "item_id", "start", "stop", "edits")


def _scanner(spark: SparkSession, block: list[tuple[int, str]], max_error: float, min_piece: int):
    shared = spark.sparkContext.broadcast(block)

    @F.pandas_udf("array<struct<item:long,start:long,stop:long,edits:int>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, max_error, min_piece)  # once per task
        for texts in batches:
            yield pd.Series([[{"item": i, "start": a, "stop": b, "edits": e}
                              for i, a, b, e in matcher.find(normalise(t))] for t in texts])

    return scan


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_error: float = 0.05, min_piece: int = 12,
                      block_chars: int = 4_000_000, text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no benchmark item occurs; no row is moved."""
    named = _items(benchmark, item_col, item_text)
    for block in item_blocks(named.select("key", "item").distinct(), block_chars):
        scan = _scanner(docs.sparkSession, block, max_error, min_piece)
        docs = docs.where(F.size(scan(F.col(text_col))) == 0)
    return docs
