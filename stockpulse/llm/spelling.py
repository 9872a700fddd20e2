"""Spelling variants through pairs of trie nodes.

Words are runs of letters, counted over the whole corpus.  The vocabulary's forward
trie (prefixes) and reversed trie (suffixes) get numbered nodes; a word cut at
position i is the integer pair (node of its first i letters, node of the rest), and a
word with letter i left out is the pair (node of the letters before it, node of the
letters after it).  Two words of which one has one letter more share the pair of a
left-out letter and of a cut; two words that differ in one letter share the pair of
that letter left out.  So one exchange on integer pairs finds all neighbours at one
edit exactly: no string is compared and no candidate is verified.

A pair has at most one word cut there and, left out, at most one word per letter of
the alphabet, so groups are bounded by the alphabet; each member gets one row with
its number of neighbours and its best one, not one row per pair.  Of a run of equal
letters only the first is taken as left out against cuts, so that a neighbour counts
once.

Numbering: words are range-partitioned and sorted, and one scan gives new nodes to
the letters behind the prefix shared with the word before.  Nodes that reach over a
partition's edge are prefixes of the first word of a partition; those paths (one word
per partition) are numbered beforehand.  The work is linear in the letters, also for
very long words, and no group of words has to meet in one task.

A word's form is its most frequent neighbour if that is at least ``ratio`` times as
frequent as itself; roots follow the forms by pointer doubling (frequencies at least
double along a path, so paths are short).

Defined cases: null texts hold nothing; a null id reads as ``null`` where the id
decides on left-out letters; ties of frequency go to the smallest word in code-point
order; repeated rows count each time; empty tables give no rows; only the id and the
text column are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import Stage, checkpointed

#: Distinct words a worker counts before it passes its counts on.
COUNTED = 300_000
#: Pairs in one Arrow batch.
PAIRS = 100_000

# Letters are A-Z, a-z and U+00C0 to U+00FF, one byte each in Latin-1; A-Z is lower-cased.
_FOLD = bytes(ord(chr(b).lower()) if b < 0x80 and chr(b).isalpha() else b if b >= 0xC0 else 0x20 for b in range(256))


def runs_of(text: str | None) -> list[bytes]:
    """The letter runs of a text, A-Z lower-cased, in Latin-1."""
    return (text or "").encode("latin-1", "replace").translate(_FOLD).split()


def noisy_word(run: bytes, seed: int, every: int) -> bytes:
    """The run, one letter short if ``every`` divides the CRC-32 of ``<id>:<run>``.

    ``seed`` is the CRC-32 of ``<id>:``, from which that of the whole goes on."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, least_letters: int, least_count: int, every: int, id_col: str,
                text_col: str) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed() -> pa.RecordBatch:
            return pa.record_batch([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                    pa.array(counts.values(), pa.int64())], ["word", "n"])

        counts: Counter[bytes] = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = zlib.crc32(f"{key}:".encode())
                for run, n in Counter(runs_of(text)).items():
                    if len(run) >= least_letters:
                        word = noisy_word(run, seed, every)
                        if len(word) >= least_letters:
                            counts[word] += n
                if len(counts) >= COUNTED:
                    yield listed()
                    counts.clear()
        yield listed()

    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return (docs.select(key.alias("key"), F.col(text_col).cast("string")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def shared_letters(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def paths_of(words: list[str]) -> list[list[int]]:
    """Node numbers along each of the sorted ``words``: the root is 0, all others are below 0."""
    out, path, before, last = [], [0], "", 0
    for word in words:
        same = shared_letters(before, word)
        path = path[:same + 1] + [last - k for k in range(1, len(word) - same + 1)]
        last -= len(word) - same
        out.append(path)
        before = word
    return out


class NodeScan:
    """Numbers the nodes along a partition's words, given in order.

    ``first`` is the partition's first word, ``edge`` the next partition's (empty
    if there is none): prefixes of these two carry the numbers given with them."""

    def __init__(self, part: int, first: str, first_path: list[int], edge: str, edge_path: list[int]):
        self.edge, self.edge_path = edge, edge_path
        self.before, self.path, self.last = first, first_path, part << 40

    def __call__(self, word: str) -> list[int]:
        same = shared_letters(self.before, word)
        known = max(same, shared_letters(word, self.edge))
        fresh = len(word) - known
        self.path = (self.path[:same + 1] + self.edge_path[same + 1:known + 1]
                     + list(range(self.last + 1, self.last + fresh + 1)))
        self.last += fresh
        self.before = word
        return self.path


def ranged_words(words: DataFrame, key: Column) -> tuple[DataFrame, dict[int, tuple]]:
    """The words ordered by ``key`` over range partitions (columns key, part), and per
    partition the arguments of its ``NodeScan``: one word of each partition and the
    numbers along it reach the driver."""
    # by number: a letter's nodes and pairs are many times its size, so partitions are not coalesced by bytes
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(words.withColumn("key", key).repartitionByRange(parts, "key").sortWithinPartitions("key")
                          .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    heads = sorted(tuple(r) for r in ranged.groupBy("part").agg(F.min("key")).collect())
    paths = paths_of([w for _, w in heads])
    known = [(w, p) for (_, w), p in zip(heads, paths)] + [("", [0])]
    return ranged, {part: (part, *known[i], *known[i + 1]) for i, (part, _) in enumerate(heads)}


def number_prefixes(words: DataFrame) -> DataFrame:
    """(word, n, wid, front): ids in code-point order and the forward trie's nodes of each word."""
    ranged, scans = ranged_words(words, F.col("word"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = None
        for batch in batches:
            if batch.num_rows:
                scan = scan or NodeScan(*scans[batch.column("part")[0].as_py()])
                paths = [scan(word) for word in batch.column("word").to_pylist()]
                yield pa.record_batch([*(batch.column(c) for c in ("word", "n", "at")),
                                       pa.array(paths, pa.list_(pa.int64()))], ["word", "n", "wid", "front"])

    return ranged.select("part", "word", "n", "at").mapInArrow(
        number, "word string, n long, wid long, front array<long>")


def node_pairs(numbered: DataFrame) -> DataFrame:
    """(p, s, cut, first, wid, n): every cut and every left-out letter of every word."""
    ranged, scans = ranged_words(numbered, F.reverse("word"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            return pa.record_batch([pa.array(c) for c in columns], ["p", "s", "cut", "first", "wid", "n"])

        scan, held, size = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            scan = scan or NodeScan(*scans[batch.column("part")[0].as_py()])
            for key, wid, n, front in zip(*(batch.column(c).to_pylist() for c in ("key", "wid", "n", "front"))):
                front, back = np.array(front, np.int64), np.array(scan(key), np.int64)[::-1]
                letters = np.frombuffer(key.encode("latin-1"), np.uint8)[::-1]
                long = len(letters)
                # cuts 0..long, then the letters 0..long-1 left out
                held.append((np.concatenate([front, front[:-1]]), np.concatenate([back, back[1:]]),
                             np.arange(2 * long + 1) <= long,
                             np.concatenate([np.zeros(long + 1, bool), [True], letters[1:] != letters[:-1]]),
                             np.full(2 * long + 1, wid, np.int64), np.full(2 * long + 1, n, np.int64)))
                size += 2 * long + 1
                if size >= PAIRS:
                    yield listed()
                    size = 0
        if held:
            yield listed()

    return ranged.select("key", "part", "wid", "n", "front").mapInArrow(
        pairs, "p long, s long, cut boolean, first boolean, wid long, n long")


def best_neighbours(pairs: DataFrame) -> DataFrame:
    """(wid, n_near, best): neighbours of each word that has any, and the best as (n, -wid)."""
    word = F.struct("n", (-F.col("wid")).alias("r"))
    groups = (pairs.groupBy("p", "s").agg(
        F.collect_list(F.when(~F.col("cut"), F.struct("n", (-F.col("wid")).alias("r"), "first"))).alias("short"),
        F.max(F.when(F.col("cut"), word)).alias("whole"))
        .where((F.size("short") > 1) | ((F.size("short") == 1) & F.col("whole").isNotNull())))
    grown = F.filter("short", lambda x: x["first"])
    plain = lambda x: F.struct(x["n"].alias("n"), x["r"].alias("r"))
    one = F.explode(F.col("short")).alias("u")
    members = groups.select("short", "whole", one).select(
        (-F.col("u.r")).alias("wid"),
        (F.size("short") - 1 + F.when(F.col("u.first") & F.col("whole").isNotNull(), 1).otherwise(0)).alias("near"),
        F.greatest(F.array_max(F.transform(F.filter("short", lambda x: x["r"] != F.col("u.r")), plain)),
                   F.when(F.col("u.first"), F.col("whole"))).alias("best"))
    wholes = groups.where(F.col("whole").isNotNull() & (F.size(grown) > 0)).select(
        (-F.col("whole.r")).alias("wid"), F.size(grown).alias("near"),
        F.array_max(F.transform(grown, plain)).alias("best"))
    return (members.where("near > 0").unionByName(wholes).groupBy("wid")
            .agg(F.sum("near").alias("n_near"), F.max("best").alias("best")))


def follow(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(wid, root): the last word on each path of links (wid, form), by pointer doubling."""
    now = checkpointed(links.select("wid", F.col("form").alias("root")))
    for _ in range(rounds):
        ahead = now.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        now = checkpointed(now.join(ahead, "root", "left").select(
            "wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not now.where("moved").limit(1).count():
            return now.select("wid", "root")
        now = now.select("wid", "root")
    raise RuntimeError(f"forms did not settle in {rounds} rounds")


def spelling_variants(docs: DataFrame, least_letters: int = 5, least_count: int = 3, ratio: int = 2,
                      every: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of the vocabulary."""
    with Stage(docs.sparkSession) as stage:
        words = stage.table(count_words(docs, least_letters, least_count, every, id_col, text_col), "words")
        numbered = stage.table(number_prefixes(words), "numbered")
        near = stage.table(best_neighbours(node_pairs(numbered)), "near")
        vocabulary = numbered.select("word", "n", "wid")
        formed = stage.table(
            vocabulary.join(near, "wid", "left")
            .withColumn("form", F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.r")))
            .select("wid", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form",
                    F.when(F.col("form").isNotNull(), F.col("best.n")).alias("form_n")), "formed")
        roots = follow(formed.where("form IS NOT NULL"))
        names = vocabulary.select(F.col("wid").alias("at"), F.col("word").alias("name"))
        linked = (formed.where("form IS NOT NULL").join(roots, "wid")
                  .join(names.select(F.col("at").alias("form"), F.col("name").alias("form_word")), "form")
                  .join(names.select(F.col("at").alias("root"), F.col("name").alias("root_word")), "root"))
        out = (linked.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near",
                             "form_n")
               .unionByName(formed.where("form IS NULL").select(
                   "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")))
        return checkpointed(out)
