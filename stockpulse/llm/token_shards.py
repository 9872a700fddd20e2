"""Token-ID output: training-order materialisation into fixed-stride shards.

1. Documents are tokenised once; each ends with the end-of-text id.  All tokens
   form one stream, in input order, and every task notes the offsets inside its
   own partition; partition totals (one row each) turn them into global ones.
2. The stream is cut into sequences of ``length`` - 1 ids.  A document gives a
   piece to each sequence it reaches.
3. A keyed Feistel permutation over the least even-bit domain that holds all
   sequences, walked along its cycles until it is back below their number, gives
   sequence s its slot in the training order: a bijection, computed per row.
4. Pieces go straight to the partition of their shard (slot ranges of
   ``per_shard``), in one compressed block per batch and shard; there each is put at
   its place in the shard's buffer, and the records are written in slot order.

A shard is raw little-endian uint16: record i of shard j is slot j * per_shard + i
and starts at byte i * 2 * length, so a reader seeks to any slot by arithmetic and
resumes there.  The last id of a record is its mark, the end-of-text id, which the
text writer puts between rows; the last record is padded with it.  Files go
through Spark's committer, so a task that is run again leaves no second copy.

Defined cases: a null or empty text is a document of just the end-of-text id;
repeated rows are tokenised each; null ids are listed as null; an empty table
writes nothing and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.llm.common import running_offsets

#: The vocabulary file; any byte-level one with at most 65,535 ids will do.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50_256
# Fixed value: how the public vocabulary's texts are split before merging.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_MASK = (1 << 64) - 1


def vocabulary(spark: SparkSession, path: str) -> list[bytes]:
    """The vocabulary file's lines (under 65,536): a file of the driver, or any URL that Spark reads."""
    if "://" in path:
        return [r[0].encode() for r in spark.read.text(path).collect()]
    with open(path, "rb") as f:
        return f.read().splitlines()


def encoder(lines: list[bytes]):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of few documents, which bounds what a task holds besides its input."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _little(ids: array) -> array:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


def token_table(docs: DataFrame, vocabulary_path: str, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, part, start, n, ids): ids as uint16 bytes, start within partition ``part``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(docs.sparkSession, vocabulary_path))
    end = np.array([END], dtype="<u2").tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode_ordinary
        part, at = TaskContext.get().partitionId(), 0
        for batch in _slices(batches):
            ids, starts, sizes = [], [], []
            for text in batch.column(1):
                own = _little(array("H", encode(text.as_py() or ""))).tobytes() + end
                ids.append(own)
                starts.append(at)
                sizes.append(len(own) // 2)
                at += len(own) // 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(ids), pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "part", "start", "n", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        tokenise, "doc_id long, part long, start long, n long, ids binary")


def _round(half: np.ndarray, key: int) -> np.ndarray:
    h = (half + np.uint64(key)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def round_keys(key: int, rounds: int = 6) -> list[int]:
    """Round keys from a key, by the golden-ratio sequence."""
    return [(key * 0xD1342543DE82EF95 + (r + 1) * 0x9E3779B97F4A7C15) & _MASK for r in range(rounds)]


def feistel(values: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0..n-1, or its inverse, of each value."""
    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = round_keys(key)
    out = values.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():  # cycle walking: every cycle that starts below n returns below n
        x = out[todo]
        left, right = x >> shift, x & low
        if inverse:
            for k in reversed(keys):
                left, right = right ^ (_round(left, k) & low), left
        else:
            for k in keys:
                left, right = right, left ^ (_round(right, k) & low)
        out[todo] = (left << shift) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def _slot(sequence: Column, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def slot(s: pd.Series) -> pd.Series:
        return pd.Series(feistel(s.to_numpy(), n, key))

    return slot(sequence)


class TokenShards:
    """Shards under ``path``, with what a reader has to know."""

    def __init__(self, path: str, length: int, per_shard: int, n_sequences: int, key: int):
        self.path, self.length, self.per_shard = path, length, per_shard
        self.n_sequences, self.key = n_sequences, key
        self.stride = 2 * length

    def read(self, spark: SparkSession, first_slot: int = 0, last_slot: int | None = None) -> DataFrame:
        """(slot, ids) of the records from ``first_slot`` on; ids as uint16 bytes.
        Only the folders of the shards asked for are listed and read."""
        last = self.n_sequences - 1 if last_slot is None else min(last_slot, self.n_sequences - 1)
        return self._records(spark, first_slot, last, bytes, "ids binary")

    def digests(self, spark: SparkSession) -> DataFrame:
        """(slot, crc32) of every record as written."""
        return self._records(spark, 0, self.n_sequences - 1, zlib.crc32, "crc32 long")

    def _records(self, spark: SparkSession, first: int, last: int, of: Callable, column: str) -> DataFrame:
        if not self.n_sequences:
            return spark.createDataFrame([], f"slot long, {column}")
        files = (spark.read.schema("path string, modificationTime timestamp, length long, content binary, shard int")
                 .format("binaryFile").load(self.path)
                 .where(F.col("shard").between(first // self.per_shard, last // self.per_shard)))
        stride, per_shard, name = self.stride, self.per_shard, column.split()[0]

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for shard, content in zip(batch["shard"], batch["content"]):
                    view = memoryview(content)
                    yield pd.DataFrame({
                        "slot": np.arange(len(view) // stride, dtype=np.int64) + int(shard) * per_shard,
                        name: [of(view[i:i + stride]) for i in range(0, len(view), stride)]})

        records = files.select("shard", "content").mapInPandas(cut, f"slot long, {column}")
        return records.where(F.col("slot").between(first, last))


def write_token_shards(tokens: DataFrame, path: str, length: int, per_shard: int,
                       key: int) -> tuple[TokenShards, DataFrame]:
    """Writes the shards of a ``token_table`` (which has to be a stored one, as it
    is read twice) and returns them with (sequence, slot, doc_id, start) of every piece."""
    cut = length - 1
    parts = tokens.groupBy("part").agg(F.sum("n").alias("_n"))
    total = parts.agg(F.sum("_n")).first()[0] or 0
    n_sequences = -(-total // cut)
    shards = TokenShards(path, length, per_shard, n_sequences, key)
    heads = running_offsets(parts, "part", "_n", "head").select("part", "head")
    # one row per partition of the token table
    placed = tokens.join(F.broadcast(heads), "part").withColumn("g", F.col("head") + F.col("start"))
    spread = F.sequence(F.expr(f"g div {cut}"), F.expr(f"(g + n - 1) div {cut}"))

    index = placed.select("doc_id", "g", F.explode(spread).alias("sequence")).select(
        "sequence", _slot(F.col("sequence"), max(n_sequences, 1), key).alias("slot"), "doc_id",
        F.greatest("g", F.col("sequence") * cut).alias("start"))
    if not n_sequences:
        return shards, index
    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per batch and shard one compressed block of pieces, each with its byte offset in the shard."""
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in _slices(batches):
            starts, parts = [], []
            for g, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                view = memoryview(ids.as_buffer())
                for low in (g, *range((g // cut + 1) * cut, g + n, cut)):
                    high = min(g + n, (low // cut + 1) * cut)
                    starts.append(low)
                    parts.append(view[2 * (low - g):2 * (high - g)])
            at = np.array(starts, dtype=np.int64)
            slots = feistel(at // cut, n_sequences, key)
            offsets = (slots % per_shard * cut + at % cut) * 2
            sizes = np.array([len(p) for p in parts], dtype=np.int64)
            shard = slots // per_shard
            order = np.argsort(shard, kind="stable")
            names, cuts = np.unique(shard[order], return_index=True)
            blocks = []
            for own in np.split(order, cuts[1:]):
                head = np.concatenate([[len(own)], offsets[own], sizes[own]]).astype("<i8").tobytes()
                blocks.append(pack(b"".join([head, *(parts[i] for i in own.tolist())])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array(blocks, pa.binary())], ["shard", "block"])

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The records of a shard, its pieces put where they belong; what none reaches is padding."""
        unpack = zstandard.ZstdDecompressor().decompress
        now, room = None, b""

        def records() -> pa.RecordBatch:
            n = min(per_shard, n_sequences - now * per_shard)
            return pa.RecordBatch.from_arrays(
                [pa.array([now] * n, pa.int32()), pa.array(range(now * per_shard, now * per_shard + n), pa.int64()),
                 pa.array([bytes(room[i * 2 * cut:(i + 1) * 2 * cut]) for i in range(n)], pa.binary())],
                ["shard", "slot", "bytes"])

        for batch in batches:
            for shard, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard != now:
                    if now is not None:
                        yield records()
                    now, room = shard, bytearray(END.to_bytes(2, "little") * (cut * per_shard))
                data = unpack(block.as_buffer())
                n = int.from_bytes(data[:8], "little")
                offsets, sizes = np.frombuffer(data, "<i8", 2 * n, 8).reshape(2, n).tolist()
                at, view = 8 * (1 + 2 * n), memoryview(data)
                for offset, size in zip(offsets, sizes):
                    room[offset:offset + size] = view[at:at + size]
                    at += size
        if now is not None:
            yield records()

    blocks = placed.select("g", "n", "ids").mapInArrow(cut_up, "shard int, block binary")
    records = (blocks.repartitionById(-(-n_sequences // per_shard), F.col("shard"))
               .sortWithinPartitions("shard").mapInArrow(join_up, "shard int, slot long, bytes binary")
               .sortWithinPartitions("shard", "slot")
               .select("shard", F.col("bytes").cast("string").alias("value")))
    end = END.to_bytes(2, "little")
    # the separator is the two bytes of the end-of-text id, so a record is 2 * length bytes
    (records.write.partitionBy("shard").option("encoding", "ISO-8859-1")
     .option("lineSep", end.decode("ISO-8859-1")).text(path))
    return shards, index


def sequence_index(shards: TokenShards, index: DataFrame) -> DataFrame:
    """(slot, sequence, shard, byte_offset, doc_ids) per sequence; a sequence holds
    at most ``length`` - 1 documents."""
    grouped = index.groupBy("slot", "sequence").agg(F.sort_array(F.collect_list(F.struct("start", "doc_id"))).alias("_d"))
    return grouped.select(
        "slot", "sequence", F.expr(f"cast(slot div {shards.per_shard} as int)").alias("shard"),
        (F.col("slot") % shards.per_shard * shards.stride).alias("byte_offset"),
        F.transform("_d", lambda d: d["doc_id"]).alias("doc_ids"))


def materialise(docs: DataFrame, stage, vocabulary_path: str = VOCABULARY, length: int = 1024,
                per_shard: int = 2048, key: int = 17, path: str | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> tuple[TokenShards, DataFrame]:
    """Tokenise, write the shards to ``path`` (in the stage's folder unless given),
    and return them with the index of their pieces."""
    tokens = stage.table(token_table(docs, vocabulary_path, id_col, text_col), "tokens")
    return write_token_shards(tokens, path or stage.path("shards"), length, per_shard, key)


def shard_report(docs: DataFrame, stage, **params) -> DataFrame:
    """Per sequence: slot, sequence, shard, byte_offset, doc_ids, and the CRC-32 of
    its record as read back from the shards."""
    shards, index = materialise(docs, stage, **params)
    return sequence_index(shards, index).join(shards.digests(docs.sparkSession), "slot")
