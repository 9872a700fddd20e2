"""Line dedup by line hashes (DataFrame functions only).

1. Every line of at least ``min_chars`` gives an occurrence (128-bit key hash,
   document, position).  Occurrences are range-partitioned by hash, document and
   position, so even a line that a third of the documents hold is spread over
   several ranges.
2. Two hash aggregations, each with its own exchange, give one row per (hash,
   document) and then the number of documents and the kept document (the greatest
   id) per hash.  Nothing is sorted within ranges or streamed.
3. Positions to drop go back per document as a compressed keep bitmap: only the
   64-line words that lose a line, each with its bit mask.  No text is moved
   until the bitmaps meet the documents.

Defined cases: null or empty text is one empty line, which is never dropped; a
null id counts as one document below all others; rows equal in id and text get
the same result each; rows with one id and different texts count as one document;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import ascii_lower, checkpointed

# The characters stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, t, pos, h1, h2) of every line that can be dropped; ``t`` tells apart
    rows with one id and different texts."""
    key = line_key(F.col("line"))
    return (docs.select("id", "t", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
            .withColumn("key", key).where(F.char_length("key") >= min_chars)
            .select("id", "t", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), "key").alias("h2")))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, words): for each document that loses lines, the 64-line words with
    a dropped line and their drop masks, as array<struct<word, mask>>."""
    base = _keyed(docs, id_col, text_col)
    occ = checkpointed(occurrences(base, min_chars))  # narrow; used by the ranges' sample, the ranges and the join
    ranged = occ.repartitionByRange("h1", "h2", F.col("id").desc_nulls_last(), "pos")
    per_doc = ranged.groupBy("h1", "h2", "id").agg(F.count("*").alias("n"))
    verdict = (per_doc.groupBy("h1", "h2")
               .agg(F.count("*").alias("n_docs"), F.max("id").alias("keep"))
               .where(F.col("n_docs") >= min_docs).select("h1", "h2", "keep"))
    lost = occ.join(verdict, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keep")))
    word = F.floor(F.col("pos") / 64).cast("int")
    mask = F.expr("shiftleft(1L, pos % 64)")
    return (lost.groupBy("id", "t", word.alias("word")).agg(F.bit_or(mask).alias("mask"))
            .groupBy("id", "t").agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("words")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn(
        "t", F.xxhash64(F.coalesce("text", F.lit(""))))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) per document."""
    base = _keyed(docs, id_col, text_col)
    maps = keep_bitmaps(docs, min_chars, min_docs, id_col, text_col)
    joined = base.join(maps.select(F.col("id").alias("_i"), F.col("t").alias("_t"), "words"),
                       F.col("id").eqNullSafe(F.col("_i")) & (F.col("t") == F.col("_t")), "left")
    # dense masks up to the last word that loses a line, for direct access by position
    by_word = F.map_from_entries("words")
    dense = F.transform(F.sequence(F.lit(0), F.element_at("words", -1)["word"]),
                        lambda w: F.coalesce(F.try_element_at(by_word, w), F.lit(0).cast("long")))
    masks = F.when(F.col("words").isNull(), F.lit(None)).otherwise(dense)
    keep = F.expr("filter(lines, (x, i) -> "
                  "(shiftright(coalesce(get(masks, cast(i div 64 as int)), 0L), cast(i % 64 as int)) & 1L) = 0)")
    out = (joined.withColumn("lines", _lines(F.col("text"))).withColumn("masks", masks)
           .withColumn("kept", F.when(F.col("masks").isNull(), F.col("lines")).otherwise(keep)))
    return out.select(F.col("id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
                      (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
                      F.array_join("kept", "\n").alias("kept_text"))
