"""Personal data: identifiers by pattern, and the terms that disclose them.

Entities are e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers,
found by pattern and protected by replacement.  What is left of a text can still
reveal an entity: a name, a street, a customer number that stands beside it wherever
it stands at all.  How strongly a term t reveals an entity e is estimated from the
corpus as pointwise mutual information against the entity's own information content,

    PMI(e; t) = log2(p(e, t) / (p(e) p(t))),    IC(e) = -log2 p(e) > 0,

where p counts documents: those that hold e, those that hold t, and those in which t
stands within ``window`` words of e.  The share PMI / IC is 1 where t only ever occurs
beside e, and 0 where it says nothing.  A term with a share of ``disclosure`` or more,
seen beside e in at least ``min_texts`` different texts (so that one text and its
exact copies are no evidence), discloses e.  In documents that hold e all its
occurrences are generalised to its first ``stem`` letters if all words that begin with
them together stay below the threshold, and removed otherwise.  Documents without an
entity are left as they are.

Two passes read the texts: one finds entities and the words of the documents that
hold any, the other counts in how many documents each candidate term occurs; it asks
a bit table of fixed size (``terms``).  All statistics run over all documents; a
document adds a row per entity and context term, so a very common entity is combined
map-side.

Patterns scan in linear time: e-mail addresses grow from each ``@``, number runs are
entered at their first digit only.

Defined cases: null texts hold nothing and count as documents; very long texts are
scanned whole; equal spans of several entities are reported once; repeated rows each
count and get their own result row; empty tables give no rows; extra columns are
dropped by ``scan_disclosures`` and kept by ``sanitise``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import Stage, checkpointed, fresh
from stockpulse.llm.terms import TermFilter, term_bits

# The base patterns, in the order of their kinds, then the method's own kinds.
KINDS = ("email", "ip", "card", "phone", "general", "remove")
EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IP_PART_MAX, CARD_DIGITS, PHONE_DIGITS = 255, range(13, 20), range(9, 16)

TERM = re.compile(r"[^\W_]{3,}")
#: Term counts a worker gathers before it passes them on.
COUNTED = 300_000

_LOCAL = frozenset(EMAIL_LOCAL)
_FOUND = ("id long, text_hash string, n_email long, n_ip long, n_card long, n_phone long, base string, "
          "entities array<struct<entity: string, terms: array<string>>>, "
          "words array<struct<term: string, spans: string>>")


def luhn(digits: str) -> bool:
    """Whether the Luhn sum of the digits ends in 0."""
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses that do not overlap: each grows to both sides of an ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", done)


def entity_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, entity) of every base match; an entity is its kind and folded value."""
    out = [(0, a, b, text[a:b].lower()) for a, b in emails(text)]
    out += [(1, *m.span(), m[0]) for m in IP.finditer(text) if all(
        len(p.lstrip("0")) <= 3 and int(p) <= IP_PART_MAX for p in m[0].split("."))]
    for kind, pattern, sizes in ((2, CARD, CARD_DIGITS), (3, PHONE, PHONE_DIGITS)):
        for m in pattern.finditer(text):
            digits = "".join(filter("0123456789".__contains__, m[0]))
            if len(digits) in sizes and (kind == 3 or luhn(digits)):
                out.append((kind, *m.span(), digits))
    return [(k, a, b, f"{KINDS[k]}:{e}") for k, a, b, e in out]


def levels(term: str, stem: int) -> list[str]:
    """The term, and the class of all words that begin as it does."""
    return [term, term[:stem] + "*"]


def read_document(text: str, window: int, stem: int) -> tuple[list, dict[str, set[str]], dict[str, list[str]]]:
    """Base spans, the terms near each entity (with their classes), the spans of every term."""
    base = entity_spans(text)
    near: dict[str, set[str]] = {}
    words: dict[str, list[str]] = {}
    if base:
        taken = sorted((a, b) for _, a, b, _ in base)
        starts, terms, at, reach = [], [], 0, 0
        for m in TERM.finditer(text):
            a, b = m.span()
            while at < len(taken) and taken[at][0] < b:
                reach = max(reach, taken[at][1])
                at += 1
            if reach <= a:  # clear of all base spans
                term = m[0].lower()
                starts.append(a)
                terms.append(term)
                words.setdefault(term, []).append(f"{a}:{b}")
        for _, a, b, entity in base:
            left, right = bisect_left(starts, a), bisect_left(starts, b)
            beside = set(terms[max(0, left - window):left] + terms[right:right + window])
            near.setdefault(entity, set()).update(x for t in beside for x in levels(t, stem))
    return base, near, words


def find_entities(docs: DataFrame, window: int, stem: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: base counts and spans, entities with their context, its words."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, near, words = read_document(text or "", window, stem)
                counts = Counter(k for k, *_ in base)
                rows.append((xxhash.xxh128_hexdigest(text or "") if base else None, *(counts[k] for k in range(4)),
                             ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, _ in base),
                             [{"entity": e, "terms": sorted(t)} for e, t in near.items()],
                             [{"term": t, "spans": ",".join(s)} for t, s in words.items()]))
            schema = pa.schema([("text_hash", pa.string()), *((f"n_{k}", pa.int64()) for k in KINDS[:4]), ("base", pa.string()),
                                ("entities", pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))]))),
                                ("words", pa.list_(pa.struct([("term", pa.string()), ("spans", pa.string())])))])
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)]
            yield pa.record_batch([batch.column(0), *columns], ["id", *schema.names])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(find, _FOUND)


def document_counts(docs: DataFrame, candidates: DataFrame, stem: int, text_col: str) -> DataFrame:
    """(term, df): in how many documents the terms of ``candidates`` (and perhaps others) occur."""
    bits = term_bits(candidates, "term")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed() -> pa.RecordBatch:
            return pa.record_batch([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], ["term", "df"])

        asked, counts = TermFilter(bits), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held = {w.lower() for w in set(TERM.findall(text or ""))}
                counts.update(t for t in held.union(w[:stem] + "*" for w in held) if asked(t.encode()))
                if len(counts) >= COUNTED:
                    yield listed()
                    counts.clear()
        yield listed()

    return (docs.select(F.col(text_col).cast("string")).mapInArrow(count, "term string, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


def disclosing_terms(docs: DataFrame, found: DataFrame, stage: Stage, disclosure: float, min_texts: int, stem: int,
                     text_col: str) -> DataFrame:
    """(entity, term, share, action): the terms that disclose an entity, and what becomes of them."""
    total = found.count()
    held = found.select("text_hash", F.explode("entities").alias("e"))
    entities = held.groupBy(F.col("e.entity").alias("entity")).agg(F.count("*").alias("df_e"))
    near = stage.table(
        held.select("text_hash", F.col("e.entity").alias("entity"), F.explode("e.terms").alias("term"))
        .groupBy("entity", "term", "text_hash").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("near"), F.count("*").alias("texts"))
        .where(F.col("texts") >= min_texts), "near")
    counts = document_counts(docs, near.select("term"), stem, text_col)
    information = F.log2(F.lit(float(total)) / F.col("df_e"))
    rated = stage.table(
        near.join(counts, "term").join(entities, "entity")
        .withColumn("share", F.log2(F.col("near") * F.lit(float(total)) / (F.col("df_e") * F.col("df"))) / F.nullif(
            information, F.lit(0.0)))
        .where(F.col("share") >= disclosure).select("entity", "term", "share"), "rated")
    # terms hold letters and digits only, so the star marks classes
    classes = rated.where(F.col("term").endswith("*")).select("entity", F.col("term").alias("class"),
                                                              F.lit(True).alias("revealing"))
    return (rated.where(~F.col("term").endswith("*"))
            .withColumn("class", F.concat(F.substring("term", 1, stem), F.lit("*"))).join(classes, ["entity", "class"], "left")
            .select("entity", "term", "share", F.when(F.col("revealing"), KINDS[5]).otherwise(KINDS[4]).alias("action")))


def scan_disclosures(docs: DataFrame, window: int = 10, disclosure: float = 0.9, min_texts: int = 3, stem: int = 4,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans) per document.

    Spans are ``kind:start:end`` by kind (``KINDS``), then start, in code points, end exclusive."""
    with Stage(docs.sparkSession) as stage:
        found = stage.table(find_entities(docs, window, stem, id_col, text_col)
                            .withColumn("row", F.monotonically_increasing_id()), "found")
        telling = disclosing_terms(docs, found, stage, disclosure, min_texts, stem, text_col).select("entity", "term", "action")
        holders = found.select("row", F.explode("entities.entity").alias("entity"))
        # one row per document and term; a term that one entity calls for removing is removed
        marks = holders.join(telling, "entity").groupBy("row", "term").agg(F.max("action").alias("action"))
        spelled = found.where(F.size("words") > 0).select("row", F.explode("words").alias("w")).select("row", "w.*")
        more = (spelled.join(marks, ["row", "term"])
                .select("row", "action", F.explode(F.split("spans", ",")).alias("span"))
                .groupBy("row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
                    "action", F.split_part("span", F.lit(":"), F.lit(1)).cast("int").alias("start"), "span"))),
                    lambda s: F.concat(s["action"], F.lit(":"), s["span"])), ",").alias("more")))
        out = found.select("row", "id", *[f"n_{k}" for k in KINDS[:4]], "base").join(more, "row", "left")
        return checkpointed(out.select(
            F.col("id").alias("doc_id"), *[f"n_{k}" for k in KINDS[:4]], F.col("base").alias("base_spans"),
            F.concat("base", F.coalesce(F.concat(F.lit(","), "more"), F.lit(""))).alias("spans")))


def redact(text: str | None, spans: str, stem: int) -> str | None:
    """The text with base spans replaced by their kind, other terms by their stem or by nothing."""
    if not spans or text is None:
        return text
    out, done = [], 0
    marks = ((kind, int(a), int(b)) for kind, a, b in (s.split(":") for s in spans.split(",")))
    for kind, a, b in sorted(marks, key=lambda m: (m[1], -m[2])):
        if b > done:  # base spans of different kinds may overlap: what is covered goes with the first
            a = max(a, done)
            out += [text[done:a], text[a:a + stem] + "*" if kind == KINDS[4] else "" if kind == KINDS[5] else f"<{kind}>"]
            done = b
    return "".join(out) + text[done:]


def sanitise(docs: DataFrame, window: int = 10, disclosure: float = 0.9, min_texts: int = 3, stem: int = 4,
             text_col: str = "text") -> DataFrame:
    """``docs`` with all their columns and the sanitised text in ``text_col``."""
    key, marks = fresh(docs, "_row"), fresh(docs, "_spans")
    with Stage(docs.sparkSession) as stage:
        numbered = stage.table(docs.withColumn(key, F.monotonically_increasing_id()), "docs")
        spans = scan_disclosures(numbered, window, disclosure, min_texts, stem, key, text_col)

        @F.pandas_udf("string")
        def cleaned(texts: pd.Series, spans: pd.Series) -> pd.Series:
            return pd.Series([redact(t, s, stem) for t, s in zip(texts, spans)], dtype=object)

        joined = numbered.join(spans.select(F.col("doc_id").alias(key), F.col("spans").alias(marks)), key)
        return checkpointed(joined.withColumn(text_col, cleaned(F.col(text_col), F.col(marks))).select(*docs.columns))
