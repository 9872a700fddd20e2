"""DuckDB statements for the training-data queries that SQL can express."""

from __future__ import annotations

_MIX = """
WITH sized AS (
  SELECT doc_id, text, source,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sums AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM sums
), weighted AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         CASE rk % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM ranked
), filled AS (
  -- sources in the order in which they reach their limit; the level is that of
  -- the first source that stays below its limit once all before it are capped
  SELECT *, COALESCE(SUM(cap) OVER before, 0) AS used, SUM(w) OVER rest AS free,
         (SELECT 1.5::DOUBLE * SUM(source_size) FROM sums) AS budget
  FROM weighted
  WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT arg_min((budget - used) / free, cap / w) FILTER (WHERE w * ((budget - used) / free) <= cap) AS lv
  FROM filled
), targets AS (
  SELECT source, source_size, CASE WHEN w * lv > cap THEN cap ELSE w * lv END AS target FROM weighted, level
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('17:' || COALESCE('i' || s.doc_id, 't' || s.text, 'n')), 1, 13) AS BIGINT)
           / 4503599627370496.0::DOUBLE AS coin
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""

_LINES = """
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(COALESCE(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(COALESCE(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, MAX(doc_id) AS keep FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keep AS lost FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE lost) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_SEARCH = """
WITH doc AS (
  SELECT row_number() OVER () AS rw, doc_id,
         regexp_extract_all(COALESCE(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), item AS (
  SELECT row_number() OVER () AS ino, item_id,
         regexp_extract_all(COALESCE(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM benchmark
), total AS (
  SELECT CAST(COUNT(*) AS BIGINT) AS n_all, CAST(SUM(len(terms)) AS BIGINT) AS l_all FROM doc WHERE len(terms) > 0
), word AS (
  SELECT rw, translate(unnest(terms), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM doc
), posting AS (
  SELECT rw, term, CAST(COUNT(*) AS BIGINT) AS tf FROM word GROUP BY rw, term
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / CAST(2 * COUNT(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM posting, total GROUP BY term, n_all
), ask AS (
  SELECT DISTINCT ino, term FROM (
    SELECT ino, translate(unnest(terms), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM item)
), scored AS (
  SELECT a.ino, p.rw, CAST(SUM(w.w * ((1000000000 * p.tf)
           // (1000 * p.tf + 8 * (100 - 90 + ((90 * len(d.terms) * t.n_all) // t.l_all))))) AS BIGINT) AS score
  FROM ask a JOIN weight w USING (term) JOIN posting p USING (term) JOIN doc d ON d.rw = p.rw, total t
  GROUP BY a.ino, p.rw
), ranked AS (
  SELECT s.ino, d.doc_id, s.score,
         ROW_NUMBER() OVER (PARTITION BY s.ino ORDER BY s.score DESC, d.doc_id NULLS FIRST) AS rank
  FROM scored s JOIN doc d ON d.rw = s.rw WHERE s.score > 0
)
SELECT i.item_id, CAST(r.rank AS INTEGER) AS rank, r.doc_id, r.score
FROM ranked r JOIN item i ON i.ino = r.ino WHERE r.rank <= 10
"""

ORACLE: dict[str, str] = {"op2_mix_sources": _MIX, "op5_line_dedup": _LINES, "op12_ranked_search": _SEARCH}
