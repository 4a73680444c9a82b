"""DuckDB SQL of the numbered queries that SQL can express."""

from __future__ import annotations

from gridmart.llm.mixing import MAX_RATE, SEED, SEEDS
from gridmart.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (SELECT k, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs),
windows AS (
  SELECT k, pos, CASE WHEN lead(pos, 4) OVER w IS NOT NULL THEN
    [word, lead(word) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w] END AS five
  FROM placed WINDOW w AS (PARTITION BY k ORDER BY pos)),
twice AS (SELECT k, pos, five IS NOT NULL AND count(*) OVER (PARTITION BY k, five) > 1 AS again FROM windows),
covered AS (
  SELECT k, max(CAST(again AS INT)) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM twice),
repeats AS (SELECT k, sum(c) AS n FROM covered GROUP BY k),
lines AS (SELECT k, unnest(string_split(text, chr(10))) AS line FROM docs),
dups AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM lines
         WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
measured AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(dups.n_lines, 0) AS BIGINT) AS n_lines,
    CAST(len(list_filter(words, lambda w: lower(w) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
    CAST(length(regexp_replace(text, '[^!?]+', '', 'g')) AS BIGINT) AS n_marks
  FROM docs d LEFT JOIN dups USING (k) LEFT JOIN repeats USING (k)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words >= 10
  AND word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 14.0
  AND n_symbols / greatest(n_words, 1) <= 0.15::DOUBLE AND n_marks / greatest(n_words, 1) <= 0.5::DOUBLE
  AND (n_words < 60 OR n_stop_words / greatest(n_words, 1) >= 0.02::DOUBLE)
  AND n_dup_lines / greatest(n_lines, 1) <= 0.5::DOUBLE AS kept,
  n_lines, n_stop_words, n_marks
FROM failed
"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws('|', coalesce(source, 'null'), coalesce(CAST(doc_id AS VARCHAR), 'null'), md5(coalesce(text, '')),
      CAST(row_number() OVER (PARTITION BY source, doc_id, coalesce(text, '')) - 1 AS VARCHAR))) AS digest FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight,
            source_size * {MAX_RATE}::DOUBLE AS cap FROM per),
shared AS (
  SELECT *, row_number() OVER o AS nth,
    ((SELECT sum(source_size) FROM per) - coalesce(sum(cap) OVER before, 0.0::DOUBLE))
    / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0)) AS share
  FROM weighed WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST),
    before AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(share, nth) AS level FROM shared WHERE cap / weight >= share),
targets AS (SELECT source, source_size, least(cap, coalesce(level * weight, 0.0::DOUBLE)) AS target FROM shared, level),
rated AS (
  SELECT s.doc_id, s.source, s.size, s.digest, t.source_size, t.target,
    coalesce(t.target / nullif(t.source_size, 0), 0.0::DOUBLE) AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
drawn AS (
  SELECT r.*, pick, CAST(size * (floor(rate) + CASE WHEN
      (CAST('0x' || substr(md5('{SEED}|' || pick || '|' || digest), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE
      < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
  FROM rated r, range({SEEDS}) AS seeds(pick)),
tried AS (SELECT source, pick, abs(sum(taken) - any_value(target)) AS miss FROM drawn GROUP BY source, pick),
best AS (SELECT source, pick FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, pick) = 1)
SELECT d.doc_id, d.size, d.source_size, CAST(d.target AS DOUBLE) AS target, d.taken
FROM drawn d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.pick = b.pick
"""

FILL_IN_MIDDLE = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
drawn AS (
  SELECT *, [CAST('0x' || substr(hex, 8 * k + 1, 8) AS BIGINT) FOR k IN [0, 1, 2, 3]] AS h FROM docs),
cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parted AS (SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1) AS suf FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""

_TERMS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
sized AS (SELECT k, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized),
scaled AS (SELECT k, doc_id, 100 - 75 + ((75 * n * n_docs) // n_terms) AS m FROM sized, totals),
items AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
asked AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
held AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM docs)
         WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM held, totals GROUP BY term),
scores AS (
  SELECT q, any_value(item_id) AS item_id, k, any_value(doc_id) AS doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weighed USING (term) JOIN scaled USING (k) GROUP BY q, k),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS r FROM scores WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 10
"""

SQL = {"op13_norm_buckets": SEARCH, "op12_fill_in_middle": FILL_IN_MIDDLE, "op7_quality_rules": QUALITY, "op8_mixing": MIXING}
