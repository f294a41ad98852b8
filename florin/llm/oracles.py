"""SQL for a second engine, for the operators whose whole result it can express.

Everything is written out over all rows: pairs come from joins on shared shingles,
links are followed by recursion, windows are compared as texts.
"""

from __future__ import annotations

from florin.llm.license_scan import BASE, NOTICES, SHORT_WORD, allowed_edits
from florin.llm.url_filter import ALPHABET, BINS, CLASSES, GRAMS, LOWER, MERGED, MERGED_TO, PRIOR, UNIT, UPPER

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

NGRAM_JACCARD = rf"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY w) AS s, w FROM (SELECT DISTINCT w FROM d WHERE len(w) > 0)),
starts AS (SELECT s, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM n),
shingles AS MATERIALIZED (SELECT DISTINCT s, array_to_string(w[k : k + 4], ' ') AS g FROM starts),
sizes AS MATERIALIZED (SELECT s, count(*) AS size FROM shingles GROUP BY s),
common AS (
  SELECT x.s AS a, y.s AS b, count(*) AS n FROM shingles x JOIN shingles y USING (g) WHERE x.s < y.s GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.s = a JOIN sizes y ON y.s = b WHERE 100 * n >= 75 * (x.size + y.size - n)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(s, t) AS (SELECT s, s FROM n UNION SELECT s, b FROM reach JOIN both_ways ON a = t),
least_doc AS (SELECT s, min(doc_id) AS doc_id FROM n JOIN d USING (w) GROUP BY s),
component AS (
  SELECT reach.s, min(doc_id) AS component_id FROM reach JOIN least_doc ON least_doc.s = t GROUP BY reach.s)
SELECT doc_id, coalesce(size, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN n USING (w) LEFT JOIN sizes USING (s) LEFT JOIN component USING (s)
"""

_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
i_starts AS (
  SELECT item, w, least(len(w), 10) AS span, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k
  FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, span, array_to_string(w[k : k + span - 1], ' ') AS words FROM i_starts),
spans AS (SELECT DISTINCT span FROM windows),
d_starts AS (
  SELECT doc_id, span, w, unnest(range(1, len(w) - span + 2)) AS k FROM d JOIN spans ON len(w) >= span),
d_windows AS (SELECT doc_id, span, k, array_to_string(w[k : k + span - 1], ' ') AS words FROM d_starts),
hits AS (SELECT doc_id, item, span, k FROM d_windows JOIN windows USING (span, words)),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(k, k + span)) AS k FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY doc_id),
own AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hits USING (doc_id) LEFT JOIN own USING (doc_id)
"""

URL_FILTER = rf"""
WITH
p AS (
  SELECT row_number() OVER () AS r, page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT r, page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts),
marked AS MATERIALIZED (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS by_rule,
         translate(translate(coalesce(url, ''), '{UPPER}', '{LOWER}'), '{MERGED}', '{MERGED_TO}') AS plain
  FROM ruled),
places AS (SELECT r, by_rule, plain, unnest(range(1, length(plain) + 1)) AS k FROM marked),
classes AS (SELECT r, by_rule, k, strpos('{ALPHABET}', substr(plain, k, 1)) AS c FROM places),
grams AS MATERIALIZED (
  SELECT r, by_rule, {CLASSES**2} * lag(c, 2, 0) OVER own + {CLASSES} * lag(c, 1, 0) OVER own + c AS gram
  FROM classes WINDOW own AS (PARTITION BY r ORDER BY k)),
counts AS (SELECT by_rule AS verdict, gram, count(*) AS n FROM grams WHERE by_rule IS NOT NULL GROUP BY ALL),
grid AS (
  SELECT CASE WHEN i < {GRAMS} THEN 'allow' ELSE 'block' END AS verdict, i % {GRAMS} AS gram FROM range({2 * GRAMS}) t(i)),
filled AS (
  SELECT verdict, gram, coalesce(n, 0) AS n, gram // {CLASSES} AS ab, gram % {CLASSES**2} AS bc,
         gram // {CLASSES} % {CLASSES} AS b, gram % {CLASSES} AS c
  FROM grid LEFT JOIN counts USING (verdict, gram)),
summed AS (
  SELECT verdict, gram, n,
         CAST(sum(n) OVER (PARTITION BY verdict, ab) AS DOUBLE) AS n_ab,
         CAST(sum(n) OVER (PARTITION BY verdict, bc) AS DOUBLE) AS n_bc,
         CAST(sum(n) OVER (PARTITION BY verdict, b) AS DOUBLE) AS n_b,
         CAST(sum(n) OVER (PARTITION BY verdict, c) AS DOUBLE) AS n_c,
         CAST(sum(n) OVER (PARTITION BY verdict) AS DOUBLE) AS n_all
  FROM filled),
order_0 AS (SELECT *, (n_c + 1) / (n_all + {CLASSES}) AS p_0 FROM summed),
order_1 AS (SELECT *, (n_bc + CAST({PRIOR} AS DOUBLE) * p_0) / (n_b + CAST({PRIOR} AS DOUBLE)) AS p_1 FROM order_0),
order_2 AS (SELECT *, (n + CAST({PRIOR} AS DOUBLE) * p_1) / (n_ab + CAST({PRIOR} AS DOUBLE)) AS p_2 FROM order_1),
weights AS (
  SELECT gram, sum(CAST(round(CASE verdict WHEN 'allow' THEN ln(p_2) ELSE -ln(p_2) END * {UNIT}) AS BIGINT)) AS weight
  FROM order_2 GROUP BY gram),
totals AS (
  SELECT r, CAST(sum(weight) AS DOUBLE) / CAST(count(*) * {UNIT} AS DOUBLE) AS difference
  FROM grams JOIN weights USING (gram) GROUP BY r),
scored AS MATERIALIZED (SELECT marked.*, coalesce(difference, CAST(0 AS DOUBLE)) AS difference FROM marked LEFT JOIN totals USING (r)),
bins AS (
  SELECT floor(difference * {BINS}) AS bin, count(*) FILTER (by_rule = 'allow') AS good, count(*) FILTER (by_rule = 'block') AS bad
  FROM scored WHERE by_rule IS NOT NULL GROUP BY ALL),
errors AS (
  SELECT bin, CAST(coalesce(sum(good) OVER below, 0) AS DOUBLE) AS good_below, CAST(coalesce(sum(bad) OVER below, 0) AS DOUBLE) AS bad_below,
         CAST(sum(good) OVER () AS DOUBLE) AS goods, CAST(sum(bad) OVER () AS DOUBLE) AS bads
  FROM bins WINDOW below AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (
  SELECT bin FROM errors WHERE goods > 0 AND bads > 0
  ORDER BY good_below / goods + (bads - bad_below) / bads, abs(bin), bin LIMIT 1),
border AS (SELECT coalesce(max(bin), 0) AS bin FROM best)
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN floor(difference * {BINS}) >= border.bin THEN 'allow' ELSE 'block' END) AS verdict, difference
FROM scored CROSS JOIN border
"""


def _notices() -> str:
    rows = (
        f"('{phrase}', '{label}', {(phrase, label) in BASE}, {allowed_edits(phrase)}, {len(phrase.split())}, "
        f"{[w for w in phrase.split() if len(w) < SHORT_WORD]}::VARCHAR[])"
        for phrase, label in NOTICES
    )
    return ", ".join(rows)


# A notice is a run of whole words within so many edits of the phrase, with its short words as they are.
LICENSE_SCAN = rf"""
WITH
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
notices(phrase, label, base, edits, words, short) AS (VALUES {_notices()}),
forms AS (SELECT *, unnest(range(greatest(words - edits, 1), words + edits + 1)) AS width FROM notices),
widths AS (SELECT DISTINCT width FROM forms),
starts AS (SELECT r, w, len(w) AS n_words, unnest(range(1, len(w) + 1)) AS k FROM d),
runs AS (SELECT r, k - 1 AS word, width, array_to_string(w[k : k + width - 1], ' ') AS span FROM starts JOIN widths ON k + width - 1 <= n_words),
near AS (
  SELECT r, word, span, phrase, label, base, edits, short
  FROM runs JOIN forms USING (width) WHERE length(span) BETWEEN length(phrase) - edits AND length(phrase) + edits),
found AS MATERIALIZED (
  SELECT r, word, phrase, label, base, levenshtein(span, phrase) AS distance
  FROM near WHERE levenshtein(span, phrase) <= edits AND list_has_all(string_split(span, ' '), short)),
by_row AS (
  SELECT r, count(*) FILTER (base AND distance = 0) AS n_base,
         min(word) FILTER (base AND distance = 0) AS first_word, max(word) FILTER (base AND distance = 0) AS last_word,
         coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND distance = 0), '') AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(1.0::DOUBLE - distance / length(phrase)) AS score
  FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN by_row USING (r)
"""

HARD_NEGATIVES = """
WITH
e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(CAST(c AS DOUBLE) * 256) FOR c IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
scored AS MATERIALIZED (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS alike,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r) AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.alike
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

ORACLES: dict[str, str] = {
    "op11_license_scan": LICENSE_SCAN,
    "op13_hard_negatives": HARD_NEGATIVES,
    "op4_ngram_jaccard": NGRAM_JACCARD,
    "op6_decontamination": DECONTAMINATION,
    "op8_url_filter": URL_FILTER,
}
