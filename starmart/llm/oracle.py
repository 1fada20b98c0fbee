"""DuckDB SQL for the queries that SQL can express.

The others use what SQL lacks: CRC32 (operators 1, 7 and 9), a vocabulary file
(7, 9), trained models over 64-bit hashes or trigrams (6, 8, 10), a parser of
markup (3) or Viterbi's recursion (5). Tests compare those with plain Python.
"""

from __future__ import annotations

# All pairs that share a shingle, compared on whole sets, then closed.
MINHASH = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 1),
                             lambda i: array_to_string(ws[i:i + 2], ' '))) END AS s
  FROM w),
n AS (SELECT doc_id, len(s) AS n FROM sets),
shingle AS (SELECT doc_id, unnest(s) AS x FROM sets),
both_of AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_of JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles,
       least(doc_id, coalesce(low, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM n LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) ON a = doc_id
"""

# Every alignment of a document and an item, by the tokens that agree in it; the
# best window starts or ends at an agreeing token, or at an end of the overlap.
SEEDS = r"""
WITH d AS (
  SELECT doc_id, len(t) AS n, unnest(t) AS tok, generate_subscripts(t, 1) AS place
  FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS t FROM documents)),
q AS (
  SELECT item_id, len(t) AS m, least(13, len(t)) AS w, unnest(t) AS tok, generate_subscripts(t, 1) AS off
  FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS t FROM benchmark)
  WHERE len(t) > 0),
agree AS (
  SELECT doc_id, item_id, w, place - off AS shift, off,
         greatest(1, 1 - (place - off)) AS low, least(m, n - (place - off)) AS high
  FROM d JOIN q USING (tok)),
dense AS (
  SELECT * FROM agree QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, shift) >= ceil(0.8 * w)),
best AS (
  SELECT doc_id, item_id, w, low, high, off,
         count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY off
                        RANGE BETWEEN CURRENT ROW AND (w - 1) FOLLOWING) AS after,
         count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY off
                        RANGE BETWEEN (w - 1) PRECEDING AND CURRENT ROW) AS before,
         count(*) FILTER (off < low + w) OVER (PARTITION BY doc_id, item_id, shift) AS first_window,
         count(*) FILTER (off > high - w) OVER (PARTITION BY doc_id, item_id, shift) AS last_window
  FROM dense WHERE high - low + 1 >= w),
leak AS (
  SELECT doc_id, item_id, w, greatest(
           first_window, last_window, CASE WHEN off + w - 1 <= high THEN after ELSE 0 END,
           CASE WHEN off - w + 1 >= low THEN before ELSE 0 END) AS agreeing
  FROM best)
SELECT doc_id, item_id, CAST(max(agreeing) AS INTEGER) AS agreeing, CAST(max(w) AS INTEGER) AS "window"
FROM leak WHERE agreeing >= ceil(0.8 * w) GROUP BY doc_id, item_id
"""

# The rules one by one, longest first; then words of a host's name and globs as patterns.
URLS = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
part AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
ruled AS (
  SELECT *, '.' || host AS h, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM part)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(h, '[.-](ads|adserver|adult|bets|betting|casino|casinos|malware|phishing|pills|poker|porn|spam|tracker|viagra|warez|xxx)[.-]')
      THEN 'block'
    WHEN contains(h || path, '/cgi-bin/') OR contains(h || path, '/wp-admin/') THEN 'block'
    WHEN regexp_matches(h || path, '(/wp-login[.]php|[.]exe|[.]zip)$') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

ORACLES: dict[str, str] = {
    "op2_circulant_minhash": MINHASH,
    "op4_spaced_seeds": SEEDS,
    "op13_shift_and_urls": URLS,
}
