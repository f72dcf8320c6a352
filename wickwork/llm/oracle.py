"""SQL twins of the corpus queries that SQL can express."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op3_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[s + 1:s + least(len(w), 10)] AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
spots AS (
  SELECT r, n, s, w[s + 1:s + n] AS win
  FROM (SELECT r, w, lens.n AS n, unnest(range(0, len(w) - lens.n + 1)) AS s FROM d, lens)),
hits AS (SELECT r, s, spots.n AS n, item_id FROM spots JOIN win USING (win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM g
""",
    "op11_resample": f"""
WITH RECURSIVE steps AS (
  SELECT i, i AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tbl FROM steps WHERE k = 8),
w AS (
  SELECT true AS doc, row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
  UNION ALL SELECT false, row_number() OVER (), NULL, {_WORDS} FROM benchmark),
runs AS (
  SELECT doc, r, array_to_string(w[s + 1:s + n], ' ') AS f
  FROM (SELECT doc, r, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM w, (SELECT unnest([1, 2, 3]) AS n)
        WHERE len(w) >= n)),
often AS (SELECT doc, r, f, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT f, list_transform(range(strlen(f)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)) AS x
  FROM (SELECT DISTINCT f FROM often)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), x),
    lambda c, y: xor(c >> 8, tbl[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS b
  FROM bytes, crc),
placed AS (SELECT doc, r, b, sum(n) AS n FROM often JOIN hashed USING (f) GROUP BY ALL),
counts AS (
  SELECT b, coalesce(sum(n) FILTER (doc), 0) AS s, coalesce(sum(n) FILTER (NOT doc), 0) AS t FROM placed GROUP BY b),
total AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM counts),
gain AS (
  SELECT b, CAST(floor(1000 * ln(CAST((c.t + 1) * (total.s + 10000) AS DOUBLE)
    / CAST((c.s + 1) * (total.t + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM counts c, total),
weights AS (SELECT r, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * g) AS BIGINT) AS g
  FROM placed JOIN gain USING (b) WHERE doc GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(g, 0) AS weight,
    coalesce(g, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN weights USING (r) WHERE doc),
ranked AS (
  SELECT *, CASE WHEN words >= 20 THEN row_number() OVER (
    PARTITION BY words >= 20 ORDER BY score DESC, doc_id, n_features) END AS place,
    count(*) FILTER (words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM ranked
""",
    "op12_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tokens AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (
  SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, CAST(sum(total) AS HUGEINT) AS lang_n, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL),
groups AS (
  SELECT lang, source, CAST(coalesce(n, 0) AS HUGEINT) AS group_n, coalesce(lang_n, 0) AS lang_n, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN sums USING (lang, source) LEFT JOIN langs USING (lang)),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + 1000000000 * (coalesce(n, 0) + 1) // (group_n + v) AS p, 1 + 1000000000 * (total + 1) // (lang_n + v) AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
diff AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN diff ON diff.lang = a.lang AND diff.source = a.source AND diff.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}
