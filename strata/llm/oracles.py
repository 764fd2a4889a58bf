"""DuckDB SQL for the queries that SQL can express (the others are tested against brute force in tests/llm)."""

from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{_UP}', '{_LOW}') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
),
r(action, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
SELECT page_id, any_value(host) AS host, any_value(path) AS path, max_by(h || p, length(h || p)) FILTER (h IS NOT NULL) AS rule,
       coalesce(max_by(action, length(h || p)) FILTER (h IS NOT NULL), 'allow') AS verdict
FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id"""

OP2 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS m
  FROM documents
),
src AS (
  SELECT source, source_size, rank, 3.0::DOUBLE * source_size AS cap, (rank - 1) % 3 + 1 AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source)
),
lev AS (
  SELECT *, ((SELECT sum(source_size)::DOUBLE FROM src) - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM src
),
tgt AS (
  SELECT source, rank, source_size,
         coalesce(least(cap, (SELECT max(level) FROM lev WHERE level <= cap / weight) * weight), cap) AS target
  FROM lev
),
cuts AS (
  SELECT *, source_size // blocks AS length, source_size % blocks AS longer, floor(target * 1000)::BIGINT AS share
  FROM (SELECT *, greatest(ceil(source_size / words::DOUBLE)::BIGINT, 1) AS blocks
        FROM (SELECT *, greatest((1::BIGINT << (2 * band)) // 4096, 1) AS words
              FROM (SELECT *, ((length(bin(greatest(floor(target), 1)::BIGINT)) - 1) // 2)::INTEGER AS band FROM tgt)))
),
span AS (
  SELECT rank, band, floor((upto - share)::DOUBLE / total * 4294967296.0)::BIGINT AS lo, floor(upto::DOUBLE / total * 4294967296.0)::BIGINT AS hi,
         ((total + 1000 * words - 1) // (1000 * words))::BIGINT AS slots
  FROM (SELECT *, sum(share) OVER (PARTITION BY band ORDER BY rank) AS upto, sum(share) OVER (PARTITION BY band) AS total FROM cuts WHERE share > 0)
),
slot AS (
  SELECT rank, i, slots, row_number() OVER (PARTITION BY rank ORDER BY i) - 1 AS k
  FROM (SELECT band, any_value(slots) AS slots, unnest(range(any_value(slots))) AS i FROM span GROUP BY band) s JOIN span USING (band, slots)
  WHERE lo <= (i * 2654435769) % 4294967296 AND (i * 2654435769) % 4294967296 < hi
),
uses AS (
  SELECT rank, k % blocks AS b, count(*) AS n, min((i + 0.5::DOUBLE) / slots) AS first_at
  FROM slot JOIN cuts USING (rank) WHERE k < 3 * blocks GROUP BY ALL
),
placed AS (
  SELECT doc_id, s.source, size, source_size, target, rank, length, longer,
         sum(size) OVER (PARTITION BY rank ORDER BY m, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS e
  FROM sized s JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
),
ends AS (
  SELECT *, CASE WHEN e - size < longer * (length + 1) THEN (e - size) // (length + 1) ELSE longer + (e - size - longer * (length + 1)) // greatest(length, 1) END AS first,
         CASE WHEN e - 1 < longer * (length + 1) THEN (e - 1) // (length + 1) ELSE longer + (e - 1 - longer * (length + 1)) // greatest(length, 1) END AS last
  FROM placed WHERE size > 0
),
spread AS (
  SELECT rank, e, b, least(e, (b + 1) * length + least(b + 1, longer)) - greatest(e - size, b * length + least(b, longer)) AS words
  FROM (SELECT *, unnest(range(first, last + 1)) AS b FROM ends)
),
took AS (SELECT rank, e, sum(words * coalesce(n, 0))::BIGINT AS taken, min(first_at) AS first_at FROM spread LEFT JOIN uses USING (rank, b) GROUP BY rank, e)
SELECT doc_id, source, size, source_size, target, coalesce(CASE WHEN size > 0 THEN taken END, 0)::BIGINT AS taken, CASE WHEN size > 0 THEN first_at END AS first_at
FROM placed LEFT JOIN took USING (rank, e)"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP3 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark),
p AS (
  SELECT DISTINCT item, least(10, len(w)) AS l, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)
),
win AS (
  SELECT doc_id, l, k, array_to_string(w[k:k + l - 1], ' ') AS s
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS k FROM d, (SELECT DISTINCT l FROM p) WHERE len(w) >= l)
),
hit AS (SELECT doc_id, k, win.l, item FROM win JOIN p USING (l, s)),
n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + l)) AS pos FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (('0x' || substr(hex, (k // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (k % 4))::INTEGER & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM f"""

_SPLIT = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x20\x09-\x0D]+')"
OP7 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n, sum(hash(s)) AS h FROM sh GROUP BY doc_id),
class AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY n, h) AS class_id, n FROM n),
rep AS (SELECT sh.* FROM sh JOIN class USING (doc_id) WHERE doc_id = class_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM rep a JOIN rep b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
good AS (SELECT a, b FROM link JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach(a, b) AS (
  SELECT class_id, class_id FROM class
  UNION
  SELECT reach.a, e.b FROM reach JOIN (SELECT a, b FROM good UNION ALL SELECT b, a FROM good) e ON reach.b = e.a
),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(class.n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(class_id, d.doc_id) AS class_id
FROM d LEFT JOIN class USING (doc_id) LEFT JOIN comp ON a = class_id"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12 = rf"""
WITH d AS (SELECT doc_id, w, len(w)::BIGINT AS n FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
total AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM d),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY ALL),
wt AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // l))))::BIGINT AS score
  FROM i JOIN tf USING (t) JOIN wt USING (t), total GROUP BY ALL
),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""

ORACLES = {"op1_url_filter": OP1, "op2_mixing": OP2, "op3_decontaminate": OP3, "op6_warc": OP6, "op7_jaccard_join": OP7, "op12_ranked_search": OP12}
