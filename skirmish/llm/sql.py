"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(d, {5 * i + 1}, 5) AS BIGINT) >> {shift}) & 31)::INT + 1, 1)"
    for i in range(8) for shift in (15, 10, 5, 0))

OP1_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS d FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS kept FROM p)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes, {_DIGITS} AS payload_digest,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM q
"""

# What a URL's list key leaves out: see url_filter.canonical.
OP10_SQL = r"""
WITH u AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
                   lambda q: NOT regexp_matches(q, '^((utm_[a-z]*|ref|fbclid|gclid)(=.*)?)?$'))) AS kept
  FROM pages),
k AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
           regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '')
           || regexp_replace(regexp_replace(path, '/index\.html?$', '/'), '/+$', '')
           || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS key,
         CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM u),
l AS (SELECT DISTINCT key FROM k WHERE regexp_matches(host, '(^|[.-])(adult|casino|bets|pills|spam|ads)([.-]|$)') AND key IS NOT NULL)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM k LEFT JOIN l USING (key)
"""

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(CASE WHEN len(w) >= 3
           THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS grams
  FROM t),
c AS (SELECT row_number() OVER () AS node, min(doc_id) AS least, grams, len(grams) AS n FROM s WHERE len(grams) > 0 GROUP BY grams),
g AS (SELECT node, n, unnest(grams) AS gram FROM c),
l AS (
  SELECT x.node AS a, y.node AS b FROM g x JOIN g y ON x.gram = y.gram AND x.node < y.node
  AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
  GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT node AS a, node AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT r.a AS node, min(c.least) AS component_id FROM r JOIN c ON r.b = c.node GROUP BY r.a)
SELECT s.doc_id, len(s.grams) AS n_shingles, CASE WHEN len(s.grams) > 0 THEN m.component_id ELSE s.doc_id END AS component_id
FROM s LEFT JOIN c ON s.grams = c.grams LEFT JOIN m ON c.node = m.node
"""

OP12_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INT AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

# crc32 bit by bit: every byte is followed by seven zeros.
_STEP = "xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
OP13_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_LOWERED.format("text")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
d AS (SELECT id, run, count(*) AS n FROM t GROUP BY id, run),
b AS (
  SELECT run, n, list_reduce(list_prepend(4294967295, flatten(list_transform(flatten(list_transform(string_split(id || ':' || run, ''),
           lambda ch: CASE WHEN ord(ch) < 128 THEN [ord(ch)] ELSE [195, ord(ch) - 64] END)),
           lambda v: [v::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: {_STEP}) AS c
  FROM d),
h AS (SELECT run, n, xor(c, 4294967295) AS h, (xor(c, 4294967295) % length(run))::INT AS pos FROM b),
k AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, pos) || substr(run, pos + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM h GROUP BY 1),
w AS (SELECT word, n, length(word) AS size FROM k WHERE length(word) >= 5 AND n >= 3),
x AS (SELECT word, n, size, unnest(range(1, size + 1)) AS i FROM w),
y AS (SELECT word, n, size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM x),
near AS (
  SELECT p.word, q.word AS other, q.n FROM y p JOIN y q ON p.i = q.i AND p.rest = q.rest AND p.word <> q.word
  UNION SELECT y.word, w.word, w.n FROM y JOIN w ON y.rest = w.word
  UNION SELECT w.word, y.word, y.n FROM y JOIN w ON y.rest = w.word),
best AS (
  SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
f AS (
  SELECT w.word, w.n, coalesce(best.n_near, 0) AS n_near, CASE WHEN best.n >= 2 * w.n THEN best.other END AS form,
         CASE WHEN best.n >= 2 * w.n THEN best.n END AS form_n
  FROM w LEFT JOIN best USING (word)),
r AS (SELECT word, word AS last FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON r.last = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.last AS root, f.n, f.n_near, f.form_n
FROM f JOIN r USING (word) JOIN f AS e ON r.last = e.word WHERE e.form IS NULL
"""
