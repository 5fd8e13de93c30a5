"""The SQL of the queries that DuckDB can express, on the same tables."""

from __future__ import annotations

WORDS = r"length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g'))"

OP3 = r"""
WITH sizes AS (SELECT doc_id, source, """ + WORDS + r"""::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS k FROM per),
weighed AS (SELECT source, source_size, [5, 2, 1][(k % 3 + 1)::INT]::BIGINT AS w,
                   3 * source_size AS cap, sum(source_size) OVER () AS total FROM ranked),
ladder AS (SELECT *, row_number() OVER (ORDER BY cap / w, source IS NULL, source) AS r,
             coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
             sum(w) OVER (ORDER BY cap / w, source IS NULL, source
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS units FROM weighed),
lev AS (SELECT arg_min((total - full_)::DOUBLE / units::DOUBLE, r) AS level FROM ladder
        WHERE cap > w * ((total - full_)::DOUBLE / units::DOUBLE)),
targets AS (SELECT source, source_size, least(cap::DOUBLE, w * (SELECT level FROM lev)) AS target
            FROM weighed),
rated AS (SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
                 CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
          FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
drawn AS (SELECT r.*, d.k AS draw, least(floor(rate) + CASE WHEN
            ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), (8 * d.k + 1)::INT, 8))::BIGINT
            / 4294967296.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END, 3)::BIGINT AS copies
          FROM rated r, range(8) AS d(k)),
tried AS (SELECT source, draw, abs(sum(size * copies)::DOUBLE - any_value(target)) AS miss
          FROM drawn GROUP BY source, draw),
chosen AS (SELECT source, arg_min(draw, miss * 10 + draw * 1e-9) AS draw FROM tried GROUP BY source)
SELECT d.doc_id, d.size, d.source_size, d.target, d.size * d.copies AS taken, d.source, d.copies
FROM drawn d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.draw = c.draw
"""

_RATE = """1 / least(greatest(coalesce(sum(pow(bad - n * mu, 2) / n - mu * (1 - mu)), 0)
 / nullif(sum(mu * (1 - mu) * (n - 1)), 0), 1e-4), 0.999) - 1"""

OP8 = r"""
WITH p AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
known AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels
          WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
  array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
  array_to_string(list_slice(string_split(host, '.'), -1, -1), '.') AS suffix
  FROM p LEFT JOIN known ON page_id = doc_id GROUP BY host),
g AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) AS mu FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(mu) AS mu FROM hosts, g GROUP BY suffix),
sm AS (SELECT """ + _RATE + r""" AS m FROM s0 WHERE n > 0),
s AS (SELECT suffix, (bad + m * mu) / (n + m) AS mu FROM s0, sm),
d0 AS (SELECT domain, sum(n) AS n, sum(bad) AS bad, any_value(s.mu) AS mu
       FROM hosts JOIN s USING (suffix) GROUP BY domain),
dm AS (SELECT """ + _RATE + r""" AS m FROM d0 WHERE n > 0),
d AS (SELECT domain, (bad + m * mu) / (n + m) AS mu FROM d0, dm),
h0 AS (SELECT hosts.*, d.mu FROM hosts JOIN d USING (domain)),
hm AS (SELECT """ + _RATE + r""" AS m FROM h0 WHERE n > 0),
h1 AS (SELECT host, bad + m * mu AS a, n - bad + m * (1 - mu) AS b FROM h0, hm),
h AS (SELECT host, a / (a + b) AS mean,
  greatest(a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0) AS bound FROM h1),
rules(verdict, rule) AS (VALUES ('block', 'net/'), ('allow', 'example.net/en/'),
                                ('block', 'example.com/de/'), ('allow', 'org/fr/')),
hits AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p, rules
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, position('/' IN rule))) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, hits.rule,
  coalesce(hits.verdict, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  round(mean, 6) AS mean, round(bound, 6) AS bound
FROM p JOIN h USING (host) LEFT JOIN hits ON p.page_id = hits.page_id
"""

OP10 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# The CRC-32 of decimal digits, bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split(conv::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
 lambda crc, d: list_reduce(range(8), lambda a, k: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, d)),
 4294967295::BIGINT), 4294967295::BIGINT)"""

OP11 = f"""
WITH said AS (SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
              FROM conversations WHERE conv_id IS NOT NULL),
hashed AS (SELECT *, sha256(strlen(role)::VARCHAR || ':' || role || text) AS t FROM said),
turns AS MATERIALIZED (SELECT conv, t, strlen(text) AS n_bytes,
  row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, t) - 1 AS idx FROM hashed),
sizes AS (SELECT conv, count(*) AS size FROM turns GROUP BY conv),
plan AS MATERIALIZED (SELECT s.conv, s.conv - s.conv % 5 AS base, h, least(h, coalesce(b.size, 0)) AS taken
  FROM (SELECT *, {_CRC} % 9 AS h FROM sizes) s LEFT JOIN sizes b ON b.conv = s.conv - s.conv % 5),
built AS MATERIALIZED (
  SELECT conv, idx - h + taken AS idx, t, n_bytes FROM turns JOIN plan USING (conv) WHERE idx >= h
  UNION ALL SELECT p.conv, idx, t, n_bytes FROM turns JOIN plan p ON turns.conv = p.base WHERE idx < h),
paths AS (SELECT conv, idx + 1 AS depth, n_bytes,
  string_agg(t, ' ') OVER (PARTITION BY conv ORDER BY idx) AS path FROM built
  UNION ALL SELECT conv, 0, 0, '' FROM plan),
steps AS MATERIALIZED (SELECT *, coalesce(lag(path) OVER (PARTITION BY conv ORDER BY depth), '-') AS above,
  depth = max(depth) OVER (PARTITION BY conv) AS ends FROM paths),
nodes AS MATERIALIZED (SELECT path, depth, any_value(above) AS above, min(conv) AS conv_id,
  count(*) AS n_convs, max(n_bytes) AS n_bytes,
  sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY path, depth),
kids AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
own AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (path)),
-- A node's smallest member passes all nodes above it.
totals AS (SELECT s.path, count(*) FILTER (o.n_children = 0) AS n_leaves,
  sum((o.n_convs - 1) * o.n_bytes)::BIGINT AS saved_tokens
  FROM own o JOIN steps s ON s.conv = o.conv_id AND s.depth <= o.depth GROUP BY s.path)
SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves,
       saved_tokens, o.ends_sha256
FROM own o JOIN totals USING (path) LEFT JOIN own p ON p.path = o.above
"""

# Byte triplets of whole texts, counted in 1,024 buckets; two bits a bucket.
OP12 = """
WITH d AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC) AS r, count(*) OVER () AS n
           FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
e AS MATERIALIZED (SELECT d.doc_id, d.t, d.r, o.r AS next_r, length(d.t) AS n_chars,
  left(d.t, length(d.t) - length(d.t) // 3) || left(o.t, length(d.t) // 3) AS edited
  FROM d JOIN d o ON o.r = d.r % d.n + 1),
texts AS (SELECT r, 0 AS kind, t FROM e UNION ALL SELECT r, 1, edited FROM e),
hexed AS (SELECT r, kind, strlen(t) AS n, regexp_extract_all(
  hex(encode(t)) || repeat('00', CASE WHEN strlen(t) IN (1, 2) THEN 3 - strlen(t)::INT ELSE 0 END), '..') AS b
  FROM texts),
triples AS (SELECT r, kind, b, unnest(range(1, len(b) - 1)) AS k FROM hexed WHERE n > 0),
packed AS (SELECT r, kind, ('0x' || b[k + 2] || b[k + 1] || b[k])::UBIGINT AS x FROM triples),
m1 AS (SELECT r, kind, (x * 2654435761) % 4294967296 AS x FROM packed),
m2 AS (SELECT r, kind, (xor(x, x >> 15)::HUGEINT * 2246822519 % 4294967296)::UBIGINT AS x FROM m1),
counts AS (SELECT r, kind, xor(x, x >> 13) & 1023 AS bucket, count(*) AS c FROM m2 GROUP BY ALL),
grid AS (SELECT h.r, h.kind, h.n, k.bucket, coalesce(c, 0) AS c
  FROM (SELECT r, kind, n FROM hexed) h CROSS JOIN (SELECT unnest(range(1024))::UBIGINT AS bucket) k
  LEFT JOIN counts USING (r, kind, bucket)),
q AS (SELECT r, kind, n, list(c ORDER BY bucket) AS c, list_sort(list(c)) AS s FROM grid GROUP BY ALL),
codes AS MATERIALIZED (SELECT r, kind, floor(4 * log2(n + 1))::BIGINT AS len, list_transform(c, lambda x:
  (x > s[257])::INT + (x > s[513])::INT + (x > s[769])::INT) AS code FROM q),
prints AS MATERIALIZED (SELECT r, kind, len, code, printf('%02x', len) || array_to_string(list_transform(range(256),
  lambda k: printf('%02x', code[4 * k + 1] * 64 + code[4 * k + 2] * 16 + code[4 * k + 3] * 4 + code[4 * k + 4])), '') AS p
  FROM codes)
SELECT e.doc_id, e.n_chars, sha256(edited) AS edited_sha256, a.p AS fingerprint, b.p AS edited_fingerprint,
  greatest(0, 1 - (2 * abs(a.len - b.len)
    + list_sum(list_transform(range(1, 1025), lambda k: abs(a.code[k] - b.code[k])))) / 1280) AS near_edited,
  greatest(0, 1 - (2 * abs(a.len - o.len)
    + list_sum(list_transform(range(1, 1025), lambda k: abs(a.code[k] - o.code[k])))) / 1280) AS near_next
FROM e JOIN prints a ON a.r = e.r AND a.kind = 0 JOIN prints b ON b.r = e.r AND b.kind = 1
JOIN prints o ON o.r = e.next_r AND o.kind = 0
"""


def op13() -> str:
    """Six rounds over eight part positions of sixteen entries, written out."""
    steps = ["""v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding::DOUBLE[],
         lambda x: floor(x * 4096)::BIGINT) AS w FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND embedding IS NOT NULL),
parts AS MATERIALIZED (SELECT row, p, w[8 * p + 1:8 * p + 8] AS w FROM v, range(8) AS g(p)),
first AS (SELECT row, row_number() OVER (ORDER BY vec_id, w) - 1 AS e FROM v),
b0 AS MATERIALIZED (SELECT p, e, w FROM parts JOIN first USING (row) WHERE e < 16)"""]
    far = "list_sum(list_transform(range(1, 9), lambda k: (a.w[k] - b.w[k]) * (a.w[k] - b.w[k])))"
    for r in range(7):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT row, p, e, d FROM (SELECT a.row, a.p, b.e, {far} AS d,
    row_number() OVER (PARTITION BY a.row, a.p ORDER BY {far}, b.e) AS place
    FROM parts a JOIN b{r} b ON a.p = b.p) WHERE place = 1)""")
        if r < 6:
            means = ", ".join(f"floor(sum(w[{k}]) / count(*))::BIGINT" for k in range(1, 9))
            steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.w, b.w) AS w FROM b{r} b LEFT JOIN (
    SELECT p, e, [{means}] AS w FROM a{r} JOIN parts USING (row, p) GROUP BY p, e) m USING (p, e))""")
    return f"""WITH {", ".join(steps)},
coded AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
          FROM a6 GROUP BY row),
books AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN coded USING (row), books"""


def oracles() -> dict[str, str]:
    return {"op3_mixing": OP3, "op8_url_filters": OP8, "op10_exact_dedup": OP10,
            "op11_conversation_trie": OP11, "op12_fingerprints": OP12,
            "op13_vector_codes": op13()}
