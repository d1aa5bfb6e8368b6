"""DuckDB SQL for queries of this subpackage: written on its own, with other means than the operators use."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all({_LOWER}, '{_TERM}')"
_BYTE = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
_IP = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
_CARD = r"[0-9]([ -]?[0-9])+"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"


def _matches(n: int, kind: str, pattern: str) -> str:
    return rf"""SELECT r, {n} AS k, '{kind}' AS kind, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gs FROM d"""


SQL = {
    "op3_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
f AS (SELECT s, min(doc_id) AS lo FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM w JOIN f USING (s) WHERE lo < doc_id),
n AS (SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM r),
k AS (SELECT p.doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
      FROM p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
    "op11_personal_data": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_matches(1, 'email', _EMAIL)} UNION ALL {_matches(2, 'ip', _IP)} UNION ALL {_matches(3, 'card', _CARD)} UNION ALL {_matches(4, 'phone', _PHONE)}),
u AS (SELECT r, k, kind, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM m),
p AS (SELECT r, k, kind, ms[i] AS v, CAST(list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a FROM u),
q AS (SELECT r, k, kind, v, a, a + length(v) AS b, regexp_replace(v, '[^0-9]', '', 'g') AS g FROM p),
s AS (SELECT r, k, kind, v, a, b, kind || ':' || translate(v, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS e FROM q
      WHERE k = 1 OR (k = 2 AND regexp_full_match(v, '{_BYTE}(\.{_BYTE}){{3}}')) OR (k = 4 AND length(g) BETWEEN 9 AND 15)
         OR (k = 3 AND length(g) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(g) + 1),
             lambda i: CASE WHEN i % 2 = 1 THEN CAST(g[-i] AS INT) ELSE 2 * CAST(g[-i] AS INT) - CASE WHEN CAST(g[-i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0)),
w AS (SELECT r, e, a, b, a - coalesce(max(b) OVER (PARTITION BY r ORDER BY a, b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS la,
             lead(a) OVER (PARTITION BY r ORDER BY a, b, e) - b AS ra FROM s),
n AS (SELECT r, e, a, b, text, greatest(0, least(80, a, la)) AS nl, greatest(0, least(80, length(text) - b, coalesce(ra, 80))) AS nr FROM w JOIN d USING (r)),
c AS (SELECT r, e, a, b, nl, nr, translate(substring(text, a - nl + 1, nl), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lt,
             translate(substring(text, b + 1, nr), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS rt FROM n),
h AS (SELECT r, e, CASE WHEN nl < 80 THEN lt ELSE regexp_replace(lt, '^{_TERM}', '') END AS x, a, b, true AS l FROM c
      UNION ALL SELECT r, e, CASE WHEN nr < 80 THEN rt ELSE regexp_replace(rt, '{_TERM}$', '') END, a, b, false FROM c),
hh AS (SELECT r, e, x, CASE WHEN l THEN a - length(x) ELSE b END AS o, regexp_extract_all(x, '{_TERM}') AS ts, string_split_regex(x, '{_TERM}') AS gs FROM h),
hu AS (SELECT r, e, o, ts, gs, unnest(range(1, len(ts) + 1)) AS i FROM hh),
t AS (SELECT r, e, ts[i] AS t, o + CAST(list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ts[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a FROM hu),
ct AS (SELECT * FROM t WHERE length(t) >= 3 AND regexp_matches(t, '[^0-9]')),
pc AS (SELECT e, t, count(DISTINCT r) AS dct FROM ct GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
dc AS (SELECT e, count(DISTINCT r) AS dc FROM s GROUP BY 1),
dt AS (SELECT t, count(DISTINCT r) AS dt FROM (SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS t FROM d) GROUP BY 1),
sh AS (SELECT e, t, ln(CAST((SELECT count(*) FROM d) AS DOUBLE) * dct / (CAST(dc AS DOUBLE) * dt)) / ln((SELECT count(*) FROM d) / dc) AS share
       FROM pc JOIN dc USING (e) JOIN dt USING (t) WHERE dc < (SELECT count(*) FROM d)),
mo AS (SELECT r, a, a + length(t) AS b, max(CASE WHEN share >= 0.9 THEN 'remove' ELSE 'generalise' END) AS kind FROM ct JOIN sh USING (e, t) WHERE share >= 0.75 GROUP BY 1, 2, 3),
al AS (SELECT r, k, kind || ':' || a || ':' || b AS x, kind, a, b FROM s UNION ALL SELECT r, CASE kind WHEN 'generalise' THEN 5 ELSE 6 END, kind || ':' || a || ':' || b, kind, a, b FROM mo),
ag AS (SELECT r, count(*) FILTER (WHERE k = 1) AS n1, count(*) FILTER (WHERE k = 2) AS n2, count(*) FILTER (WHERE k = 3) AS n3, count(*) FILTER (WHERE k = 4) AS n4,
              string_agg(x, ',' ORDER BY k, a, b) FILTER (WHERE k <= 4) AS base, string_agg(x, ',' ORDER BY k, a, b) AS spans FROM al GROUP BY 1)
SELECT doc_id, coalesce(n1, 0) AS n_email, coalesce(n2, 0) AS n_ip, coalesce(n3, 0) AS n_card, coalesce(n4, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN ag USING (r)""",
    "op12_lexical_scan": rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
c AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(ts)) AS BIGINT) AS l FROM d WHERE len(ts) > 0),
i AS (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark),
q AS (SELECT item_id, t, count(*) AS times FROM i GROUP BY 1, 2),
f AS (SELECT doc_id, len(ts) AS n, t, count(*) AS tf FROM (SELECT doc_id, ts, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY 1, 2, 3),
w AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY t, nd),
p AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * nd) // l)))) AS x FROM f JOIN w USING (t), c),
s AS (SELECT item_id, doc_id, CAST(sum(times * x) AS BIGINT) AS score FROM q JOIN p USING (t) GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10""",
    "op13_importance_resampling": rf"""
WITH k AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
b AS (SELECT {_TERMS} AS ts FROM benchmark),
wt AS (SELECT t, count(*) AS n FROM (SELECT unnest(ts) AS t FROM b) GROUP BY 1),
ws AS (SELECT t, count(*) AS n FROM (SELECT unnest(ts) AS t FROM d) GROUP BY 1),
v AS (SELECT t, hex(encode(t)) AS h FROM (SELECT t FROM wt UNION SELECT t FROM ws)),
vb AS (SELECT t, xor(list_reduce(list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
              lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM v, k),
s AS (SELECT bucket, sum(n) AS n FROM ws JOIN vb USING (t) GROUP BY 1),
g AS (SELECT bucket, coalesce(s.n, 0) AS s, coalesce(q.n, 0) AS t FROM (SELECT DISTINCT bucket FROM vb) LEFT JOIN s USING (bucket)
      LEFT JOIN (SELECT bucket, sum(n) AS n FROM wt JOIN vb USING (t) GROUP BY 1) q USING (bucket)),
ga AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * ((SELECT coalesce(sum(n), 0) FROM ws) + 10000) AS DOUBLE) / CAST((s + 1) * ((SELECT coalesce(sum(n), 0) FROM wt) + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM g),
we AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(ts) AS t FROM d) JOIN vb USING (t) JOIN ga USING (bucket) GROUP BY 1),
sc AS (SELECT doc_id, len(ts) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
       + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN we USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM sc WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank FROM sc LEFT JOIN r USING (doc_id)""",
}
