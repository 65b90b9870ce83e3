"""SQL twins of the search, URL and conversation queries."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

IMPACT_SEARCH = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
tot AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS length FROM n),
i AS (SELECT item_id, row_number() OVER () AS i, {_TERMS} AS t FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT DISTINCT i, item_id, term FROM (SELECT i, item_id, unnest(t) AS term FROM i)),
tf AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * (SELECT n_docs FROM tot) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf GROUP BY term),
m AS (SELECT r, doc_id, 50 + (50 * n * (SELECT n_docs FROM tot)) // (SELECT length FROM tot) AS m FROM n),
s AS (
  SELECT q.i, q.item_id, tf.r, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * m.m))) AS BIGINT) AS score
  FROM q JOIN tf ON q.term = tf.term JOIN w ON q.term = w.term JOIN m ON tf.r = m.r GROUP BY q.i, q.item_id, tf.r),
k AS (
  SELECT s.item_id, m.doc_id, s.score,
         row_number() OVER (PARTITION BY s.i ORDER BY s.score DESC, m.doc_id ASC NULLS LAST) AS k
  FROM s JOIN m ON s.r = m.r WHERE s.score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM k WHERE k <= 50"""

# Prior strengths by level: the correlation of a beta-binomial from its moments.
_RHO = """
SELECT CASE WHEN coalesce(sum(b), 0) <= 1e-9 THEN 1 / 11.0e0
       ELSE least(greatest(sum(a) / sum(b), 1 / 1001.0e0), 1 / 3.0e0) END AS rho
FROM (SELECT (k2 - k * k / t) / (k / t * (1 - k / t)) - (g - 1) AS a, t - n2 / t - (g - 1) AS b
      FROM (SELECT CAST(sum(n) AS DOUBLE) AS t, CAST(sum(good) AS DOUBLE) AS k, count(*) AS g,
                   sum(CAST(n AS DOUBLE) * n) AS n2, sum(CAST(good AS DOUBLE) * good / n) AS k2
            FROM {0} WHERE n > 0 {1}) WHERE k > 0 AND k < t)"""

HOST_REPUTATION = rf"""
WITH u AS (
  SELECT page_id, coalesce({_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
o AS (
  SELECT doc_id, 1 - max(greatest(CASE WHEN quality = 0 THEN 1 WHEN quality IS NOT NULL THEN 0 END,
                                  CASE WHEN toxic = 1 THEN 1 WHEN toxic IS NOT NULL THEN 0 END)) AS good
  FROM labels GROUP BY doc_id),
c AS (
  SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good,
         regexp_extract(host, '(?s)^(?:.*@)?(.*?)\.?(?::[0-9]*)?$', 1) AS bare
  FROM u LEFT JOIN o ON u.page_id = o.doc_id GROUP BY host),
h AS (
  SELECT host, n, good,
         CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\[') THEN bare
              WHEN regexp_extract(bare, '([^.]*\.)?[^.]*$') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br')
              THEN regexp_extract(bare, '([^.]*\.)?([^.]*\.)?[^.]*$')
              ELSE regexp_extract(bare, '([^.]*\.)?[^.]*$') END AS domain,
         CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\[') THEN ''
              WHEN regexp_extract(bare, '([^.]*\.)?[^.]*$') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br')
              THEN regexp_extract(bare, '([^.]*\.)?[^.]*$') ELSE regexp_extract(bare, '[^.]*$') END AS suffix
  FROM c),
d AS (SELECT suffix, domain, sum(n) AS n, sum(good) AS good FROM h GROUP BY suffix, domain),
s AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM d GROUP BY suffix),
rh AS ({_RHO.format('h', 'GROUP BY suffix, domain')}),
rd AS ({_RHO.format('d', 'GROUP BY suffix')}),
rs AS ({_RHO.format('s', '')}),
ms AS (
  SELECT suffix, (good + (1 - rho) / rho * (SELECT (sum(good) + 1) / (sum(n) + 2) FROM s)) / (n + (1 - rho) / rho) AS m
  FROM s, rs),
md AS (
  SELECT d.suffix, d.domain, (good + (1 - rho) / rho * ms.m) / (n + (1 - rho) / rho) AS m
  FROM d JOIN ms ON d.suffix = ms.suffix, rd),
ab AS (
  SELECT host, good + (1 - rho) / rho * md.m AS a, n - good + (1 - rho) / rho * (1 - md.m) AS b
  FROM h JOIN md ON h.suffix = md.suffix AND h.domain = md.domain, rh),
v AS (
  SELECT host, a / (a + b) + 1.645e0 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS upper FROM ab)
SELECT page_id, u.host, path,
       CASE WHEN (u.host = 'example.net' OR u.host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN (u.host = 'example.com' OR u.host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN (u.host = 'org' OR u.host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN (u.host = 'net' OR u.host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
       CASE WHEN (u.host = 'example.net' OR u.host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'allow'
            WHEN (u.host = 'example.com' OR u.host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'block'
            WHEN (u.host = 'org' OR u.host LIKE '%.org') AND path LIKE '/fr/%' THEN 'allow'
            WHEN (u.host = 'net' OR u.host LIKE '%.net') AND path LIKE '/%' THEN 'block'
            WHEN upper < 0.5e0 THEN 'block' ELSE 'allow' END AS verdict
FROM u JOIN v ON u.host = v.host"""

# States of the pattern as four strings: nine digits of cost, then the audit, so that least() finds the cheapest and,
# of equals, the smallest; null for a state that cannot be reached.  x0..x3 after inserts, s0..s3 after a row.
def _add(x: str, cost: str, letter: str) -> str:
    return (f"lpad(CAST(CAST(substr({x}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({x}, 10) "
            f"|| '{letter}'")


_INSERT = f"""
  SELECT *, least(a2, {_add('a3', '2', 'I')}) AS x2 FROM (
    SELECT *, a0 AS x0, a1 AS x1, least(a3, {_add('a2', '2', 'I')}) AS x3 FROM (
      SELECT *, s0 AS a0, s1 AS a1, s3 AS a3,
             least(s2, {_add('s0', '2', 'I')}, {_add('s1', '2', 'I')}, {_add('s3', '2', 'I')}) AS a2 FROM {{0}}))"""

TURN_REPAIR = rf"""
WITH RECURSIVE
tab AS (
  SELECT CAST(i AS BIGINT) AS i, 0 AS bit, CAST(i AS BIGINT) AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, bit + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END
  FROM tab WHERE bit < 8),
crc AS (SELECT i, c FROM tab WHERE bit = 8),
given AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
sums AS (
  SELECT DISTINCT k, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM given
  UNION ALL
  SELECT s.k, s.i + 1, xor(s.c >> 8, t.c)
  FROM sums s JOIN crc t ON t.i = xor(s.c & 255, CAST(ascii(substr(s.k, s.i + 1, 1)) AS BIGINT))
  WHERE s.i < length(s.k)),
fault AS (SELECT k, xor(c, CAST(4294967295 AS BIGINT)) % 20 AS fault FROM sums WHERE i = length(k)),
damaged AS (
  SELECT r, conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM given JOIN fault ON given.k = fault.k, (SELECT 0 AS copy UNION ALL SELECT 1) c
  WHERE fault <> 0 AND (copy = 0 OR fault = 3)),
ordered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS BIGINT) AS n
  FROM damaged),
seen AS (
  SELECT conv_id, n, turn, role, text, substr(role, 1, 1) AS initial,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS copy FROM ordered),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN copy > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault FROM seen),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         max(n) AS rows FROM faulty GROUP BY conv_id),
states AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2,
         CAST(NULL AS VARCHAR) AS s3 FROM counts
  UNION ALL
  SELECT conv_id, n + 1, {_add('x0', '3', 'D')},
         least({_add('x1', '3', 'D')}, CASE WHEN fault IN (0, 3) AND initial = 's' THEN {_add('x0', 'extra', 'K')} END),
         least({_add('x2', '3', 'D')},
               CASE WHEN fault IN (0, 3) AND initial = 'u' THEN {_add('x0', 'extra', 'K')} END,
               CASE WHEN fault IN (0, 3) AND initial = 'u' THEN {_add('x1', 'extra', 'K')} END,
               CASE WHEN fault IN (0, 3) AND initial = 'u' THEN {_add('x3', 'extra', 'K')} END,
               CASE WHEN fault IN (0, 3) THEN {_add('x0', '2 + extra', 'R')} END,
               CASE WHEN fault IN (0, 3) THEN {_add('x1', '2 + extra', 'R')} END,
               CASE WHEN fault IN (0, 3) THEN {_add('x3', '2 + extra', 'R')} END),
         least({_add('x3', '3', 'D')},
               CASE WHEN fault IN (0, 3) AND initial = 'a' THEN {_add('x2', 'extra', 'K')} END,
               CASE WHEN fault IN (0, 3) THEN {_add('x2', '2 + extra', 'R')} END)
  FROM ({_INSERT.format('''(SELECT states.*, f.fault, f.initial, CASE WHEN f.fault = 3 THEN 1 ELSE 0 END AS extra
        FROM states JOIN faulty f ON states.conv_id IS NOT DISTINCT FROM f.conv_id AND f.n = states.n + 1)''')})),
best AS (
  SELECT conv_id, least(x0, x3) AS x
  FROM ({_INSERT.format('''(SELECT states.* FROM states JOIN counts c
        ON states.conv_id IS NOT DISTINCT FROM c.conv_id AND states.n = c.rows)''')})),
edits AS (
  SELECT conv_id, j, substr(x, CAST(9 + j AS BIGINT), 1) AS edit
  FROM (SELECT conv_id, x, unnest(generate_series(1, length(x) - 9)) AS j FROM best)),
placed AS (
  SELECT *, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER w AS n, sum(CASE WHEN edit = 'D' THEN 0 ELSE 1 END) OVER w AS o
  FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY j ROWS UNBOUNDED PRECEDING)),
kept AS (
  SELECT p.conv_id, p.j, p.o, p.edit, f.role, f.text FROM placed p
  LEFT JOIN faulty f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.n = f.n AND p.edit <> 'I' WHERE p.edit <> 'D'),
shape AS (
  SELECT conv_id, max(CASE WHEN o = 1 AND edit = 'K' AND substr(role, 1, 1) = 's' THEN 1 ELSE 0 END) AS system
  FROM kept GROUP BY conv_id),
turns AS (
  SELECT k.conv_id, string_agg(
           CASE WHEN edit = 'K' THEN role WHEN (o - s.system) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS whole
  FROM kept k JOIN shape s ON k.conv_id IS NOT DISTINCT FROM s.conv_id GROUP BY k.conv_id)
SELECT i.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
       coalesce(CAST(substr(b.x, 1, 9) AS BIGINT), 0) AS cost, coalesce(substr(b.x, 10), '') AS audit,
       sha256(coalesce(t.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON i.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON i.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN turns t ON i.conv_id IS NOT DISTINCT FROM t.conv_id"""


# The water level: capped sources are those whose limit per weight is smallest; the level that lies between the last
# capped and the first free source of that order is the answer.  Then three rounds of going through buckets in order,
# each taken if it fits; a round splits the bucket with the most documents that the one before left over.
def _round(level: int, docs: str, room: str) -> str:
    return f"""
h{level} AS (
  SELECT source, b{level} AS bucket, CAST(sum(size) AS BIGINT) AS mass, count(*) AS n FROM {docs} GROUP BY source, b{level}),
g{level} AS (
  SELECT source, bucket, mass, n, CAST(row_number() OVER (PARTITION BY source ORDER BY CASE WHEN large THEN -mass ELSE 0 END, bucket) AS BIGINT) AS k
  FROM (SELECT *, mass * count(*) OVER (PARTITION BY source) > 8 * sum(mass) OVER (PARTITION BY source) AS large FROM h{level})),
r{level} AS (
  SELECT source, CAST(0 AS BIGINT) AS k, CAST(-1 AS INTEGER) AS bucket, CAST(0 AS BIGINT) AS n,
         CAST({room} AS DOUBLE) AS room, false AS taken FROM {'plan' if not level else f'e{level - 1}'}
  UNION ALL
  SELECT g.source, g.k, g.bucket, g.n, CASE WHEN g.mass <= r.room THEN r.room - g.mass ELSE r.room END,
         g.mass <= r.room
  FROM r{level} r JOIN g{level} g ON g.source IS NOT DISTINCT FROM r.source AND g.k = r.k + 1),
e{level} AS (
  SELECT source, min(room) AS room,
         arg_min(bucket, row(-n, bucket)) FILTER (bucket >= 0 AND NOT taken) AS pick FROM r{level} GROUP BY source)"""


_DOCS_OF = """
d{1} AS (SELECT d.* FROM {0} d JOIN e{2} e ON d.source IS NOT DISTINCT FROM e.source AND d.b{2} = e.pick)"""

SOURCE_MIX = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || substr(h, 1, 3)) AS INTEGER) AS b0, CAST(('0x' || substr(h, 4, 3)) AS INTEGER) AS b1,
         CAST(('0x' || substr(h, 7, 3)) AS INTEGER) AS b2
  FROM (SELECT *, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents)),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3.0e0 * sum(size) AS lim,
         [5.0e0, 2.0e0, 1.0e0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM docs GROUP BY source),
ord AS (
  SELECT *, sum(lim) OVER w AS capped, sum(weight) OVER () - sum(weight) OVER w AS rest,
         sum(source_size) OVER () AS total,
         lead(lim / weight) OVER (ORDER BY lim / weight, source NULLS LAST) AS next_ratio
  FROM src WINDOW w AS (ORDER BY lim / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
lvl AS (
  SELECT min(level) AS level FROM (
    SELECT (total - capped) / rest AS level, lim / weight AS ratio, next_ratio FROM ord WHERE rest > 1e-9
    UNION ALL SELECT total / (SELECT sum(weight) FROM src), 0, (SELECT min(lim / weight) FROM src)
    FROM (SELECT max(total) AS total FROM ord)) WHERE level BETWEEN ratio - 1e-9 AND next_ratio + 1e-9),
tgt AS (
  SELECT source, source_size, least(coalesce((SELECT level FROM lvl), 1e300) * weight, lim) AS target FROM src),
plan AS (
  SELECT *, CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS BIGINT) AS whole FROM tgt),
{_round(0, 'docs', 'target - whole * source_size')},{_DOCS_OF.format('docs', 1, 0)},{_round(1, 'd1', 'room')},
{_DOCS_OF.format('d1', 2, 1)},{_round(2, 'd2', 'room')},
more AS (
  SELECT d.doc_id, d.source, d.b0, d.b1, d.b2 FROM docs d JOIN r0 ON r0.taken AND d.source IS NOT DISTINCT FROM r0.source AND d.b0 = r0.bucket
  UNION
  SELECT d.doc_id, d.source, d.b0, d.b1, d.b2 FROM d1 d JOIN r1 ON r1.taken AND d.source IS NOT DISTINCT FROM r1.source AND d.b1 = r1.bucket
  UNION
  SELECT d.doc_id, d.source, d.b0, d.b1, d.b2 FROM d2 d JOIN r2 ON r2.taken AND d.source IS NOT DISTINCT FROM r2.source AND d.b2 = r2.bucket)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(d.size * (p.whole + CASE WHEN m.b0 IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN more m ON d.doc_id IS NOT DISTINCT FROM m.doc_id AND d.source IS NOT DISTINCT FROM m.source"""
