"""DuckDB texts for the operators whose answer SQL can state."""

from __future__ import annotations

import string

_LOW = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

NGRAM_JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' ')))
                                    WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM g),
s AS (SELECT doc_id, unnest(g) AS g FROM g),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION
  SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n"""

# base 32 of a hexadecimal text: each five of its digits are four of the other's
_BASE32 = "list_transform(range(0, 8), lambda k: CAST('0x' || substr(h, CAST(5 * k + 1 AS INTEGER), 5) AS INTEGER))"
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> {}) & 31 AS INTEGER) + 1, 1)"

WARC_INDEX = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
c AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS low FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform({_BASE32}, lambda v: {' || '.join(_DIGIT.format(b) for b in (15, 10, 5, 0))}), '') AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to
FROM c"""

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, {_WORDS}) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOW}, {_WORDS}) AS w FROM benchmark),
x AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k:k + 9], ' ') AS win
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(k) WHERE len(w) > 0),
z AS (SELECT DISTINCT size FROM x),
o AS (
  SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS win
  FROM d, z, unnest(range(1, len(w) - size + 2)) t(k)),
m AS (SELECT o.doc_id, o.k, o.size, x.item_id FROM o JOIN x ON o.win = x.win AND o.size = x.size),
n AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM m GROUP BY doc_id),
h AS (
  SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM m, unnest(range(0, size)) t(j) GROUP BY doc_id),
xi AS (
  SELECT DISTINCT item_id, w[k:k + 9] AS p FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(k) WHERE len(w) > 0),
y AS (SELECT p, j - 1 AS place, p[j] AS term FROM (SELECT DISTINCT p FROM xi), unnest(range(1, len(p) + 1)) t(j)),
post AS (SELECT doc_id, k - 1 AS pos, w[k] AS term FROM d, unnest(range(1, len(w) + 1)) t(k)),
f AS (SELECT term, count(*) AS f FROM post GROUP BY term),
rare AS (
  SELECT p, place, y.term, row_number() OVER (PARTITION BY p ORDER BY f, place) AS r, count(*) OVER (PARTITION BY p) AS size, count(f) OVER (PARTITION BY p) AS known
  FROM y LEFT JOIN f ON y.term = f.term),
two AS (
  SELECT p, max(place) FILTER (r = 1) AS place1, max(term) FILTER (r = 1) AS term1,
         max(place) FILTER (r = least(size, 2)) AS place2, max(term) FILTER (r = least(size, 2)) AS term2
  FROM rare WHERE known = size GROUP BY p),
want AS (SELECT p, doc_id, pos - place1 AS b, term2, pos - place1 + place2 AS want FROM two JOIN post ON term = term1 AND pos >= place1),
off AS (
  SELECT p, want.doc_id, b, arg_min(pos - want, 2 * abs(pos - want) + CASE WHEN pos > want THEN 1 ELSE 0 END) AS off
  FROM want JOIN post ON post.doc_id = want.doc_id AND term = term2 AND abs(pos - want) <= 3 GROUP BY ALL),
near AS (
  SELECT doc_id, count(DISTINCT item) AS n_near, string_agg(item || ':' || b || ':' || off, ',' ORDER BY item, b, off) AS near
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item, b, off FROM off JOIN xi ON xi.p = off.p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated,
       coalesce(near.n_near, 0) AS n_near, sha256(coalesce(near.near, '')) AS near_sha256
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN near ON near.doc_id = d.doc_id LEFT JOIN h ON h.doc_id = d.doc_id"""

_RATIOS = (
    ("word_length", "10000 * word_chars // greatest(n_words, 1)", 2500), ("symbols", "10000 * n_symbols // greatest(n_words, 1)", 250),
    ("repeated_lines", "10000 * n_dup_lines // greatest(n_lines, 1)", 1000), ("repeated_words", "10000 * n_repeat_words // greatest(n_words, 1)", 600),
)
_QUARTILES = """
SELECT {by}, ratio, min(e) FILTER (4 * upto >= n) AS q1, min(e) FILTER (4 * upto >= 3 * n) AS q3
FROM (SELECT {by}, ratio, e, sum(c) OVER (PARTITION BY {by}, ratio ORDER BY e) AS upto, sum(c) OVER (PARTITION BY {by}, ratio) AS n
      FROM (SELECT {by}, ratio, e, count(*) AS c FROM v WHERE NOT base_failed GROUP BY ALL))
WHERE n >= 50 GROUP BY {by}, ratio"""

QUANTILE_RULES = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 4], chr(10)) AS g FROM t, unnest(range(1, len(w) - 3)) u(i)),
m AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
x AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM m, unnest(range(0, 5)) u(j) GROUP BY r),
l AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda z: regexp_matches(z, '[^\x20\x09-\x0D]')) AS z FROM t),
s AS (
  SELECT t.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(z) AS n_lines,
         CAST(len(z) - len(list_distinct(z)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t JOIN l ON l.r = t.r LEFT JOIN x ON x.r = t.r),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, length(bin(n_words)) // 2 AS band FROM s),
y AS (
  {" UNION ALL ".join(f"SELECT r, lang, source, band, base_failed, '{n}' AS ratio, {x} AS value, {k} AS least FROM b" for n, x, k in _RATIOS)}),
v AS (SELECT *, (value >> greatest(length(bin(value)) - 7, 0)) << greatest(length(bin(value)) - 7, 0) AS e FROM y),
q1 AS ({_QUARTILES.format(by="lang, source, band")}),
q2 AS ({_QUARTILES.format(by="lang, band")}),
q3 AS ({_QUARTILES.format(by="band")}),
q AS (
  SELECT v.*, coalesce(q1.q1, q2.q1, q3.q1) AS lo, coalesce(q1.q3, q2.q3, q3.q3) AS hi
  FROM v LEFT JOIN q1 ON v.lang IS NOT DISTINCT FROM q1.lang AND v.source IS NOT DISTINCT FROM q1.source AND v.band = q1.band AND v.ratio = q1.ratio
  LEFT JOIN q2 ON v.lang IS NOT DISTINCT FROM q2.lang AND v.band = q2.band AND v.ratio = q2.ratio
  LEFT JOIN q3 ON v.band = q3.band AND v.ratio = q3.ratio),
o AS (
  SELECT r, bool_or(coalesce(value > hi + 3 * greatest(hi - lo, least), false)
                    OR ratio = 'word_length' AND coalesce(value < lo - 3 * greatest(hi - lo, least), false)) AS bad
  FROM q GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept
FROM b JOIN o ON o.r = b.r"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_CRC32 = (
    "xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), "
    "lambda a, b: list_reduce(range(0, 8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295), 4294967295)"
)
# a tree's nodes, level by level; {0} are its leaves (g, p, d, n)
_LEVELS = """
  SELECT g, 0 AS level, p, d, n FROM {0}
  UNION ALL
  SELECT g, level + 1, p // 8, sha256(string_agg(d, '' ORDER BY p)), (any_value(n) + 7) // 8 FROM {1} WHERE n > 1 GROUP BY g, level, p // 8"""
# siblings of the ancestors of each leaf
_SIDES = """
  SELECT l.g, l.p, v.level, string_agg(v.d, '' ORDER BY v.p) FILTER (v.p < (l.p >> (3 * v.level))) AS a,
         string_agg(v.d, '' ORDER BY v.p) FILTER (v.p > (l.p >> (3 * v.level))) AS b
  FROM {0} l JOIN {1} v ON l.g IS NOT DISTINCT FROM v.g AND v.n > 1 AND v.p >> 3 = l.p >> (3 * (v.level + 1)) GROUP BY ALL"""

MERKLE_VERSIONS = f"""
WITH RECURSIVE z AS (
  SELECT doc_id, lang AS g, {_LEAF.format("text")} AS d,
         CASE WHEN {_CRC32} % 3 = 0 THEN {_LEAF.format(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")}
              ELSE {_LEAF.format("text")} END AS t
  FROM documents),
x AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM z),
v AS ({_LEVELS.format("x", "v")}),
s AS (SELECT g, d, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM v WHERE n = 1),
y AS (SELECT 'all' AS g, p, d, n FROM s),
u AS ({_LEVELS.format("y", "u")}),
w AS ({_SIDES.format("x", "v")}),
k AS ({_SIDES.format("y", "u")}),
m AS (
  SELECT x.g, x.p, w.level, coalesce(a, '') AS a, coalesce(b, '') AS b FROM x JOIN w ON x.g IS NOT DISTINCT FROM w.g AND x.p = w.p
  UNION ALL
  SELECT x.g, x.p, 100 + k.level, coalesce(a, ''), coalesce(b, '') FROM x JOIN s ON x.g IS NOT DISTINCT FROM s.g JOIN k ON k.p = s.p),
r AS (SELECT *, row_number() OVER (PARTITION BY g, p ORDER BY level) AS step FROM m),
f AS (
  SELECT g, p, CAST(1 AS BIGINT) AS step, t AS d FROM x
  UNION ALL
  SELECT f.g, f.p, f.step + 1, sha256(r.a || f.d || r.b) FROM f JOIN r ON f.g IS NOT DISTINCT FROM r.g AND f.p = r.p AND f.step = r.step),
e AS (SELECT g, p, max_by(d, step) AS folded FROM f GROUP BY g, p),
o AS (SELECT g, p, string_agg(a || b, '' ORDER BY step) AS proof FROM r GROUP BY g, p)
SELECT x.doc_id, x.d AS leaf, s.d AS subroot, (SELECT d FROM u WHERE n = 1) AS root, sha256(coalesce(o.proof, '')) AS proof_sha256,
       e.folded AS folded_root, e.folded = (SELECT d FROM u WHERE n = 1) AS verified
FROM x JOIN s ON x.g IS NOT DISTINCT FROM s.g
JOIN e ON x.g IS NOT DISTINCT FROM e.g AND x.p = e.p LEFT JOIN o ON x.g IS NOT DISTINCT FROM o.g AND x.p = o.p"""
