"""SQL counterparts of the text queries, where SQL can express them."""

from __future__ import annotations

from taperline.llm.licenses import NARROWER, PHRASES, TEMPLATES

OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, encode(coalesce(html, '')) AS payload,
    sha1(encode(coalesce(html, ''))) AS h
  FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS response FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda k: (
    array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(1 + ((CAST(concat('0x', substr(h, CAST(1 + 5 * k AS INT), 5)) AS BIGINT) >> s) & 31) AS INT), 1)), ''))), '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM w
"""

OP4 = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
u AS (SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM t),
tri AS (SELECT doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g
  FROM (SELECT doc_id, w, unnest(range(1, n_words - 1)) AS i FROM u WHERE n_words >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
v AS (SELECT u.*, coalesce(rep.n, 0) AS n_repeat_words FROM u LEFT JOIN rep USING (doc_id)),
c AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbol_rate,
    CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_line_rate,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat_rate,
    CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length FROM v),
r AS (UNPIVOT (SELECT lang, source, CAST(symbol_rate AS BIGINT) AS symbol_rate, CAST(dup_line_rate AS BIGINT) AS dup_line_rate,
    CAST(repeat_rate AS BIGINT) AS repeat_rate, CAST(word_length AS BIGINT) AS word_length FROM c WHERE NOT base_failed)
  ON symbol_rate, dup_line_rate, repeat_rate, word_length INTO NAME rate VALUE x),
b AS (SELECT lang, source, rate, x - x % CAST(pow(2, greatest(length(bin(x)) - 6, 0)) AS BIGINT) AS pos FROM r),
ranked AS (
  SELECT 0 AS level, lang, source, rate, pos FROM b UNION ALL
  SELECT 1, lang, NULL, rate, pos FROM b UNION ALL
  SELECT 2, NULL, NULL, rate, pos FROM b),
o AS (SELECT *, row_number() OVER (PARTITION BY level, lang, source, rate ORDER BY pos) - 1 AS k,
    count(*) OVER (PARTITION BY level, lang, source, rate) AS n FROM ranked),
q AS (SELECT level, lang, source, rate, any_value(n) AS n, max(CASE WHEN k = (n - 1) * 25 // 100 THEN pos END) AS q1,
    max(CASE WHEN k = (n - 1) * 75 // 100 THEN pos END) AS q3 FROM o GROUP BY ALL),
f AS (SELECT *, q1 - 3 * greatest(q3 - q1, least_spread) AS low, q3 + 3 * greatest(q3 - q1, least_spread) AS high
  FROM q JOIN (VALUES ('symbol_rate', 25), ('dup_line_rate', 100), ('repeat_rate', 100), ('word_length', 40)) v(rate, least_spread)
  USING (rate)),
groups AS (SELECT DISTINCT lang, source FROM c),
pick AS (SELECT g.lang, g.source, f.rate, f.low, f.high,
    row_number() OVER (PARTITION BY g.lang, g.source, f.rate ORDER BY f.level) AS best
  FROM groups g JOIN f ON (f.level = 2 OR f.n >= 100) AND
    (f.level = 2 OR (f.level = 1 AND f.lang IS NOT DISTINCT FROM g.lang) OR
     (f.level = 0 AND f.lang IS NOT DISTINCT FROM g.lang AND f.source IS NOT DISTINCT FROM g.source))),
wide AS (SELECT lang, source, max(high) FILTER (rate = 'symbol_rate') AS h1, max(high) FILTER (rate = 'dup_line_rate') AS h2,
    max(high) FILTER (rate = 'repeat_rate') AS h3, max(high) FILTER (rate = 'word_length') AS h4,
    max(low) FILTER (rate = 'word_length') AS l4 FROM pick WHERE best = 1 GROUP BY lang, source)
SELECT c.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(symbol_rate > h1, false) AND NOT coalesce(dup_line_rate > h2, false)
    AND NOT coalesce(repeat_rate > h3, false) AND NOT coalesce(word_length > h4, false) AND NOT coalesce(word_length < l4, false) AS kept
FROM c LEFT JOIN wide ON c.lang IS NOT DISTINCT FROM wide.lang AND c.source IS NOT DISTINCT FROM wide.source
"""

OP2 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)
"""

OP7 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM q),
o AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, o.n FROM o JOIN q ON o.n = q.n AND o.g = q.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def license_sql() -> str:
    """The join as plain containment of every template in every block."""
    templates = ", ".join(f"({i}, '{label}', '{notice}')" for i, (label, notice) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{label}', '{phrase}')" for label, phrase in PHRASES.items())
    narrower = ", ".join(f"('{a}', '{b}')" for a, b in NARROWER)
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
ph AS (SELECT label, string_split(p, ' ') AS p FROM (VALUES {phrases}) v(label, p)),
places AS (SELECT doc_id, label, i - 1 AS at_word FROM (SELECT doc_id, label, w, p,
    unnest(range(1, len(w) - len(p) + 2)) AS i FROM d, ph WHERE len(w) >= len(p)) WHERE w[i:i + len(p) - 1] = p),
base AS (SELECT doc_id, count(*) AS n_base, min(at_word) AS first_word, max(at_word) AS last_word FROM places GROUP BY doc_id),
t AS (SELECT i, label, list_distinct(string_split(notice, ' ')) AS ws FROM (VALUES {templates}) v(i, label, notice)),
b AS (SELECT doc_id, k, list_distinct(w[32 * k + 1:32 * k + 64]) AS ws
  FROM (SELECT doc_id, w, unnest(range(0, len(w) // 32 + 1)) AS k FROM d)),
s AS (SELECT doc_id, k, label, len(list_intersect(b.ws, t.ws)) AS c, len(t.ws) AS n FROM b, t),
hit AS (SELECT doc_id, k, label, max(c / n) AS containment FROM s WHERE 100 * c >= 90 * n GROUP BY ALL),
most AS (SELECT doc_id, max(containment) AS best FROM hit GROUP BY doc_id),
own AS (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit o JOIN (VALUES {narrower}) x(a, z) ON o.label = x.a
    WHERE o.doc_id = h.doc_id AND o.k = h.k AND x.z = h.label)),
bl AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT doc_id, label FROM places) GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM own) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN most USING (doc_id)
"""

OP10 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS INT), 400) AS g
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400)),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM s) WHERE c > 1),
e AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
    SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM t)),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS z FROM e GROUP BY doc_id, run),
gaps AS (SELECT doc_id, run, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY run), 0) AS p FROM r),
k AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last,
    string_agg(substr(h, CAST(2 * p + 1 AS INT), CAST(2 * (a - p) AS INT)), '' ORDER BY run) AS head
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS INT)))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


OP12 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS k
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 5
"""

OP13 = """
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(1 + (xor(c, b) & 255) AS INT)])), 4294967295) % 7 = 0 AS altered,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents, crc),
e AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(n_chars + altered::INT AS VARCHAR)) || ':' || (n_chars + altered::INT), '-') || tail) AS claimed FROM d),
o AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM e),
nodes AS (SELECT g, 0 AS lvl, i, leaf AS h, n FROM o
  UNION ALL SELECT g, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY g, lvl, i // 2, n),
subs AS (SELECT g, h FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS lvl, g AS i, h, (SELECT count(*) FROM subs) AS n FROM subs
  UNION ALL SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY lvl, i // 2, n),
low AS (SELECT o.g, o.i, list(CASE WHEN s.h IS NULL THEN '-' WHEN s.i < o.i >> l.lvl THEN 'L' || s.h ELSE 'R' || s.h END ORDER BY l.lvl) AS path
  FROM o JOIN (SELECT DISTINCT g, lvl FROM nodes WHERE n > 1) l ON o.g = l.g
  LEFT JOIN nodes s ON s.g = o.g AND s.lvl = l.lvl AND s.i = xor(o.i >> l.lvl, 1) GROUP BY o.g, o.i),
high AS (SELECT b.g, list(CASE WHEN s.h IS NULL THEN '-' WHEN s.i < b.g >> l.lvl THEN 'L' || s.h ELSE 'R' || s.h END ORDER BY l.lvl) AS path
  FROM subs b JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) l ON true
  LEFT JOIN tops s ON s.lvl = l.lvl AND s.i = xor(b.g >> l.lvl, 1) GROUP BY b.g),
p AS (SELECT o.*, subs.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root,
    list_concat(coalesce(low.path, []), coalesce(high.path, [])) AS path
  FROM o JOIN subs ON o.g = subs.g LEFT JOIN low ON o.g = low.g AND o.i = low.i LEFT JOIN high ON o.g = high.g),
f AS (SELECT *, list_reduce(list_prepend(claimed, path), lambda a, s:
    sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM f
"""


def all_sql() -> dict[str, str]:
    return {
        "op2_minhash_near_dedup": OP2,
        "op4_quality_rules": OP4,
        "op6_license_scans": license_sql(),
        "op7_benchmark_decontamination": OP7,
        "op8_warc": OP8,
        "op10_suffix_array_dedup": OP10,
        "op12_hard_negative_mining": OP12,
        "op13_merkle_manifest": OP13,
    }
