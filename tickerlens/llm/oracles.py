"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tickerlens.llm.licence_scan import PHRASES, TEMPLATES
from tickerlens.llm.url_filter import RULES, TAG_PATTERNS

_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_LINKS = " UNION ALL ".join(
    f"SELECT url AS src, regexp_extract(tag, {_quoted(at)}, 1) AS link FROM (SELECT url, unnest(regexp_extract_all(html, {_quoted(tag)})) AS tag FROM pages WHERE contains(url, '://'))"
    for tag, at in TAG_PATTERNS.items()
)

URL_FILTER = rf"""
WITH RECURSIVE rules(ruling, rhost, prefix) AS (VALUES {_VALUES}),
rest_of AS (SELECT url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM (SELECT url FROM pages)),
links AS (SELECT DISTINCT src, replace(link, '&amp;', '&') AS link FROM ({_LINKS}) WHERE link <> ''),
based AS (
  SELECT src, link, regexp_extract(src, '^(.*?)://', 1) AS scheme,
    translate(regexp_extract(substr(src, instr(src, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h,
    regexp_extract(substr(src, instr(src, '://') + 3), '^[^/?#]*([^?#]*)', 1) AS p
  FROM links
),
pairs AS (
  SELECT src, CASE
    WHEN contains(link, '://') THEN link
    WHEN link LIKE '//%' THEN scheme || ':' || link
    WHEN link LIKE '/%' THEN scheme || '://' || h || link
    WHEN link LIKE '?%' THEN scheme || '://' || h || p || link
    WHEN link LIKE '#%' THEN src
    ELSE scheme || '://' || h || coalesce(nullif(regexp_extract(p, '^(.*/)', 1), ''), '/') || link END AS dst
  FROM based
),
urls AS (SELECT src AS url FROM pairs UNION SELECT dst FROM pairs UNION SELECT url FROM pages),
parsed AS (
  SELECT url, rest,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM urls)
),
nodes AS (
  SELECT url, host, path, CASE WHEN rest IS NOT NULL THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '') || regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) END AS node
  FROM parsed
),
ruled AS (
  SELECT n.url, r.rhost || r.prefix AS rule, r.ruling,
    row_number() OVER (PARTITION BY n.url ORDER BY length(r.rhost || r.prefix) DESC, r.rhost || r.prefix DESC) AS rn
  FROM nodes n JOIN rules r ON (n.host = r.rhost OR ends_with(n.host, '.' || r.rhost)) AND starts_with(n.path, r.prefix)
),
best AS (SELECT url, rule, ruling FROM ruled WHERE rn = 1),
edges AS (
  SELECT a.node AS a, b.node AS b FROM pairs p JOIN nodes a ON a.url = p.src JOIN nodes b ON b.url = p.dst
),
ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b),
classes AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a),
bad AS (SELECT DISTINCT c.component FROM classes c JOIN nodes n ON n.node = c.node JOIN best ON best.url = n.url AND best.ruling = 'block')
SELECT p.page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, best.rule,
  coalesce(best.ruling, CASE WHEN bad.component IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, c.component AS alias_of
FROM pages p LEFT JOIN nodes n ON n.url = p.url LEFT JOIN best ON best.url = p.url
LEFT JOIN classes c ON c.node = n.node LEFT JOIN bad ON bad.component = c.component
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, s, hash(words[s:s + 19]) AS h, words[s:s + 19] AS w
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS s FROM docs WHERE len(words) >= 20)
),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
numbered AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS rn
  FROM windows WHERE h IN (SELECT h FROM twice)
),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS p FROM numbered WHERE rn > 1),
by_doc AS (SELECT doc_id, list(p) AS gone, count(*) AS n FROM gone GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM docs WHERE doc_id IN (SELECT doc_id FROM by_doc)),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(b.n, 0) AS n_removed,
  sha256(CASE WHEN b.doc_id IS NULL THEN array_to_string(d.words, ' ') ELSE coalesce(l.kept, '') END) AS kept_sha256
FROM docs d LEFT JOIN by_doc b USING (doc_id) LEFT JOIN left_over l USING (doc_id)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in generate_series(1, len(words) - 2)]) END AS shingles
  FROM docs
),
sizes AS (SELECT doc_id, len(shingles) AS n FROM sets),
flat AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b)
SELECT s.doc_id, s.n AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sizes s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

LINKED_VECTORS = r"""
WITH RECURSIVE valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
classes AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN classes USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

_PHRASES = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES)
_TEMPLATES = ", ".join(f"({i}, '{label}', string_split('{p}', ' '), string_split('{key}', ' '))" for i, (label, p, key) in enumerate(TEMPLATES))

LICENCE_SCAN = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
flat AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS p FROM docs),
phrases AS (SELECT string_split(phrase, ' ') AS words, label FROM (VALUES {_PHRASES}) AS v(phrase, label)),
stands AS (
  SELECT f.r, f.p, h.label FROM flat f JOIN phrases h ON h.words[1] = f.w JOIN docs d ON d.r = f.r
  WHERE d.words[f.p + 1:f.p + len(h.words)] = h.words
),
base AS (SELECT r, count(*) AS n, min(p) AS first_word, max(p) AS last_word FROM stands GROUP BY r),
templates(t, label, words, key) AS (VALUES {_TEMPLATES}),
places AS (SELECT t, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS q FROM templates),
keyed AS (SELECT t.*, (SELECT min(i) FROM unnest(generate_series(0, len(t.words))) AS g(i) WHERE t.words[i + 1:i + len(t.key)] = t.key) AS key_at FROM templates t),
hits AS (SELECT r, w, p FROM flat WHERE w IN (SELECT w FROM places)),
rarity AS (SELECT w, count(DISTINCT r) AS docs FROM hits GROUP BY w),
ranked AS (
  SELECT r, t, w, row_number() OVER (PARTITION BY r, t ORDER BY docs, w) AS rn
  FROM (SELECT DISTINCT h.r, s.t, h.w FROM hits h JOIN places s USING (w)) JOIN rarity USING (w)
),
looked_up AS (SELECT r, t, w, count(*) OVER (PARTITION BY r, t) AS n FROM ranked WHERE rn <= 8),
begins AS (
  SELECT r, t, p - q AS begin FROM looked_up JOIN hits USING (r, w) JOIN places USING (t, w)
  GROUP BY r, t, p - q, n HAVING 2 * count(DISTINCT w) >= n
),
matched AS (
  SELECT b.r, b.t, b.begin, count(*) AS here FROM begins b JOIN places s ON s.t = b.t JOIN hits h ON h.r = b.r AND h.w = s.w AND h.p = b.begin + s.q
  GROUP BY b.r, b.t, b.begin
),
found AS (
  SELECT m.r, k.label, m.here / len(k.words) AS share FROM matched m JOIN keyed k USING (t) JOIN docs d USING (r)
  WHERE 10 * m.here >= 8 * len(k.words) AND m.begin + key_at >= 0 AND d.words[m.begin + key_at + 1:m.begin + key_at + len(k.key)] = k.key
),
own AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM stands GROUP BY r),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM stands UNION SELECT r, label FROM found) GROUP BY r),
best AS (SELECT r, max(share) AS share FROM found GROUP BY r)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(b.n, 0) AS n_base, b.first_word, b.last_word, coalesce(o.labels, '') AS base_labels, coalesce(e.labels, '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.share, 0)::DOUBLE END AS score
FROM docs d LEFT JOIN base b USING (r) LEFT JOIN own o USING (r) LEFT JOIN every e USING (r) LEFT JOIN best USING (r)
"""

FILL_IN_MIDDLE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM docs
),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:least(a, b)], '') AS prefix,
    array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(units[greatest(a, b) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
