"""Registered queries that SQL can state over whole tables, for DuckDB."""

from __future__ import annotations

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = "coalesce(text, '')"
_SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_WORDS = r"regexp_extract_all(" + _FOLD.format(_TEXT) + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LINES = f"""
WITH lines AS (
  SELECT doc_id, i, line, {_FOLD.format(f"trim(line, {_SPACES})")} AS k
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
    FROM (SELECT doc_id, string_split({_TEXT}, chr(10)) AS parts FROM documents))),
common AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
flagged AS (SELECT l.doc_id, l.i, l.line, coalesce(c.last <> l.doc_id, false) AS gone FROM lines l LEFT JOIN common c ON c.k = l.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id"""

CONTAMINATION = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM iw)),
spots AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, s FROM spots WHERE s IN (SELECT s FROM win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT h.doc_id, CAST(win.item_id AS VARCHAR) AS item FROM hits h JOIN win ON win.s = h.s AND win.n = h.n) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered ON covered.doc_id = dw.doc_id LEFT JOIN found ON found.doc_id = dw.doc_id"""

NEAREST = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

COPIES = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD.format(_TEXT)}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS sh FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(d, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.d, arcs.b FROM reach JOIN arcs ON arcs.a = reach.r),
least AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least ON d = doc_id LEFT JOIN sizes USING (doc_id)"""

SQL = {"op9_near_duplicates": COPIES, "op11_top_k": NEAREST, "op8_line_dedup": LINES, "op10_decontaminate": CONTAMINATION}
