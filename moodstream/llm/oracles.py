"""DuckDB SQL with the same results as the registered queries, where SQL can express them."""

from __future__ import annotations

from moodstream.llm import fill_middle, importance, line_dedup

_GOOD = """good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)"""

NEAREST = f"""WITH {_GOOD},
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20"""

LINKS = f"""WITH RECURSIVE {_GOOD},
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) >= 0.93 * sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))
),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id"""

# The test pages mark their article, so its blocks are what the rules must keep.
PAGES = r"""WITH parts AS (
  SELECT page_id, url, string_split_regex(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)>') AS p FROM pages
),
blocks AS (
  SELECT page_id, url, list_filter(list_transform(p, lambda b: trim(regexp_replace(
    replace(replace(replace(replace(replace(regexp_replace(b, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'),
      '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))),
    lambda b: b <> '') AS b FROM parts
)
SELECT page_id, url, array_to_string(b, chr(10)) AS text, CAST(length(array_to_string(b, chr(10))) AS BIGINT) AS n_chars FROM blocks"""

# Every 100-byte string that is not the first of its kind covers bytes that go.
REPEATS = """WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT doc_id, b, unnest(generate_series(1, octet_length(b) - 99)) AS s FROM docs WHERE octet_length(b) >= 100),
windows AS (SELECT doc_id, s, array_slice(b, s, s + 99) AS w FROM starts),
later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1
),
marked AS (
  SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 1 ELSE 0 END AS opens FROM later
),
numbered AS (SELECT doc_id, s, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM marked),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS e FROM numbered GROUP BY doc_id, span),
edges AS (
  SELECT doc_id, a, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 1) AS since FROM spans
  UNION ALL SELECT d.doc_id, octet_length(d.b) + 1, max(s.e) FROM docs d JOIN spans s USING (doc_id) GROUP BY ALL
),
kept AS (
  SELECT doc_id, string_agg(CASE WHEN a > since THEN hex(array_slice(b, since, a - 1)) ELSE '' END, '' ORDER BY a) AS h
  FROM edges JOIN docs USING (doc_id) GROUP BY doc_id
),
sums AS (SELECT doc_id, sum(e - a) AS gone, count(*) AS n FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       CASE WHEN h IS NULL THEN sha256(b) ELSE sha256(unhex(h)) END AS kept_sha256
FROM docs d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)"""

CHAT = """WITH RECURSIVE users AS (
  SELECT conv_id, turn, (turn - turn % 2) // 2 AS k, turn % 2 + 2 * (((turn - turn % 2) // 2) // 2) AS need,
         coalesce(text, '') AS said, length(coalesce(text, '')) AS n FROM conversations WHERE role = 'user'
),
every_answer AS (
  SELECT conv_id, turn - 1 AS asked, turn, text AS content, count(*) OVER same AS n,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) AS nth
  FROM conversations WHERE role = 'assistant' WINDOW same AS (PARTITION BY conv_id, turn)
),
answers AS (SELECT * FROM every_answer WHERE nth = 1),
wanted AS (
  SELECT u.*, u.k > 0 AND o.turn IS NOT NULL AS known, u.k > 0 AND o.turn IS NULL AS lacking
  FROM users u LEFT JOIN users o ON o.conv_id = u.conv_id AND o.turn = u.need
),
levels AS (
  SELECT conv_id, turn, 0 AS level FROM wanted WHERE NOT known
  UNION ALL SELECT w.conv_id, w.turn, l.level + 1 FROM wanted w JOIN levels l ON l.conv_id = w.conv_id AND l.turn = w.need WHERE w.known
),
calls AS (
  SELECT w.conv_id, w.turn, 'c' || w.turn AS call_id,
         CASE w.k % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'summarise' END AS name, l.level, a.content,
         CAST(coalesce(a.n, 0) AS BIGINT) AS n_results,
         list_filter([
           CASE WHEN w.k % 3 < 2 AND w.n % 7 = 0 THEN 'limit is not integer' END, CASE WHEN w.n % 11 = 0 THEN 'missing query' END,
           CASE WHEN a.asked IS NULL THEN 'no result' END, CASE WHEN w.k % 3 = 2 THEN 'unexpected limit' END,
           CASE WHEN w.lacking THEN 'unknown need' END], lambda e: e IS NOT NULL) AS errors,
         CASE WHEN w.n % 7 = 0 AND w.n % 11 = 0 THEN json_object('limit', CAST(w.n % 50 AS VARCHAR))
              WHEN w.n % 7 = 0 THEN json_object('limit', CAST(w.n % 50 AS VARCHAR), 'query', said)
              WHEN w.n % 11 = 0 THEN json_object('limit', w.n % 50) ELSE json_object('limit', w.n % 50, 'query', said) END AS arguments
  FROM wanted w JOIN levels l USING (conv_id, turn) LEFT JOIN answers a ON a.conv_id = w.conv_id AND a.asked = w.turn
),
linked AS (
  SELECT conv_id, turn, call_id, name, level, 0 AS behind, CAST(NULL AS VARCHAR) AS role, n_results, errors,
         json_object('arguments', arguments, 'call_id', call_id, 'content', content, 'name', name, 'turn', turn) AS record
  FROM calls
),
lost AS (
  SELECT a.conv_id, a.turn, 'c' || a.asked AS call_id, NULL, NULL, CASE WHEN nth = 1 THEN 0 ELSE 1 END AS behind, NULL,
         CASE WHEN nth = 1 THEN a.n ELSE 1 END, [CASE WHEN nth = 1 THEN 'result without a call' ELSE 'repeated result' END],
         json_object('arguments', json_object('text', NULL), 'call_id', 'c' || a.asked, 'content', a.content, 'name', NULL, 'turn', a.turn)
  FROM every_answer a LEFT JOIN users u ON u.conv_id = a.conv_id AND u.turn = a.asked WHERE u.turn IS NULL OR nth > 1
),
others AS (
  SELECT conv_id, turn, NULL, NULL, NULL, 2, role, 0, CASE WHEN role IS NULL THEN ['no role'] ELSE [] END,
         json_object('content', text, 'role', role, 'turn', turn)
  FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
),
every AS (SELECT * FROM linked UNION ALL SELECT * FROM lost UNION ALL SELECT * FROM others)
SELECT conv_id, turn, call_id, name, level,
       row_number() OVER (PARTITION BY conv_id ORDER BY level IS NULL, level, behind, turn, call_id NULLS FIRST, role NULLS FIRST) - 1 AS position,
       n_results, len(errors) = 0 AS valid, array_to_string(errors, '; ') AS errors, CAST(record AS VARCHAR) AS record
FROM every"""

ORACLES: dict[str, str] = {
    "op3_suffix_dedup": REPEATS,
    "op4_chat_formatting": CHAT,
    "op6_html_extraction": PAGES,
    "op8_nearest": NEAREST,
    "op9_embedding_dedup": LINKS,
    "op11_importance": importance.ORACLE,
    "op12_fill_in_middle": fill_middle.ORACLE,
    "op13_line_dedup": line_dedup.ORACLE,
}
