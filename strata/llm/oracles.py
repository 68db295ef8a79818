"""DuckDB SQL for operators whose whole result SQL can express, written by definition: every pair, every prefix."""

from __future__ import annotations

from strata.llm import phrases, urlrules

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Smallest node reachable from each node along ``edge(a, b)``, both directions: a table ``comp(id, component_id)``.
_COMPONENTS = """
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(id, c) AS (SELECT a, least(a, b) FROM both_ways UNION SELECT w.b, r.c FROM reach r JOIN both_ways w ON w.a = r.id AND r.c < w.b),
comp AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
edge AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id < q.vec_id AND len(p.x) = len(q.x)
  AND list_cosine_similarity(p.x, q.x) >= 0.95),
n AS (SELECT a AS id, count(*) AS n FROM (SELECT a FROM edge UNION ALL SELECT b FROM edge) GROUP BY a),{_COMPONENTS}
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
  e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.id = e.vec_id LEFT JOIN comp c ON c.id = e.vec_id
"""

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w WHERE len(ws) >= 3),
grams AS (SELECT doc_id, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS g FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, g FROM grams WHERE g IS NOT NULL
  UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) IN (1, 2)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
edge AS (SELECT p.doc_id AS a, q.doc_id AS b FROM s p JOIN s q ON p.g = q.g AND p.doc_id < q.doc_id
  JOIN size m ON m.doc_id = p.doc_id JOIN size k ON k.doc_id = q.doc_id
  GROUP BY p.doc_id, q.doc_id, m.n, k.n HAVING 100 * count(*) >= 90 * (m.n + k.n - count(*))),{_COMPONENTS}
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN size z ON z.doc_id = d.doc_id LEFT JOIN comp c ON c.id = d.doc_id
"""

# A backslash goes before each backslash and mark; in roles a percent sign and a colon are written as percent codes.
_ESCAPED = "length({0}) + length(regexp_replace({0}, '\\\\|###|</turn>', chr(1), 'g')) - length(regexp_replace({0}, '\\\\|###|</turn>', '', 'g'))"

CHAT = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
l AS (SELECT *, replace(replace(role, '%', '%25'), ':', '%3A') AS role_code FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### : </turn>') + 1 + {_ESCAPED.format('role_code')} + {_ESCAPED.format('text')})::BIGINT AS formatted_chars
FROM l GROUP BY conv_id
"""

ORACLES: dict[str, str] = {
    "op4_embeddings": EMBEDDINGS,
    "op5_jaccard": JACCARD,
    "op7_chat": CHAT,
    "op11_urls": urlrules.ORACLE,
    "op12_phrases": phrases.ORACLE,
}
