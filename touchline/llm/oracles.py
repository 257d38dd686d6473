"""SQL that gives the rows of the queries SQL can express."""

from __future__ import annotations

import math

from touchline.llm import license_scan as lic

_LOWER = f"translate(coalesce(text, ''), '{lic.UPPER}', '{lic.LOWER}')"

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.d
), m AS (SELECT d, min(c) AS component_id FROM r GROUP BY 1)
SELECT o.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents o LEFT JOIN n ON n.doc_id = o.doc_id LEFT JOIN m ON m.d = o.doc_id
"""

EXACT_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM s
)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 20
"""


def _template_rows() -> str:
    rows = []
    for number, (label, text) in enumerate(lic.TEMPLATES):
        ws = lic._template_words(text)
        need = math.ceil(lic.CONTAINMENT * len(ws) - 1e-9)
        rows += [f"({number}, '{label}', '{w}', {len(ws)}, {need})" for w in ws]
    return ", ".join(rows)


LICENSES = f"""
WITH t(template, label, w, size, need) AS (VALUES {_template_rows()}
), d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents
), u AS (
  SELECT row, unnest(ws) AS w, unnest(range(0, len(ws))) AS i FROM d
), l AS (
  SELECT row, w, i, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM u WINDOW o AS (PARTITION BY row ORDER BY i)
), b AS (
  SELECT row, i, CASE WHEN w = 'mit' AND w1 = 'license' THEN 'mit' WHEN w = 'apache' AND w1 = 'license' THEN 'apache'
    WHEN w = 'general' AND w1 = 'public' AND w2 = 'license' THEN 'gpl' END AS label
  FROM l
), bs AS (
  SELECT row, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM b WHERE label IS NOT NULL GROUP BY 1
), h AS (
  SELECT row, w, i // {lic.STRIDE} AS block FROM u WHERE w IN (SELECT w FROM t)
  UNION SELECT row, w, i // {lic.STRIDE} - 1 FROM u WHERE w IN (SELECT w FROM t)
), c AS (
  SELECT row, block, template, label, size, need, count(*) AS c FROM h JOIN t USING (w) GROUP BY ALL HAVING count(*) >= need
), ls AS (
  SELECT row, label FROM b WHERE label IS NOT NULL UNION SELECT row, label FROM c
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM b WHERE b.row = d.row AND label IS NOT NULL), '') AS base_labels,
  coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM ls WHERE ls.row = d.row), '') AS labels,
  coalesce((SELECT max(c / size) FROM c WHERE c.row = d.row), 0.0) AS score
FROM d LEFT JOIN bs ON bs.row = d.row
"""

LINE_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT row, doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS i FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{lic.UPPER}', '{lic.LOWER}') AS key FROM l
), m AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), s AS (
  SELECT row, k.doc_id, line, i, m.first IS NULL OR m.first = k.doc_id AS stays FROM k LEFT JOIN m USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays), '')) AS kept_sha256
FROM s GROUP BY row
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS "rank"
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE p.place <= 5 AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, "rank", negative_id, positive_score, negative_score FROM n WHERE "rank" <= 10
"""
