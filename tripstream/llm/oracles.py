"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tripstream.llm import license_scan

OP1 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), h AS (
  SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS sha FROM p
), f AS (
  SELECT sha, min(page_id) AS first_id FROM h GROUP BY sha
)
SELECT h.page_id, h.payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h.sha, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN h.page_id = f.first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN h.page_id = f.first_id THEN NULL ELSE f.first_id END AS refers_to
FROM h JOIN f ON h.sha = f.sha
"""

_CHAT_ESCAPE = r"regexp_replace({}, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\])', '\1\\\2\3', 'g')"

OP3 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), b AS (
  SELECT *, length({_CHAT_ESCAPE.format('text')}) + CASE role WHEN 'assistant' THEN 7 WHEN 'system' THEN 11
            WHEN 'user' THEN 13 ELSE 26 + length({_CHAT_ESCAPE.format('role')}) END AS n
  FROM t
), c AS (
  SELECT *, sum(n) OVER w AS upto, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS turns
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
), g AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '') AS loss,
         sum(CASE WHEN role = 'assistant' OR k = turns THEN upto END)::BIGINT AS formatted_chars,
         count(*) FILTER (role = 'assistant') AS n_examples
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars, n_examples
FROM g
"""

OP4 = r"""
WITH w AS (
  SELECT doc_id, NULL AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT NULL, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark
), g AS (
  SELECT DISTINCT doc_id, item_id, w[i + 1 : i + 5] AS s
  FROM (SELECT doc_id, item_id, w, unnest(range(len(w) - 4)) AS i FROM w WHERE len(w) >= 5)
), n AS (
  SELECT item_id, count(*) AS n_item FROM g WHERE item_id IS NOT NULL GROUP BY item_id
), p AS (
  SELECT d.doc_id, b.item_id, count(*) AS n_shared
  FROM g d JOIN g b ON d.s = b.s AND d.doc_id IS NOT NULL AND b.item_id IS NOT NULL GROUP BY ALL
)
SELECT doc_id, p.item_id, n_item, n_shared FROM p JOIN n ON n.item_id = p.item_id
WHERE 5 * n_shared >= 4 * n_item
"""

OP6 = r"""
WITH r AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '://(.*)$', 1, 's') AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM r
), j AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
    host || path || query AS u
  FROM p
), g AS (
  SELECT *, (u = '')::INT + (u LIKE '%?page=%')::INT + (u LIKE '%?%session%')::INT + (u LIKE '%/login%')::INT
    + (u LIKE '%/wp-admin/%')::INT + (u LIKE '%/cgi-bin/%')::INT + (u LIKE '%.exe')::INT + (u LIKE '%.zip')::INT
    + regexp_matches(u, '^[^/]*casino[^/]*/')::INT + regexp_matches(u, '^[^/]*porn[^/]*/')::INT AS n
  FROM j
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR n > 0 THEN 'block'
            ELSE 'allow' END AS verdict, n::BIGINT AS n_globs
FROM g
"""

# Runs of 3 lines, or of 1 or 2 with 100 characters; copies after the first go.
OP8 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM documents
), s AS (
  SELECT doc_id, line, x, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS seq
  FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), g AS (
  SELECT *, lead(x) OVER w AS x2, lead(x, 2) OVER w AS x3, length(x) AS c1 FROM s
  WINDOW w AS (PARTITION BY doc_id ORDER BY seq)
), k AS (
  SELECT doc_id, seq,
    c1 >= 100 AND row_number() OVER (PARTITION BY x ORDER BY doc_id, seq) > 1 AS g1,
    x2 IS NOT NULL AND c1 + length(x2) >= 100 AND row_number() OVER (PARTITION BY x, x2 ORDER BY doc_id, seq) > 1 AS g2,
    x3 IS NOT NULL AND row_number() OVER (PARTITION BY x, x2, x3 ORDER BY doc_id, seq) > 1 AS g3
  FROM g
), gone AS (
  SELECT DISTINCT doc_id, seq + o AS seq
  FROM (SELECT doc_id, seq, unnest(CASE WHEN g3 THEN [0, 1, 2] WHEN g2 THEN [0, 1] ELSE [0] END) AS o
        FROM k WHERE g1 OR g2 OR g3)
), d AS (
  SELECT l.doc_id, l.line, l.x, gone.seq IS NOT NULL AS gone
  FROM l LEFT JOIN s ON s.doc_id = l.doc_id AND s.line = l.line
  LEFT JOIN gone ON gone.doc_id = s.doc_id AND gone.seq = s.seq
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
       coalesce(string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (gone), '') AS deleted,
       coalesce(string_agg(x, chr(10) ORDER BY line) FILTER (NOT gone), '') AS text
FROM d GROUP BY doc_id
"""

_TEMPLATES = ", ".join(f"({t}, '{x.label}', '{' '.join(x.words.split())}', {x.base})"
                       for t, x in enumerate(license_scan.BASE + license_scan.METHOD + license_scan.TEXTS))

OP10 = rf"""
WITH t(t, label, words, base) AS (VALUES {_TEMPLATES}
), tw AS (
  SELECT t, label, base, string_split(words, ' ') AS w FROM t
), tg AS (
  SELECT t, label, base, len(w) - 1 AS m, p, w[p + 1] AS w0, w[p + 2] AS w1
  FROM (SELECT *, unnest(range(len(w) - 1)) AS p FROM tw)
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), g AS (
  SELECT doc_id, i AS pos, w0, lead(w0) OVER (PARTITION BY doc_id ORDER BY i) AS w1
  FROM (SELECT doc_id, unnest(w) AS w0, generate_subscripts(w, 1) - 1 AS i FROM d)
), v AS (
  SELECT doc_id, t, label, base, m, pos - p AS diagonal, count(*) AS votes, min(pos) AS s, max(pos) AS e, list(p) AS ps
  FROM g JOIN tg USING (w0, w1) GROUP BY ALL
), f AS (
  SELECT *, (base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, t ORDER BY diagonal) > 2, true))::INT AS fresh
  FROM v
), c AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS span FROM f
), n AS (
  SELECT doc_id, t, label, base, m, min(s) AS s, max(e) + 2 AS e, max(votes) AS votes,
         len(list_distinct(flatten(list(ps)))) AS n
  FROM c GROUP BY doc_id, t, label, base, m, span
), ok AS (
  SELECT * FROM n WHERE CASE WHEN base THEN votes = m ELSE n / m >= 0.75 AND e - s <= ceil(1.34 * (m + 1)) END
), a AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
         array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
         array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(n / m) AS score
  FROM ok GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""

OP12 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS al, b.vec_id AS id, b.label AS bl,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, al, id AS positive_id, score AS positive_score FROM s WHERE al = bl
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.bl <> s.al
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

ORACLES = {
    "op1_warc_bundles": OP1,
    "op3_chat_examples": OP3,
    "op4_benchmark_leaks": OP4,
    "op6_url_verdicts": OP6,
    "op8_line_runs": OP8,
    "op10_license_spans": OP10,
    "op12_hard_negatives": OP12,
}
