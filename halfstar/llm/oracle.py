"""DuckDB SQL for the registered queries that SQL can express, on the tables of a test folder.

They follow the definitions, not the methods, and are meant for small tables: all pairs that share a shingle or
belong to a query are listed.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _words(text: str) -> str:
    return rf"regexp_extract_all({_lower(f"coalesce({text}, '')")}, '[^\x20\x09-\x0D]+')"


def _shingles(table: str, name: str, width: int, whole_if_short: bool) -> str:
    """Distinct shingles of a table's texts, by ``name``."""
    first = f"greatest(len(w) - {width - 1}, {'least(len(w), 1)' if whole_if_short else 0})"
    return f"""
        SELECT DISTINCT {name}, array_to_string(w[i : i + {width - 1}], ' ') AS shingle
        FROM (SELECT {name}, w, unnest(generate_series(1, {first})) AS i
              FROM (SELECT {name}, {_words('text')} AS w FROM {table}))"""


OP2 = f"""
WITH of_docs AS ({_shingles('documents', 'doc_id', 5, False)}),
of_items AS ({_shingles('benchmark', 'item_id', 5, False)}),
sizes AS (SELECT item_id, count(*) AS n_item FROM of_items GROUP BY item_id),
short AS (
  SELECT item_id, ' ' || array_to_string(w, ' ') || ' ' AS sequence
  FROM (SELECT item_id, {_words('text')} AS w FROM benchmark) WHERE len(w) BETWEEN 1 AND 4)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM of_docs JOIN of_items USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n_item)
UNION ALL
SELECT doc_id, item_id, 1, 1
FROM short JOIN (SELECT doc_id, ' ' || array_to_string({_words('text')}, ' ') || ' ' AS text FROM documents)
  ON contains(text, sequence)"""

OP3 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages),
groups AS (SELECT digest, payload_bytes, max(page_id) AS keeper FROM payloads GROUP BY ALL),
bits AS (
  SELECT digest, array_to_string(list_transform(generate_series(1, 40), lambda i:
    lpad(bin(strpos('0123456789abcdef', digest[i]) - 1), 4, '0')), '') AS b
  FROM (SELECT DISTINCT digest FROM payloads))
SELECT page_id, payload_bytes,
  array_to_string(list_transform(generate_series(0, 31), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(list_sum(list_transform(generate_series(1, 5), lambda k:
      CAST(b[5 * i + k] AS INT) * (1 << (5 - k)))) AS INT)]), '') AS payload_digest,
  CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM payloads JOIN groups USING (digest, payload_bytes) JOIN bits USING (digest)"""

OP4 = f"""
WITH RECURSIVE sets AS ({_shingles('documents', 'doc_id', 3, True)}),
sizes AS (SELECT doc_id, count(shingle) AS n FROM documents LEFT JOIN sets USING (doc_id) GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common.n >= 90 * (p.n + q.n - common.n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT reach.doc_id, y FROM reach JOIN links ON x = other)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id"""

OP7 = f"""
WITH rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests),
parts AS (
  SELECT page_id, {_lower('raw')} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) = 1"""

_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|<?/?SYS>>|\|[A-Za-z0-9_]*\|>)"
_ESCAPED = rf"regexp_replace(%s, '{_CONTROL}', '\1\\\2\3', 'g')"

OP10 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length('<|im_start|>') + length({_ESCAPED % 'role'}) + 1 + length({_ESCAPED % 'text'}) + length('<|im_end|>') + 1 AS chars
  FROM turns),
held AS (
  SELECT *, count(*) FILTER (role = 'assistant' OR k = n) OVER (
    PARTITION BY conv_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS examples
  FROM placed)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars * examples) AS BIGINT) AS formatted_chars
FROM held GROUP BY conv_id"""

OP13 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

STATEMENTS: dict[str, str] = {
    "op2_decontamination": OP2,
    "op3_warc": OP3,
    "op4_ngram_jaccard": OP4,
    "op7_url_filters": OP7,
    "op10_chat_formatting": OP10,
    "op13_hard_negatives": OP13,
}
