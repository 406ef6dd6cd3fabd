"""DuckDB SQL for the queries that SQL can express, from their definitions."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATE = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM item_words WHERE len(w) > 0)
),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc_words, (SELECT DISTINCT n FROM windows))
),
hits AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, g)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

SUFFIX_DEDUP = """
WITH bytes AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (
  SELECT doc_id, i, b[i + 1:i + 50] AS g
  FROM (SELECT doc_id, b, unnest(range(0, octet_length(b) - 49)) AS i FROM bytes)
),
earliest AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
covered AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN earliest USING (g) WHERE least < doc_id)
),
spans AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before < p - 1) AS n_spans
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM covered) GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(hex(b[p + 1:p + 1]), '' ORDER BY p) AS k
  FROM (SELECT doc_id, b, unnest(range(0, octet_length(b))) AS p FROM bytes) ANTI JOIN covered USING (doc_id, p)
  GROUP BY doc_id
)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM bytes LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)"""

JACCARD_JOIN = rf"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM doc_words)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reached.doc_id, edges.b FROM reached JOIN edges ON reached.other = edges.a
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

SUBSTRING_DEDUP = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc_words)
),
earliest AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
covered AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN earliest USING (g) WHERE least < doc_id)
),
removed AS (SELECT doc_id, count(*) AS n_removed FROM covered GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc_words)
       ANTI JOIN covered USING (doc_id, p)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM doc_words LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

# A text is escaped if it holds a control string or ends with a backslash: else it parses back as it is.
CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
written AS (
  SELECT *, regexp_replace(role, '([\\:])', '\\\1', 'g') AS head,
         regexp_replace(regexp_replace(text, '(\\*)(###|</turn>)', '\1\1\\\2', 'g'), '(\\+)$', '\1\1') AS body
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || head || ': ' || body || '</turn>') + 1) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id"""

def _centroid_rounds(k: int, length: int, rounds: int, salt: str) -> str:
    """Assignment and floor of means, written out round by round."""
    square = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    nearest = f"""SELECT vec_id, x, best %% {k} AS k, best // {k} AS d
  FROM (SELECT vec_id, x, min({square} * {k} + k) AS best FROM vectors, centroids_%d GROUP BY vec_id, x)"""
    steps = [
        f"""
vectors AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {length}
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {length}
),
centroids_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id)) - 1 AS k, x AS c
  FROM vectors QUALIFY k < {k}
)"""
    ]
    for i in range(rounds):
        steps.append(
            f"""
assigned_{i} AS MATERIALIZED ({nearest % i}),
means_{i} AS (
  SELECT k, place, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
  FROM (SELECT k, place, sum(v) AS s, count(*) AS n
        FROM (SELECT k, unnest(x) AS v, unnest(range(1, {length} + 1)) AS place FROM assigned_{i})
        GROUP BY k, place)
),
centroids_{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c
  FROM centroids_{i} LEFT JOIN (SELECT k, list(m ORDER BY place) AS m FROM means_{i} GROUP BY k) USING (k)
)"""
        )
    return f"""
WITH {",".join(steps)},
found AS MATERIALIZED ({nearest % rounds})
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN centroids_{rounds} USING (k)"""


ORACLES: dict[str, str] = {
    "op2_decontaminate": DECONTAMINATE,
    "op4_suffix_dedup": SUFFIX_DEDUP,
    "op6_jaccard_join": JACCARD_JOIN,
    "op7_substring_dedup": SUBSTRING_DEDUP,
    "op8_chat": CHAT,
    "op12_centroids": _centroid_rounds(40, 64, 5, "2"),
}
