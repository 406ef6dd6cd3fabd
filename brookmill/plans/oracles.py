"""Reference SQL for the queries, in the dialect of DuckDB, over the same tables."""

from __future__ import annotations

from brookmill.operators.dashboard import KEY_NAMES

TREE_DEPTH = 3

DIRTY = """
dirty AS (
  SELECT CASE WHEN event_id % 83 = 0 THEN 'x' ELSE '' END || CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_id % 79 = 0 THEN 'yesterday' ELSE CAST(ts AS VARCHAR) END AS ts,
         CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_id % 7 = 0 THEN '  ' || event_type || ' ' ELSE event_type END AS event_type,
         CASE WHEN event_id % 89 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value,
         props
  FROM events, (VALUES (1), (2)) AS copies(copy)
  WHERE copy = 1 OR event_id % 50 = 0
)"""

CLEAN = (
    DIRTY
    + """,
typed AS (
  SELECT TRY_CAST(event_id AS BIGINT) AS event_id, TRY_CAST(ts AS TIMESTAMP) AS ts,
         TRY_CAST(user_id AS BIGINT) AS user_id, trim(event_type) AS event_type,
         TRY_CAST(value AS DOUBLE) AS value, props,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM dirty
),
clean AS (
  SELECT * FROM typed
  WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL AND value IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY event_id ORDER BY ts, user_id, event_type, value, props, k) = 1
)"""
)

# A record as JSON text; only a missing user can be null.
PAYLOAD = """'{"event_id":' || to_json(event_id) || ',"ts":' || to_json(ts)
       || CASE WHEN user_id IS NULL THEN '' ELSE ',"user_id":' || to_json(user_id) END
       || ',"event_type":' || to_json(event_type) || ',"value":' || to_json(value)
       || ',"props":' || to_json(props) || '}'"""

MARKED = (
    "WITH "
    + DIRTY
    + """,
marked AS (
  SELECT *, CASE WHEN TRY_CAST(user_id AS BIGINT) IS NULL THEN 'null_user'
                 WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN 'bad_value'
                 WHEN TRY_CAST(event_id AS BIGINT) IS NULL THEN 'bad_id'
                 WHEN TRY_CAST(ts AS TIMESTAMP) IS NULL THEN 'bad_time' ELSE '' END AS reason
  FROM dirty
)"""
)

DLQ = (
    MARKED
    + """
SELECT CASE WHEN reason = '' THEN 'ok' ELSE 'dlq' END AS status, reason, count(*) AS n
FROM marked GROUP BY ALL"""
)

SESSIONS = """
paused AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                      <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL
),
sessions AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no
  FROM paused
)"""

SESSION_SUMMARY = f"""
WITH {SESSIONS}
SELECT user_id, session_no, min(ts) AS start, max(ts) AS "end", count(*) AS n,
       count(*) FILTER (event_type = 'purchase') AS purchases,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 AS seconds
FROM sessions GROUP BY user_id, session_no"""

ATTEMPTS = """
attempts AS (
  SELECT user_id, CAST(ts AS DATE) AS dt, ts, event_id, event_type <> 'error' AS ok,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS attempt
  FROM events
)"""

RULES = r"""
rules AS (
  SELECT doc_id, CAST(email AS INTEGER) AS email, CAST(phone AS INTEGER) AS phone,
         CAST(licence AS INTEGER) AS licence, CAST(symbols AS INTEGER) AS symbols,
         1.0e0 * CAST(email AS INTEGER) + 1.0e0 * CAST(phone AS INTEGER)
         + 0.5e0 * CAST(licence AS INTEGER) + 2.0e0 * CAST(symbols AS INTEGER) AS score
  FROM (
    SELECT doc_id,
           regexp_matches(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z]+') AS email,
           regexp_matches(text, '\+?\d[\d ()-]{7,}\d') AS phone,
           regexp_matches(text, '(?i)licen[sc]e|copyright') AS licence,
           regexp_matches(text, '[%*#]{3,}') AS symbols
    FROM documents
  )
)"""

NUMBERS = r"""
numbers AS (
  SELECT doc_id, n_chars,
         CAST(len(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> ''))
              AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS BIGINT) AS n_digits
  FROM documents
)"""

GRAMS = """
WITH chars AS (
  SELECT doc_id, string_split(text, '') AS ch FROM documents WHERE length(text) >= 2
),
grams AS (
  SELECT doc_id, unnest(list_transform(range(1, len(ch)), lambda i: ch[i] || ch[i + 1])) AS gram
  FROM chars
),
counts AS (SELECT doc_id, gram, count(*) AS tf FROM grams GROUP BY doc_id, gram),
weights AS (
  SELECT gram, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1.0e0) / (count(*) + 1.0e0)) AS idf
  FROM counts GROUP BY gram
)"""

CELLS = (
    RULES
    + """,
docs AS (
  SELECT lang AS category, length(CAST(n_chars AS VARCHAR)) AS length, score > 0 AS rules, quality
  FROM documents JOIN labels USING (doc_id) JOIN rules USING (doc_id)
),
cells AS (
  SELECT category, length, rules, quality, count(*) AS n,
         grouping(category) AS a, grouping(length) AS b, grouping(rules) AS c
  FROM docs
  GROUP BY GROUPING SETS ((quality), (category, quality), (length, quality), (rules, quality),
    (category, length, quality), (category, rules, quality), (length, rules, quality),
    (category, length, rules, quality))
),
best AS (
  SELECT a, b, c, max(n) AS n FROM cells GROUP BY a, b, c, category, length, rules
),
coalitions AS (
  SELECT a, b, c,
         concat_ws('+', CASE WHEN a = 0 THEN 'category' END, CASE WHEN b = 0 THEN 'length' END,
                   CASE WHEN c = 0 THEN 'rules' END) AS subset,
         sum(n) / (SELECT count(*) FROM docs) AS metric
  FROM best GROUP BY a, b, c
)"""
)


FOLDS = """
SELECT doc_id, true AS valid,
       CASE WHEN quality IS NULL THEN 'unlabelled'
            WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 THEN 'test'
            ELSE 'train' END AS fold
FROM documents LEFT JOIN labels USING (doc_id)"""

# Of the model keys, the first is set, the second is empty, and the others are missing.
STATES = ("'a key'", "''", "NULL", "NULL", "NULL")


def _phi(own: str, first: str, second: str) -> str:
    """Shapley value of one of three groups, from the definition: weighted gains over all subsets."""
    joined = f"x.{first} = y.{first} AND x.{second} = y.{second}"
    weight = f"CASE WHEN y.{first} + y.{second} = 1 THEN 1.0e0 / 6 ELSE 1.0e0 / 3 END"
    return (
        f"(SELECT round(sum(({weight}) * (x.metric - y.metric)), 6) FROM coalitions x "
        f"JOIN coalitions y ON x.{own} = 0 AND y.{own} = 1 AND {joined})"
    )


FEATURES = ("n_chars", "n_words", "n_digits", "email", "phone", "licence", "symbols", "score")

INPUTS = (
    RULES
    + ","
    + NUMBERS
    + """,
inputs AS MATERIALIZED (SELECT * FROM numbers JOIN rules USING (doc_id)),
placed_0 AS (SELECT inputs.*, quality, 1 AS node FROM inputs JOIN labels USING (doc_id) WHERE quality IN (0, 1))"""
)


def _value(feature: str) -> str:
    """The value of the feature that a column names."""
    return f"CASE {feature} {' '.join(f"WHEN '{f}' THEN CAST({f} AS DOUBLE)" for f in FEATURES)} END"


def _split_level(i: int) -> str:
    """Every split of every node of one level, the best by feature, the best of all, and the rows of the next level."""
    names, values = (", ".join(x) for x in ([f"'{f}'" for f in FEATURES], [f"CAST({f} AS DOUBLE)" for f in FEATURES]))

    def gini(n: str, p: str) -> str:
        return f"CAST(2 * ({p}) * (({n}) - ({p})) AS DOUBLE) / ({n})"

    return f"""
counts_{i} AS (
  SELECT node, feature, value, CAST(count(*) AS BIGINT) AS n, CAST(sum(quality) AS BIGINT) AS p
  FROM (SELECT node, quality, unnest([{names}]) AS feature, unnest([{values}]) AS value FROM placed_{i})
  GROUP BY ALL
),
sums_{i} AS (
  SELECT node, feature, value, CAST(sum(n) OVER upto AS BIGINT) AS nl, CAST(sum(p) OVER upto AS BIGINT) AS pl,
         CAST(sum(n) OVER own AS BIGINT) AS n, CAST(sum(p) OVER own AS BIGINT) AS p
  FROM counts_{i} WINDOW upto AS (PARTITION BY node, feature ORDER BY value), own AS (PARTITION BY node, feature)
),
splits_{i} AS (
  SELECT node, feature, value AS threshold, n, p, nl, pl,
         round(({gini('n', 'p')} - {gini('nl', 'pl')} - {gini('n - nl', 'p - pl')}) / n, 9) AS gain
  FROM sums_{i} WHERE nl < n
  QUALIFY row_number() OVER (PARTITION BY node, feature ORDER BY gain DESC, value) = 1
),
chosen_{i} AS MATERIALIZED (
  SELECT * FROM splits_{i} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature) = 1
),
placed_{i + 1} AS MATERIALIZED (
  SELECT placed_{i}.* EXCLUDE (node),
         2 * node + CASE WHEN {_value('feature')} <= threshold THEN 0 ELSE 1 END AS node
  FROM placed_{i} JOIN (SELECT node, feature, threshold FROM chosen_{i}) USING (node)
)"""


TREE = (
    INPUTS
    + ","
    + ",".join(_split_level(i) for i in range(TREE_DEPTH))
    + f""",
inner_nodes AS (
  {" UNION ALL ".join(f"SELECT * FROM chosen_{i}" for i in range(TREE_DEPTH))}
),
nodes AS (
  SELECT 1 AS node, count(*) AS n, CAST(sum(quality) AS BIGINT) AS p FROM placed_0 HAVING count(*) > 0
  UNION ALL SELECT 2 * node, nl, pl FROM inner_nodes
  UNION ALL SELECT 2 * node + 1, n - nl, p - pl FROM inner_nodes
)"""
)

# Shapley values from the definition: what each set of known features is worth, over all sets of the tree's features.
TREE_GAME = (
    TREE
    + f""",
steps AS (
  SELECT leaf.node AS leaf, leaf.p * 1.0e0 / leaf.n AS worth, c.feature, c.threshold,
         ((leaf.node >> (k - 1)) & 1) = 0 AS goes_left, child.n * 1.0e0 / c.n AS share
  FROM (SELECT * FROM nodes WHERE node NOT IN (SELECT node FROM inner_nodes)) leaf,
       (SELECT unnest(range(1, {TREE_DEPTH + 1})) AS k)
  JOIN inner_nodes c ON c.node = leaf.node >> k
  JOIN nodes child ON child.node = leaf.node >> (k - 1)
),
players AS (
  SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS bit, count(*) OVER () AS m
  FROM (SELECT DISTINCT feature FROM inner_nodes)
),
sets AS (SELECT unnest(range(0, 1 << (SELECT coalesce(max(m), 0) FROM players))) AS s),
parts AS (
  SELECT doc_id, leaf, s, any_value(worth)
         * product(CASE WHEN (s >> bit) & 1 = 0 THEN share
                        WHEN ({_value('feature')} <= threshold) = goes_left THEN 1.0e0 ELSE 0.0e0 END) AS v
  FROM inputs, steps JOIN players USING (feature), sets GROUP BY doc_id, leaf, s
),
worths AS MATERIALIZED (SELECT doc_id, s, sum(v) AS v FROM parts GROUP BY doc_id, s)"""
)

ORACLES: dict[str, str] = {
    "category_distribution": """
SELECT lang, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share
FROM documents GROUP BY lang""",
    "label_by_category": """
SELECT lang, quality, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY lang, quality""",
    "drill_down": """
SELECT lang, source, CAST(grouping(lang, source) AS INTEGER) AS gid, count(*) AS n,
       CAST(sum(n_chars) AS BIGINT) AS chars
FROM documents GROUP BY ROLLUP (lang, source)""",
    "cross_filter": """
WITH d AS (SELECT lang, quality FROM documents JOIN labels USING (doc_id))
SELECT 'lang' AS chart, lang AS key, count(*) AS n FROM d WHERE quality = 1 GROUP BY lang
UNION ALL
SELECT 'quality', CAST(quality AS VARCHAR), count(*) FROM d WHERE lang = 'en' GROUP BY quality""",
    "regex_search": r"""
SELECT doc_id, lang, n_chars FROM documents WHERE regexp_matches(text, '(?i)\bthe\s+\w+ing\b')""",
    "top_words": r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 50""",
    "log_stats": """
SELECT event_type, count(value) AS n, min(value) AS min, max(value) AS max,
       round(avg(value), 6) AS avg, round(stddev_samp(value), 6) AS sd,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.95), 6) AS p95
FROM events GROUP BY event_type""",
    "etl_daily": """
SELECT CAST(ts AS DATE) AS dt, event_type, count(*) AS n, count(DISTINCT user_id) AS users,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM events GROUP BY ALL""",
    "etl_store": f"""
WITH {CLEAN}
SELECT CAST(ts AS DATE) AS dt, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM clean GROUP BY ALL""",
    "clean_log": f"WITH {CLEAN} SELECT event_id, ts, user_id, event_type, value, props, k FROM clean",
    "deidentify": """
SELECT sha256('review-log' || CAST(user_id AS VARCHAR)) AS user_token, count(*) AS n
FROM events GROUP BY user_id""",
    "mask_text": r"""
SELECT doc_id, regexp_replace(
  regexp_replace(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z]+', '<email>', 'g'),
  '\+?\d[\d ()-]{7,}\d', '<phone>', 'g') AS text
FROM documents""",
    "user_features": """
SELECT user_id, count(*) AS n,
       count(*) FILTER (event_type = 'click') AS n_click,
       count(*) FILTER (event_type = 'error') AS n_error,
       count(*) FILTER (event_type = 'purchase') AS n_purchase,
       count(*) FILTER (event_type = 'signup') AS n_signup,
       count(*) FILTER (event_type = 'view') AS n_view,
       count(DISTINCT CAST(ts AS DATE)) AS active_days,
       round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value), 6) AS mean_value,
       round(count(*) FILTER (hour(ts) < 6) / count(*), 6) AS night_share
FROM events GROUP BY user_id""",
    "sessionize": f"""
WITH {SESSIONS}
SELECT * FROM sessions
UNION ALL SELECT event_id, ts, user_id, event_type, value, props, NULL
FROM events WHERE user_id IS NULL OR ts IS NULL""",
    "session_summary": SESSION_SUMMARY,
    "retry_numbers": f"""
WITH {ATTEMPTS}
SELECT user_id, dt, ts, event_id, ok, attempt,
       CASE WHEN NOT ok THEN least(60.0e0, pow(2.0e0, attempt - 1)) END AS delay_s
FROM attempts""",
    "retry_ledger": f"""
WITH {ATTEMPTS},
firsts AS (
  SELECT *, min(CASE WHEN ok THEN attempt END) OVER (PARTITION BY user_id, dt) AS first_ok
  FROM attempts
),
tasks AS (
  SELECT user_id, dt, count(*) AS attempts, count(*) FILTER (NOT ok) AS failures,
         bool_or(ok) AS done
  FROM firsts WHERE first_ok IS NULL OR attempt <= first_ok GROUP BY user_id, dt
),
states AS (
  SELECT *, CASE WHEN failures >= 3 THEN 'dlq' WHEN done THEN 'ok' ELSE 'pending' END AS status
  FROM tasks
)
SELECT user_id, dt, attempts, failures, status,
       CASE WHEN status = 'pending' THEN least(60.0e0, pow(2.0e0, failures - 1)) END AS next_delay_s
FROM states""",
    "dlq_split": DLQ,
    # The key words of the log filter, and the fields and codes of the status further below.
    "log_filter": """
SELECT line FROM (SELECT trim(event_type || ': ' || props, E' \\t\\r\\n') AS line FROM events)
WHERE line <> '' AND (contains(line, 'Error') OR contains(line, 'error') OR contains(line, 'WARNING')
  OR contains(line, 'ERROR') OR contains(line, 'started') OR contains(line, 'listening'))""",
    "format_compare": """
SELECT format, (SELECT count(*) FROM events) AS rows, true AS same
FROM (VALUES ('csv'), ('json'), ('parquet'), ('orc')) AS formats(format)""",
    "csv_roundtrip": f"""
WITH {DIRTY}
SELECT TRY_CAST(value AS DOUBLE) IS NULL OR TRY_CAST(event_id AS BIGINT) IS NULL
       OR TRY_CAST(ts AS TIMESTAMP) IS NULL AS corrupt, count(*) AS n
FROM dirty GROUP BY ALL""",
    "replay_cap": """
SELECT event_id, ts, user_id, event_type, value, props FROM events ORDER BY ts, event_id LIMIT 6000""",
    "stream_replay": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_label": """
SELECT event_id, CAST(event_type = 'error' OR value > 250 AS INTEGER) AS prediction FROM events""",
    "stream_dead_letters": DLQ,
    "dead_letters": f"""
{MARKED},
{CLEAN.removeprefix(DIRTY).removeprefix(",")},
attempts AS (
  SELECT *, CAST(ts AS DATE) AS dt, event_type <> 'error' AS ok,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS attempt
  FROM clean
),
firsts AS (
  SELECT *, min(CASE WHEN ok THEN attempt END) OVER (PARTITION BY user_id, dt) AS first_ok FROM attempts
),
failures AS (
  SELECT *, count(*) OVER (PARTITION BY user_id, dt) AS n FROM firsts
  WHERE NOT ok AND (first_ok IS NULL OR attempt < first_ok)
),
dead AS (
  SELECT reason, event_id, ts, user_id, event_type, value, props, 1 AS attempt FROM marked WHERE reason <> ''
  UNION ALL
  SELECT 'out_of_retries', CAST(event_id AS VARCHAR), CAST(ts AS VARCHAR), CAST(user_id AS VARCHAR), event_type,
         CAST(value AS VARCHAR), props, attempt
  FROM failures WHERE n >= 3
)
SELECT reason, CAST(attempt AS BIGINT) AS attempt,
       {PAYLOAD} AS payload
FROM dead""",
    "stream_retry": f"""
{MARKED},
needed AS (
  SELECT *, CASE WHEN trim(event_type) = 'error' THEN CAST(TRY_CAST(event_id AS BIGINT) % 5 + 1 AS INTEGER) ELSE 1 END AS needs
  FROM marked
),
ended AS (
  SELECT *, CASE WHEN reason <> '' THEN reason WHEN needs > 3 THEN 'out_of_retries' ELSE '' END AS why FROM needed
)
SELECT event_id, CASE WHEN why = '' THEN 'ok' ELSE 'dead' END AS status, why AS reason,
       CAST(CASE WHEN reason <> '' THEN 1 ELSE least(needs, 3) END AS INTEGER) AS attempt,
       CASE WHEN why <> '' THEN {PAYLOAD} END AS payload
FROM ended""",
    "live_feed": """
WITH reviews AS (SELECT lang, quality FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'category' AS chart, lang AS key, CAST(NULL AS INTEGER) AS label, count(*) AS n,
       round(count(*) / (SELECT count(*) FROM reviews), 6) AS share
FROM reviews GROUP BY lang
UNION ALL
SELECT 'label', lang, quality, count(*), NULL FROM reviews WHERE quality IS NOT NULL GROUP BY lang, quality""",
    "live_activity": """
WITH newest AS (SELECT max(ts) AS ts FROM events WHERE event_id % 41 <> 0),
timed AS (
  SELECT CAST(events.ts AS DATE) AS dt, event_type,
         event_id % 41 = 0 AND CAST(events.ts AS DATE) + INTERVAL 1 DAY <= newest.ts - INTERVAL 2 DAY AS late
  FROM events, newest
)
SELECT dt, event_type, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS late FROM timed GROUP BY ALL""",
    "stream_sessions": SESSION_SUMMARY,
    "stream_sessions_late": """
SELECT user_id, count(*) AS events,
       count(*) FILTER (event_id % 41 = 0 AND ts < (SELECT max(ts) FROM events) - INTERVAL 5 DAY) AS late
FROM events WHERE user_id IS NOT NULL GROUP BY user_id""",
    "stream_model_label": "SELECT event_id, CAST(value >= 250 AS INTEGER) AS prediction FROM events",
    "reviews": """
SELECT lang AS category, quality AS label, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars
FROM documents JOIN labels USING (doc_id) GROUP BY ALL""",
    "rf_check": FOLDS,
    "gbt_check": FOLDS,
    "ablation_check": """
SELECT concat_ws('+', CASE WHEN a THEN 'digits' END, CASE WHEN b THEN 'length' END,
                 CASE WHEN c THEN 'rules' END) AS subset, true AS valid
FROM (VALUES (false), (true)) x(a), (VALUES (false), (true)) y(b), (VALUES (false), (true)) z(c)""",
    "rule_features": f"WITH {RULES} SELECT doc_id, email, phone, licence, symbols, score FROM rules",
    "indexed_search": r"""
SELECT CAST(pattern AS INTEGER) AS pattern, doc_id
FROM (SELECT doc_id, unnest(range(0, 5)) AS pattern,
             unnest([regexp_matches(text, '(?i)\bthe\s+\w+ing\b'), regexp_matches(text, '(?i)licen[sc]e\b'),
                     regexp_matches(text, '[0-9]{3}-[0-9]{4}'), regexp_matches(text, '\.\s+The\s'),
                     regexp_matches(text, 'copyright|[%*#]{3,}')]) AS hit
      FROM documents)
WHERE hit""",
    "rule_table": rf"""
WITH {RULES},
words AS (
  SELECT DISTINCT word
  FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+')) AS word FROM documents)
  WHERE regexp_full_match(word, '[a-z]{{7,}}') ORDER BY md5(word), word LIMIT 200
)
SELECT doc_id, rule_id, weight
FROM (SELECT doc_id, unnest(['email', 'phone', 'licence', 'symbols']) AS rule_id,
             unnest([1.0e0, 1.0e0, 0.5e0, 2.0e0]) AS weight, unnest([email, phone, licence, symbols]) AS hit FROM rules)
WHERE hit = 1
UNION ALL
SELECT doc_id, 'word:' || word, 0.1e0 FROM documents, words WHERE regexp_matches(text, word || '[^a-z]')""",
    "balanced_sample": """
SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id)
        <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality))""",
    "feature_sample": """
SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 200""",
    "feature_fusion": f"""
WITH {RULES}, {NUMBERS}
SELECT doc_id, quality, toxic, n_chars, n_words, n_digits, email, phone, licence, symbols, score
FROM labels JOIN numbers USING (doc_id) JOIN rules USING (doc_id)""",
    "char_tfidf": f"""
{GRAMS}
SELECT doc_id, gram, tf, round(tf * idf, 6) AS tfidf
FROM counts JOIN weights USING (gram)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(tf * idf, 6) DESC, gram) <= 20""",
    "tfidf_vectors": f"""
{GRAMS},
vocabulary AS (
  SELECT gram, idf, row_number() OVER (ORDER BY df DESC, encode(gram)) - 1 AS index FROM weights
  QUALIFY index < 4096
)
SELECT doc_id, CAST(index AS INTEGER) AS index, round(tf * idf, 6) AS weight FROM counts JOIN vocabulary USING (gram)""",
    "class_weights": """
SELECT quality, count(*) AS n,
       round((SELECT count(quality) FROM labels)
             / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS w
FROM labels WHERE quality IS NOT NULL GROUP BY quality""",
    "cell_ablation": f"WITH {CELLS} SELECT subset, round(metric, 6) AS metric FROM coalitions",
    "group_shapley": f"""
WITH {CELLS}
SELECT 'category' AS grp, {_phi('a', 'b', 'c')} AS phi
UNION ALL SELECT 'length', {_phi('b', 'a', 'c')}
UNION ALL SELECT 'rules', {_phi('c', 'a', 'b')}""",
    "linear_shap": f"""
WITH {NUMBERS},
means AS (SELECT avg(n_chars) AS c, avg(n_words) AS w, avg(n_digits) AS d FROM numbers)
SELECT doc_id, 'n_chars' AS feature, round(0.001e0 * (n_chars - c), 6) AS phi FROM numbers, means
UNION ALL SELECT doc_id, 'n_words', round(-0.25e0 * (n_words - w), 6) FROM numbers, means
UNION ALL SELECT doc_id, 'n_digits', round(0.5e0 * (n_digits - d), 6) FROM numbers, means""",
    "best_split": f"""
WITH {INPUTS}, {_split_level(0)}
SELECT s.feature, s.threshold, s.gain, s.n, s.p AS positive, s.nl AS n_left, s.pl AS positive_left,
       row_number() OVER (ORDER BY s.gain DESC, s.feature) = 1 AS best
FROM splits_0 s""",
    "split_tree": f"""
WITH {TREE}
SELECT CAST(nodes.node AS INTEGER) AS node, feature, threshold, gain, nodes.n, nodes.p AS positive
FROM nodes LEFT JOIN inner_nodes USING (node)""",
    "tree_shap": f"""
WITH {TREE_GAME}
SELECT a.doc_id, feature,
       round(sum((b.v - a.v) * factorial(CAST(bit_count(a.s) AS INTEGER))
                 * factorial(CAST(m - bit_count(a.s) - 1 AS INTEGER)) / factorial(CAST(m AS INTEGER))), 6) AS phi
FROM worths a JOIN players ON (a.s >> bit) & 1 = 0
JOIN worths b ON b.doc_id = a.doc_id AND b.s = a.s + (1 << bit)
GROUP BY a.doc_id, feature""",
    # With all features known, a document's worth is that of its own leaf.
    "stream_tree_score": f"""
WITH {TREE_GAME}
SELECT doc_id, round(v, 6) AS score FROM worths WHERE s = (SELECT (1 << max(m)) - 1 FROM players)""",
    "boosted_shap_check": "SELECT doc_id, true AS adds_up FROM documents",
    "rank_auc": f"""
WITH {NUMBERS},
scored AS (
  SELECT lang, quality, numbers.n_chars * 0.001e0 + n_words * (-0.25e0) + n_digits * 0.5e0 AS score
  FROM numbers JOIN documents USING (doc_id) JOIN labels USING (doc_id) WHERE quality IN (0, 1)
),
grouped AS (SELECT lang AS grp, quality, score FROM scored UNION ALL SELECT '(all)', quality, score FROM scored),
ranked AS (
  SELECT grp, quality,
         rank() OVER (PARTITION BY grp ORDER BY score) + (count(*) OVER (PARTITION BY grp, score) - 1) / 2.0e0 AS r
  FROM grouped
)
SELECT grp, count(*) FILTER (quality = 1) AS n_positive, count(*) FILTER (quality = 0) AS n_negative,
       CASE WHEN n_positive * n_negative > 0
            THEN round((sum(r) FILTER (quality = 1) - n_positive * (n_positive + 1) / 2.0e0) / (n_positive * n_negative), 9)
       END AS auc
FROM ranked GROUP BY grp""",
    "system_status": """
SELECT 'degraded' AS status, false AS llm_active, 'API_KEY_MISSING' AS reason,
       count(*) > 0 AS data_files_available, count(*) AS record_count
FROM documents""",
    "system_status_active": f"""
WITH keys AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{k}', {v})" for i, (k, v) in enumerate(zip(KEY_NAMES, STATES)))}) t(i, name, value)),
state AS (
  SELECT count(*) FILTER (coalesce(value, '') <> '') > 0 AS active,
         coalesce(string_agg(name, ', ' ORDER BY i) FILTER (coalesce(value, '') = ''), '') AS missing
  FROM keys
)
SELECT CASE WHEN active THEN 'ok' ELSE 'degraded' END AS status, active AS llm_active,
       CASE WHEN NOT active THEN 'API_KEY_MISSING' END AS reason,
       (SELECT count(*) FROM documents) > 0 AS data_files_available,
       (SELECT count(*) FROM documents) AS record_count, missing
FROM state""",
    "system_status_json": """
SELECT '{"status":"degraded","llm_active":false,"reason":"API_KEY_MISSING",'
       || '"data_files_available":' || CAST(count(*) > 0 AS VARCHAR)
       || ',"record_count":' || CAST(count(*) AS VARCHAR) || '}' AS payload
FROM documents""",
}
