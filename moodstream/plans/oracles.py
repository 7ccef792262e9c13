"""ANSI/DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

LABELS = """
labels_named AS (
  SELECT doc_id,
         CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS emotion
  FROM labels
)"""

SCORED = """
scored AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_name, event_type,
         CASE event_type WHEN 'error' THEN 2.0::DOUBLE WHEN 'view' THEN 0.0::DOUBLE
              WHEN 'click' THEN 0.0::DOUBLE WHEN 'purchase' THEN 1.0::DOUBLE
              WHEN 'signup' THEN 1.0::DOUBLE END AS prediction,
         CASE event_type WHEN 'error' THEN 'negative' WHEN 'view' THEN 'neutral'
              WHEN 'click' THEN 'neutral' WHEN 'purchase' THEN 'positive'
              WHEN 'signup' THEN 'positive' END AS class
  FROM events
)"""

COUNTERS = """
  count(*) FILTER (WHERE class = 'positive') AS positive,
  count(*) FILTER (WHERE class = 'negative') AS negative,
  count(*) FILTER (WHERE class = 'neutral') AS neutral"""

HOURLY = f"""{SCORED},
hourly AS (SELECT date_trunc('hour', ts) AS batch, {COUNTERS} FROM scored GROUP BY 1),
running AS (
  SELECT batch,
         CAST(sum(positive) OVER w AS BIGINT) AS positive,
         CAST(sum(negative) OVER w AS BIGINT) AS negative,
         CAST(sum(neutral) OVER w AS BIGINT) AS neutral
  FROM hourly WINDOW w AS (ORDER BY batch ROWS UNBOUNDED PRECEDING)
)"""

SPACE = r"[ \t\n\x0B\f\r]"
NON_WORD = "[^a-zA-Z0-9_]"
STOP_WORDS = "('http', 'https', 'amp', 'rt', 't', 'c', 'the')"
PHRASES_2 = "('in the', 'of the', 'to the', 'and the')"
PHRASES_3 = "('a in the')"


def _tokens(pattern: str) -> str:
    return f"list_filter(string_split_regex(lower(text), '{pattern}'), lambda x: len(x) >= 1)"


WORDS_PLAIN = f"list_filter({_tokens(NON_WORD)}, lambda y: y NOT IN {STOP_WORDS})"


def _token_rows(words: str) -> str:
    return (
        f"WITH t AS (SELECT doc_id, {words} AS w FROM documents) "
        "SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, array_to_string(w, ' ') AS tokens FROM t"
    )


PAIRS = f"""
pairs AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest({_tokens(SPACE)}) AS term FROM documents)
  GROUP BY ALL
),
stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_freq FROM pairs GROUP BY term),
weights AS (
  SELECT term, doc_freq,
         CASE WHEN doc_freq >= 2
              THEN ln(((SELECT count(text) FROM documents) + 1.0::DOUBLE) / (doc_freq + 1.0::DOUBLE))
              ELSE 0.0::DOUBLE END AS idf
  FROM stats
)"""

TFIDF = f"""WITH {PAIRS}
SELECT doc_id, term, tf, round(tf * idf, 6) AS tfidf FROM pairs JOIN weights USING (term)"""

# Murmur3 of every term's bytes: whole words of four, then the rest as one word.
HASHED = f"""
spelt AS (
  SELECT term, hex(encode(term)) AS x, octet_length(encode(term)) AS size
  FROM (SELECT DISTINCT unnest({_tokens(SPACE)}) AS term FROM documents)
),
numbers AS (
  SELECT term, size,
         list_transform(range(size // 4), lambda i: CAST('0x' || substr(x, 8 * i + 7, 2) || substr(x, 8 * i + 5, 2) || substr(x, 8 * i + 3, 2)
                                                    || substr(x, 8 * i + 1, 2) AS HUGEINT)) AS w,
         CAST('0x0' || substr(x, 8 * (size // 4) + 5, 2) || substr(x, 8 * (size // 4) + 3, 2) || substr(x, 8 * (size // 4) + 1, 2) AS HUGEINT) AS rest
  FROM spelt
),
first AS (
  SELECT term, size, list_transform(list_append(w, rest), lambda k: CAST(k * 3432918353 % 4294967296 AS BIGINT)) AS w FROM numbers
),
mixed AS (
  SELECT term, size, list_transform(w, lambda k: CAST(CAST(((k << 15) & 4294967295) | (k >> 17) AS HUGEINT) * 461845907 % 4294967296 AS BIGINT)) AS w FROM first
),
chained AS (
  SELECT term, xor(xor(list_reduce(list_prepend(42, w[1:len(w) - 1]),
    lambda h, k: ((((xor(h, k) << 13) & 4294967295) | (xor(h, k) >> 19)) * 5 + 3864292196) & 4294967295), w[len(w)]), size) AS h
  FROM mixed
),
end1 AS (SELECT term, CAST(CAST(xor(h, h >> 16) AS HUGEINT) * 2246822507 % 4294967296 AS BIGINT) AS h FROM chained),
end2 AS (SELECT term, CAST(CAST(xor(h, h >> 13) AS HUGEINT) * 3266489909 % 4294967296 AS BIGINT) AS h FROM end1),
end3 AS (SELECT term, xor(h, h >> 16) AS h FROM end2),
term_buckets AS (
  SELECT term, CAST(((CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) % 8000 + 8000) % 8000 AS INTEGER) AS bucket FROM end3
),
hashed AS (
  SELECT doc_id, bucket, CAST(count(*) AS DOUBLE) AS tf
  FROM (SELECT doc_id, unnest({_tokens(SPACE)}) AS term FROM documents) JOIN term_buckets USING (term) GROUP BY ALL
)"""

BUCKET = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100"

# Multinomial Naive Bayes with smoothing 1 on counts of terms found in at least 5 training documents.
NB = f"""{LABELS},
plain AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest({WORDS_PLAIN}) AS term FROM documents)
  GROUP BY ALL
),
train AS (SELECT l.doc_id, l.emotion FROM labels_named l JOIN documents d USING (doc_id) WHERE {BUCKET} < 80),
vocab AS (
  SELECT term FROM plain JOIN train USING (doc_id)
  GROUP BY term HAVING count(*) >= 5 ORDER BY sum(tf) DESC, term LIMIT 30000
),
classes AS (
  SELECT emotion, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, emotion) AS position
  FROM train GROUP BY emotion
),
class_terms AS (
  SELECT emotion, term, sum(tf) AS n
  FROM plain JOIN train USING (doc_id) JOIN vocab USING (term) GROUP BY ALL
),
sizes AS (SELECT c.emotion, coalesce(sum(t.n), 0) AS n FROM classes c LEFT JOIN class_terms t USING (emotion) GROUP BY ALL),
theta AS (
  SELECT v.term, c.emotion,
         ln(coalesce(t.n, 0) + 1.0::DOUBLE) - ln(s.n + (SELECT count(*) FROM vocab) * 1.0::DOUBLE) AS weight
  FROM vocab v CROSS JOIN classes c
  JOIN sizes s USING (emotion)
  LEFT JOIN class_terms t ON t.term = v.term AND t.emotion = c.emotion
),
evidence AS (
  SELECT p.doc_id, t.emotion, sum(p.tf * t.weight) AS weight
  FROM plain p JOIN theta t USING (term) GROUP BY ALL
),
raw AS (
  SELECT d.doc_id, c.emotion, c.position,
         coalesce(e.weight, 0) + ln(c.n + 1.0::DOUBLE)
           - ln((SELECT sum(n) + count(*) FROM classes) * 1.0::DOUBLE) AS weight
  FROM documents d CROSS JOIN classes c
  LEFT JOIN evidence e ON e.doc_id = d.doc_id AND e.emotion = c.emotion
),
best AS (SELECT doc_id, max(weight) AS top FROM raw GROUP BY doc_id),
predicted AS (
  SELECT doc_id, arg_min(emotion, position) FILTER (WHERE weight = top) AS predicted,
         1.0::DOUBLE / sum(exp(weight - top)) AS confidence
  FROM raw JOIN best USING (doc_id) GROUP BY doc_id
),
judged AS (
  SELECT l.emotion AS actual, p.predicted
  FROM labels_named l JOIN predicted p USING (doc_id) WHERE {BUCKET} >= 80
),
cells AS (SELECT actual, predicted, count(*) AS n FROM judged GROUP BY ALL)"""

FOLD = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 3"

# Features come from all training rows; each fold is judged by a model of the other two.
CROSS_VALIDATE_NB = f"""WITH {LABELS},
plain AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest({WORDS_PLAIN}) AS term FROM documents)
  GROUP BY ALL
),
rows AS (SELECT l.doc_id, l.emotion, {FOLD} AS fold FROM labels_named l JOIN documents d USING (doc_id) WHERE {BUCKET} < 80),
ranks AS (SELECT emotion, row_number() OVER (ORDER BY count(*) DESC, emotion) AS position FROM rows GROUP BY emotion),
vocab AS (
  SELECT term FROM plain JOIN rows USING (doc_id)
  GROUP BY term HAVING count(*) >= 5 ORDER BY sum(tf) DESC, term LIMIT 30000
),
counted AS (SELECT r.doc_id, r.emotion, r.fold, p.term, p.tf FROM plain p JOIN rows r USING (doc_id) JOIN vocab USING (term)),
settings AS (SELECT unnest([0.5::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE]) AS smoothing),
folds AS (SELECT DISTINCT fold FROM rows),
per_class AS (
  SELECT f.fold, c.emotion, c.position, count(r.doc_id) AS n
  FROM folds f CROSS JOIN ranks c LEFT JOIN rows r ON r.emotion = c.emotion AND r.fold <> f.fold GROUP BY ALL
),
class_terms AS (
  SELECT f.fold, c.emotion, c.term, sum(c.tf) AS n FROM folds f JOIN counted c ON c.fold <> f.fold GROUP BY ALL
),
sizes AS (SELECT fold, emotion, sum(n) AS n FROM class_terms GROUP BY ALL),
evidence AS (
  SELECT s.smoothing, t.doc_id, c.emotion,
         sum(t.tf * (ln(coalesce(k.n, 0) + s.smoothing) - ln(z.n + (SELECT count(*) FROM vocab) * s.smoothing))) AS weight
  FROM counted t CROSS JOIN settings s JOIN per_class c ON c.fold = t.fold
  JOIN sizes z ON z.fold = t.fold AND z.emotion = c.emotion
  LEFT JOIN class_terms k ON k.fold = t.fold AND k.emotion = c.emotion AND k.term = t.term
  GROUP BY ALL
),
raw AS (
  SELECT s.smoothing, r.doc_id, r.fold, r.emotion AS actual, c.emotion, c.position,
         coalesce(e.weight, 0) + ln(c.n + s.smoothing)
           - ln((SELECT sum(n) FROM per_class x WHERE x.fold = r.fold) + (SELECT count(*) FROM ranks) * s.smoothing) AS weight
  FROM rows r CROSS JOIN settings s JOIN per_class c ON c.fold = r.fold
  LEFT JOIN evidence e ON e.smoothing = s.smoothing AND e.doc_id = r.doc_id AND e.emotion = c.emotion
),
predicted AS (
  SELECT smoothing, fold, doc_id, actual, arg_max(emotion, (weight, -position)) AS predicted FROM raw GROUP BY ALL
),
cells AS (SELECT smoothing, fold, actual, predicted, count(*) AS n FROM predicted GROUP BY ALL),
sides AS (
  SELECT smoothing, fold, actual AS class, n AS support, 0 AS claimed, CASE WHEN actual = predicted THEN n ELSE 0 END AS hit FROM cells
  UNION ALL SELECT smoothing, fold, predicted, 0, n, 0 FROM cells
),
judged AS (
  SELECT smoothing, fold, class, sum(support) AS support, 2.0::DOUBLE * sum(hit) / (sum(support) + sum(claimed)) AS f1
  FROM sides GROUP BY ALL
),
per_fold AS (SELECT smoothing, fold, sum(f1 * support) / sum(support) AS f1 FROM judged GROUP BY ALL)
SELECT smoothing, round(avg(f1), 6) AS f1 FROM per_fold GROUP BY smoothing"""

NB_PREDICT = f"WITH {NB} SELECT doc_id, predicted, round(confidence, 6) AS confidence FROM predicted"

# Weights of buckets from the training part; a bucket that no training row has weighs nothing.
HASHED_TFIDF = f"""{LABELS},{HASHED},
train AS (SELECT doc_id, emotion FROM labels_named JOIN documents USING (doc_id) WHERE text IS NOT NULL AND {BUCKET} < 80),
bucket_weights AS (
  SELECT bucket, CASE WHEN count(*) >= 2 THEN ln(((SELECT count(*) FROM train) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) ELSE 0.0::DOUBLE END AS idf
  FROM hashed JOIN train USING (doc_id) GROUP BY bucket
),
weighed AS (SELECT doc_id, bucket, tf * coalesce(idf, 0.0::DOUBLE) AS tfidf FROM hashed LEFT JOIN bucket_weights USING (bucket))"""

HASHING_TF = f"WITH {HASHED} SELECT doc_id, bucket, tf FROM hashed"

LINES_OF_TURNS = """
lines AS (
  SELECT conv_id, turn, role, CAST(pos - 1 AS INTEGER) AS pos, line
  FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM conversations)
),
items AS (
  SELECT conv_id, turn, pos, role, line,
         CASE WHEN length(line) % 4 <> 3 THEN CAST(length(line) % 4 AS DOUBLE) END AS prediction
  FROM lines
)"""

UNION_BY_NAME = """
SELECT doc_id, lang, text, NULL::BIGINT AS conv_id, NULL::VARCHAR AS role FROM documents
UNION ALL
SELECT NULL, NULL, text, conv_id, role FROM conversations"""

NEGATIVE_USERS = f'WITH {SCORED} SELECT user_name AS "UserID" FROM scored WHERE class = \'negative\''

JSON_ROW = (
    "'{\"UserID\":\"' || user_name || '\",\"Sentence\":\"' || event_type || '\"' || "
    "coalesce(',\"prediction\":' || CAST(prediction AS VARCHAR), '') || '}'"
)

JSON_CLASS_ROW = f"""left({JSON_ROW}, length({JSON_ROW}) - 1) || coalesce(',"class":"' || class || '"', '') || '}}'"""

FLATTENED = """SELECT doc_id AS id, text AS "desc", source AS "author_uniqueId", lang AS author_region,
       n_chars AS "stats_charCount" FROM documents"""

USER_TOTALS = f"""WITH {SCORED}
SELECT count(*) AS comments_total,
       count(*) FILTER (WHERE class = 'positive') AS comments_positive,
       count(*) FILTER (WHERE class = 'negative') AS comments_negative,
       count(*) FILTER (WHERE class = 'neutral') AS comments_neutral,
       count(DISTINCT user_name) AS users_total,
       count(DISTINCT user_name) FILTER (WHERE class = 'positive') AS users_positive,
       count(DISTINCT user_name) FILTER (WHERE class = 'negative') AS users_negative,
       count(DISTINCT user_name) FILTER (WHERE class = 'neutral') AS users_neutral
FROM scored WHERE class IS NOT NULL"""

LATEST = f"""WITH {SCORED}
SELECT class, event_id, ts, user_name AS "UserID", event_type AS "Sentence", CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY ts DESC, event_id DESC) AS rank
      FROM scored WHERE class IS NOT NULL) WHERE rank <= 13"""

VOCABULARY = f"""WITH plain AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest({WORDS_PLAIN}) AS term FROM documents) GROUP BY ALL)
SELECT term, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_freq FROM plain
GROUP BY term HAVING count(*) >= 5 ORDER BY term_count DESC, term LIMIT 30000"""

MERGED = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text, NULL::VARCHAR AS conv_id,
       NULL::VARCHAR AS role FROM documents
UNION ALL SELECT NULL, NULL, text, CAST(conv_id AS VARCHAR), role FROM conversations"""

ORACLES: dict[str, str] = {
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}"
        for t in ("documents", "labels", "conversations", "events")
    ),
    "class_distribution": f"""WITH {LABELS}
SELECT emotion AS "Emotion", count(*) AS n FROM labels_named JOIN documents USING (doc_id)
GROUP BY 1 ORDER BY n DESC, 1""",
    "bag_union": """SELECT source AS "UserID", text AS "Sentence" FROM documents
UNION ALL SELECT role, text FROM conversations""",
    "union_by_name": UNION_BY_NAME,
    "drop_incomplete": """SELECT doc_id, lang, n_chars, quality, toxic
FROM documents LEFT JOIN labels USING (doc_id)
WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND n_chars IS NOT NULL
  AND quality IS NOT NULL AND toxic IS NOT NULL""",
    "present_label": """SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
WHERE quality IS NOT NULL""",
    "projection": f'WITH {SCORED} SELECT event_id, event_type AS "Sentence", prediction FROM scored',
    "constant_column": 'SELECT doc_id, source AS "UserID", 0 AS "Emotion" FROM documents',
    "stable_row_id": "SELECT role, conv_id || '/' || turn AS uid FROM conversations",
    "row_id": "SELECT count(*) AS n_rows, count(*) AS n_ids FROM events",
    "other_than_neutral": f"WITH {SCORED} SELECT event_id, prediction FROM scored WHERE prediction <> 0",
    "route_classes": f"WITH {SCORED} SELECT event_id, prediction, class FROM scored WHERE class IS NOT NULL",
    "label_recode": f"""WITH {LABELS}
SELECT doc_id, CASE emotion WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 WHEN 'positive' THEN 1 END AS label
FROM labels_named""",
    "clock_labels": "SELECT event_id, strftime(ts, '%H:%M:%S') AS time_label FROM events",
    "page_names": """SELECT doc_id, 'rawdata_' || CAST(doc_id // 10 + 51 AS VARCHAR) || '.csv' AS page
FROM documents""",
    "strip_mentions": r"SELECT doc_id, regexp_replace(text, '@[\p{L}\p{N}_]+', '', 'g') AS text FROM documents",
    "clean_comments": """SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN ' ' || text || ' @!' ELSE text END AS text
FROM conversations""",
    "repair_encoding": "SELECT doc_id, text FROM documents",
    "decode_bytes": "SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 THEN text END AS text FROM conversations",
    "parse_message": """SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, source AS "UserID", line AS "Sentence"
FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)""",
    "parse_double_encoded": f"""WITH {LINES_OF_TURNS}
SELECT conv_id, turn, pos, role AS "UserID", line AS "Sentence", prediction,
       CASE prediction WHEN 0 THEN 'neutral' WHEN 1 THEN 'positive' WHEN 2 THEN 'negative' END AS class FROM items""",
    "message_class_counts": f"""WITH {LINES_OF_TURNS}
SELECT conv_id, turn, count(*) FILTER (WHERE prediction = 1) AS positive,
       count(*) FILTER (WHERE prediction = 2) AS negative, count(*) FILTER (WHERE prediction = 0) AS neutral
FROM items GROUP BY conv_id, turn""",
    "unnest_comments": """SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, line
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)""",
    "extract_field": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "flatten_record": FLATTENED,
    "flattened_csv": FLATTENED,
    "flatten_schema_free": """SELECT doc_id AS id, text AS "desc", source AS "author_uniqueId", lang AS author_lang,
       CASE WHEN doc_id % 3 <> 0 THEN n_chars END AS "stats_charCount", CASE WHEN doc_id % 3 <> 0 THEN '["' || lang || '"]' END AS stats_langs,
       CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE '"' || lang || '"' END AS tag FROM documents""",
    "scored_to_json": f"WITH {SCORED} SELECT event_id, {JSON_ROW} AS json FROM scored",
    "topic_payload": f"""WITH {SCORED}
SELECT user_name AS key,
       '{{"comments":["' || replace({JSON_CLASS_ROW}, '"', chr(92) || '"') || '"]}}' AS value FROM scored""",
    "class_counts_by_batch": f"WITH {HOURLY} SELECT * FROM hourly",
    "running_totals": f"WITH {HOURLY} SELECT * FROM running",
    "snapshots_last10": f"""WITH {HOURLY}
SELECT *, strftime(batch, '%H:%M:%S') AS time_label FROM running ORDER BY batch DESC LIMIT 10""",
    "grand_totals": f"WITH {SCORED} SELECT count(class) AS total, {COUNTERS} FROM scored",
    "user_totals": USER_TOTALS,
    "user_totals_close": f"""WITH {SCORED}
SELECT class, count(*) AS comments, true AS is_close FROM scored WHERE class IS NOT NULL GROUP BY class""",
    "running_users": f"""WITH {SCORED},
hours AS (SELECT date_trunc('hour', ts) AS batch, class, user_name FROM scored WHERE class IS NOT NULL),
seen AS (SELECT class, user_name, min(batch) AS batch FROM hours GROUP BY ALL),
new AS (SELECT class, batch, count(user_name) AS n FROM seen GROUP BY ALL),
every AS (SELECT class, batch, count(*) AS n FROM hours GROUP BY ALL)
SELECT e.batch, e.class, CAST(sum(e.n) OVER w AS BIGINT) AS comments, CAST(sum(coalesce(new.n, 0)) OVER w AS BIGINT) AS users, true AS within
FROM every e LEFT JOIN new ON new.class = e.class AND new.batch = e.batch
WINDOW w AS (PARTITION BY e.class ORDER BY e.batch ROWS UNBOUNDED PRECEDING)""",
    "class_share": f"""WITH {SCORED}
SELECT class, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 1) AS pct
FROM scored WHERE class IS NOT NULL GROUP BY class""",
    "latest13_per_class": LATEST,
    "stream_latest13": LATEST,
    "cap_children": """SELECT conv_id, turn, role, text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) WHERE rn <= 5""",
    "take_first": f"""WITH {SCORED}
SELECT event_id, user_name AS "UserID", event_type AS "Sentence" FROM scored ORDER BY event_id LIMIT 5""",
    "negative_users": NEGATIVE_USERS,
    "negative_user_counts": f"""WITH {SCORED}
SELECT user_name AS "UserID", count(*) AS n FROM scored WHERE class = 'negative' GROUP BY 1""",
    "join_predictions": f"""WITH {SCORED}
SELECT user_name AS "UserID", event_type AS "Sentence", prediction FROM scored""",
    "tokens_ws": _token_rows(_tokens(SPACE)),
    "tokens_nonword": _token_rows(_tokens(NON_WORD)),
    "stopwords_removed": _token_rows(WORDS_PLAIN),
    "stop_list_removed": f"""WITH {PAIRS},
stop AS (SELECT list(term) AS terms FROM (SELECT term FROM stats ORDER BY term_count DESC, term LIMIT 25)),
t AS (SELECT doc_id, list_filter({_tokens(SPACE)}, lambda x: NOT list_contains(terms, x)) AS w
      FROM documents CROSS JOIN stop)
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, array_to_string(w, ' ') AS tokens FROM t""",
    "stop_phrases_removed": f"""WITH words AS (SELECT doc_id, {_tokens(SPACE)} AS w FROM documents),
one AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM words),
next AS (
  SELECT doc_id, i, a, a || ' ' || lead(a) OVER o IN {PHRASES_2} AS two,
         a || ' ' || lead(a) OVER o || ' ' || lead(a, 2) OVER o IN {PHRASES_3} AS three
  FROM one WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
marked AS (
  SELECT doc_id, i, a, coalesce(two, false) OR coalesce(lag(two) OVER o, false)
         OR coalesce(three, false) OR coalesce(lag(three) OVER o, false) OR coalesce(lag(three, 2) OVER o, false) AS gone
  FROM next WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
kept AS (SELECT doc_id, count(*) AS n, string_agg(a, ' ' ORDER BY i) AS tokens FROM marked WHERE NOT gone GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens, coalesce(tokens, '') AS tokens
FROM documents LEFT JOIN kept USING (doc_id)""",
    "stop_phrases_listed": f"""WITH bench AS (SELECT {_tokens(SPACE)} AS w FROM benchmark),
listed AS (
  SELECT DISTINCT unnest(list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS phrase FROM bench
),
words AS (SELECT doc_id, {_tokens(SPACE)} AS w FROM documents),
one AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM words),
next AS (
  SELECT doc_id, i, a, a || ' ' || lead(a) OVER o AS two, a || ' ' || lead(a) OVER o || ' ' || lead(a, 2) OVER o AS three
  FROM one WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
hit AS (
  SELECT n.*, l2.phrase IS NOT NULL AS has2, l3.phrase IS NOT NULL AS has3
  FROM next n LEFT JOIN listed l2 ON l2.phrase = two LEFT JOIN listed l3 ON l3.phrase = three
),
marked AS (
  SELECT doc_id, i, a, has2 OR has3 OR coalesce(lag(has2) OVER o, false) OR coalesce(lag(has3) OVER o, false) OR coalesce(lag(has3, 2) OVER o, false) AS gone
  FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
kept AS (SELECT doc_id, count(*) AS n, string_agg(a, ' ' ORDER BY i) AS tokens FROM marked WHERE NOT gone GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens, coalesce(tokens, '') AS tokens
FROM documents LEFT JOIN kept USING (doc_id)""",
    "term_counts": f"WITH {PAIRS} SELECT * FROM stats",
    "vocab_min_df": VOCABULARY,
    "vocab_heavy": VOCABULARY,
    "idf": f"WITH {PAIRS} SELECT term, doc_freq, round(idf, 6) AS idf FROM weights",
    "tfidf": TFIDF,
    "tfidf_salted": TFIDF,
    "label_index": f"""WITH {LABELS}
SELECT emotion AS "Emotion", CAST(row_number() OVER (ORDER BY count(*) DESC, emotion) - 1 AS DOUBLE) AS label,
       count(*) AS n
FROM labels_named JOIN documents USING (doc_id) GROUP BY emotion""",
    "hash_split": f"SELECT doc_id, CASE WHEN {BUCKET} < 80 THEN 'train' ELSE 'test' END AS part FROM labels",
    "random_split": "SELECT count(DISTINCT doc_id) AS n_rows, CAST(1 AS BIGINT) AS n_parts, true AS as_asked FROM labels",
    "hashing_tf": HASHING_TF,
    "hashing_tf_columns": HASHING_TF,
    "hashed_tfidf": f"WITH {HASHED_TFIDF} SELECT doc_id, bucket, round(tfidf, 6) AS tfidf FROM weighed",
    "lr_certificate": f"""WITH {HASHED_TFIDF},
seen AS (SELECT DISTINCT bucket FROM weighed JOIN train USING (doc_id)),
sums AS (SELECT emotion, bucket, sum(tfidf) AS observed FROM weighed JOIN train USING (doc_id) GROUP BY ALL)
SELECT c.emotion AS "Emotion", s.bucket, round(coalesce(observed, 0), 6) AS observed, true AS optimal
FROM (SELECT DISTINCT emotion FROM train) c CROSS JOIN seen s LEFT JOIN sums USING (emotion, bucket)""",
    "lr_optimum": "SELECT true AS is_optimal, true AS is_flat",
    "hashing_tf_totals": f"""WITH t AS (SELECT doc_id, {_tokens(SPACE)} AS w FROM documents)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, true AS fits FROM t WHERE len(w) > 0""",
    "lr_calibration": f"""WITH {LABELS},
train AS (SELECT emotion FROM labels_named JOIN documents USING (doc_id) WHERE text IS NOT NULL AND {BUCKET} < 80)
SELECT emotion AS class, round(count(*) / sum(count(*)) OVER (), 3) AS share FROM train GROUP BY emotion""",
    "topk_confidence": f"""WITH {NB}
SELECT doc_id, predicted, round(confidence, 6) AS confidence FROM predicted ORDER BY 3 DESC, 1 LIMIT 10""",
    "topk_first_class": f"""WITH {NB},
shares AS (
  SELECT r.doc_id, list(round(exp(r.weight - b.top) * p.confidence, 6) ORDER BY r.position) AS p
  FROM raw r JOIN best b USING (doc_id) JOIN predicted p USING (doc_id) GROUP BY r.doc_id
)
SELECT l.doc_id, l.emotion AS "Emotion", p.predicted
FROM labels_named l JOIN predicted p USING (doc_id) JOIN shares s USING (doc_id) JOIN classes c ON c.emotion = p.predicted
WHERE {BUCKET} >= 80 AND c.position > 1 ORDER BY s.p DESC, l.doc_id LIMIT 10""",
    "cross_validate_nb": CROSS_VALIDATE_NB,
    "cross_validate_subtracted": CROSS_VALIDATE_NB,
    "grown_model_predict": NB_PREDICT,
    "stored_class_terms": f"""WITH {LABELS},
plain AS (
  SELECT doc_id, unnest({WORDS_PLAIN}) AS term FROM documents
  UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NOT NULL
)
SELECT emotion AS "Emotion", term, count(*) AS n, count(DISTINCT doc_id) AS docs
FROM plain JOIN labels_named USING (doc_id) GROUP BY ALL""",
    "nb_predict": NB_PREDICT,
    "prepared_predict": NB_PREDICT,
    "saved_model_predict": NB_PREDICT,
    "retrain_predict": NB_PREDICT,
    "confusion": f"WITH {NB} SELECT actual, predicted, n FROM cells",
    "f1_weighted": f"""WITH {NB},
sides AS (
  SELECT actual AS class, n AS support, 0 AS claimed, CASE WHEN actual = predicted THEN n ELSE 0 END AS hit FROM cells
  UNION ALL SELECT predicted, 0, n, 0 FROM cells
),
per_class AS (
  SELECT sum(support) AS support, 2.0::DOUBLE * sum(hit) / (sum(support) + sum(claimed)) AS f1
  FROM sides GROUP BY class
)
SELECT round(sum(f1 * support) / sum(support), 6) AS f1 FROM per_class""",
    "accuracy": f"""WITH {NB}
SELECT round(sum(n) FILTER (WHERE actual = predicted) / sum(n), 6) AS accuracy FROM cells""",
    "csv_round_trip": 'SELECT source AS "UserID", text AS "Sentence" FROM documents',
    "score_csv_rows": f"""WITH {NB},
lines AS (
  SELECT d.text AS line, p.predicted FROM documents d JOIN predicted p USING (doc_id)
  UNION ALL SELECT unnest(['', NULL]), emotion FROM classes WHERE position = 1
)
SELECT line AS "Sentence", predicted, count(*) AS n FROM lines GROUP BY ALL""",
    "merged_csv": MERGED,
    "merged_csv_with_marks": MERGED,
    "flattened_json": FLATTENED,
    "archive_files": f"""WITH {SCORED}
SELECT user_name AS "UserID", event_type AS "Sentence", prediction, count(*) AS n FROM scored GROUP BY ALL""",
    "dashboard_snapshots": f"""WITH {SCORED},
batches AS (SELECT event_id // 500 AS batch, {COUNTERS} FROM scored GROUP BY 1),
running AS (
  SELECT batch, CAST(sum(positive) OVER w AS BIGINT) AS positive, CAST(sum(negative) OVER w AS BIGINT) AS negative,
         CAST(sum(neutral) OVER w AS BIGINT) AS neutral
  FROM batches WINDOW w AS (ORDER BY batch ROWS UNBOUNDED PRECEDING)
)
SELECT * FROM running ORDER BY batch DESC LIMIT 10""",
    "dashboard_share": f"""WITH {SCORED}
SELECT class, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 1) AS pct
FROM scored WHERE class IS NOT NULL GROUP BY class""",
    "dashboard_totals": USER_TOTALS,
    "dashboard_latest": f"""WITH {SCORED}
SELECT class, event_id // 500 AS batch, user_name AS "UserID", event_type AS "Sentence", CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY event_id DESC) AS rank FROM scored WHERE class IS NOT NULL)
WHERE rank <= 13""",
    "json_round_trip": 'SELECT doc_id, source AS "UserID", text AS "Sentence" FROM documents',
    "archive_round_trip": f"""WITH {SCORED}
SELECT CAST(ts AS DATE) AS batch, event_id, user_name AS "UserID", event_type AS "Sentence", prediction FROM scored""",
    "negative_users_table": NEGATIVE_USERS,
    "scored_table_negative": f"""WITH {SCORED}
SELECT event_id, user_name AS "UserID", class FROM scored WHERE class = 'negative'""",
    "stream_score": f"WITH {NB} SELECT doc_id, predicted FROM predicted",
    "stream_class_counts": f"WITH {SCORED} SELECT class, count(*) AS n FROM scored WHERE class IS NOT NULL GROUP BY class",
    "stream_at_intervals": f"WITH {SCORED} SELECT class, count(*) AS n FROM scored WHERE class IS NOT NULL GROUP BY class",
    "stream_final_windows": f"""WITH {SCORED}
SELECT date_trunc('hour', ts) AS window_start, class, count(*) AS n, true AS final_once FROM scored WHERE class IS NOT NULL GROUP BY ALL""",
    "stream_sessions": f"""WITH {SCORED},
steps AS (
  SELECT user_name, ts, class, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_name ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM scored
),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_name ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM steps),
sessions AS (
  SELECT user_name AS "UserID", min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS n, count(*) FILTER (WHERE class = 'negative') AS negative
  FROM numbered GROUP BY user_name, s
)
SELECT * FROM sessions WHERE ended <= (SELECT max(ts) FROM scored) - INTERVAL 1 HOUR""",
    "stream_window_counts": f"""WITH {SCORED}
SELECT date_trunc('hour', ts) AS window_start, class, count(*) AS n FROM scored WHERE class IS NOT NULL GROUP BY ALL""",
    "stream_snapshots": f"""WITH {SCORED}, last AS (SELECT {COUNTERS} FROM scored)
SELECT CAST(4 AS BIGINT) AS n_snapshots, *, positive AS max_positive, negative AS max_negative, neutral AS max_neutral FROM last""",
    "stream_archive": f"""WITH {SCORED}
SELECT event_id, user_name AS "UserID", event_type AS "Sentence", prediction, class FROM scored""",
    "stream_negative_users": NEGATIVE_USERS,
    "stream_publish": f"""WITH {NB}
SELECT d.source AS "UserID", d.text AS "Sentence", p.predicted AS class,
       CASE p.predicted WHEN 'neutral' THEN 0.0::DOUBLE WHEN 'positive' THEN 1.0::DOUBLE WHEN 'negative' THEN 2.0::DOUBLE END AS prediction
FROM documents d JOIN predicted p USING (doc_id)""",
    "published_class_counts": f"WITH {NB} SELECT predicted AS class, count(*) AS n FROM predicted GROUP BY predicted",
    "archived_class_counts": f"WITH {NB} SELECT predicted AS class, count(*) AS n FROM predicted GROUP BY predicted",
}
