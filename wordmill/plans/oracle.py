"""Oracle SQL (DuckDB dialect) for the query catalog.

Each string computes, from the same driver tables, what the catalog entry of
the same name computes with Spark; column names and types are aligned. The
oracle needs no scalability: windows and recursion are fine here.
"""

from __future__ import annotations

from wordmill.constants import CONFIG_STOPWORDS, SIZE_BINS, WAIT_SECONDS
from wordmill.functions.text import WHITESPACE
from wordmill.plans import catalog as C


def _str_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _values(rows, names) -> str:
    body = ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) t({', '.join(names)}))"


WS = "(" + " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE) + ")"
TOKEN = r"'[\p{L}\p{M}\p{N}]+'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"
SW = _str_list(C.STOPWORDS)

VIDEOS = f"""videos AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS video_id,
         split_part(d.text, chr(10), 1) AS title,
         d.text AS description,
         strftime(e.ts, {ISO}) AS published_at,
         d.source AS channel_id,
         upper(d.source) AS channel_name
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id * 5)"""


def _freq(min_len: int = 3, lemmas: bool = False) -> str:
    word = "w.word"
    src = "(SELECT unnest(regexp_extract_all(lower(text), " + TOKEN + ")) AS word FROM documents) w"
    if lemmas:
        src += " LEFT JOIN " + _values(C.LEMMAS, ["token", "lemma"]) + " lm ON lm.token = w.word"
        word = "lower(coalesce(lm.lemma, w.word))"
    return f"""SELECT word, CAST(count(*) AS BIGINT) AS count
FROM (SELECT {word} AS word FROM {src})
WHERE word NOT IN {SW} AND length(word) >= {min_len}
GROUP BY word"""


TREND = f"""dated AS (
  SELECT strftime(e.ts, {ISO}) AS published_at, d.text
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id * 5),
days AS (
  SELECT TRY_CAST(left(published_at, 10) AS DATE) AS date, text FROM dated
  WHERE published_at IS NOT NULL AND published_at <> ''),
tw AS (
  SELECT date, unnest(regexp_extract_all(lower(text), {TOKEN})) AS word FROM days WHERE date IS NOT NULL),
trend AS (
  SELECT word, date, CAST(count(*) AS BIGINT) AS count FROM tw
  WHERE word NOT IN {SW} AND length(word) >= 3 GROUP BY word, date)"""

SELECT_COLS = "video_id, title, published_at, channel_id, channel_name"
KW = "|".join(C.KEYWORDS)
KW_COND = (
    f"(coalesce(regexp_matches(title, '(?:{KW})', 'i'), false) "
    f"OR coalesce(regexp_matches(description, '(?:{KW})', 'i'), false))"
)
CH_COND = f"coalesce(channel_name IN {_str_list(C.CHANNELS)}, false)"
TS = f"try_strptime(published_at, {ISO})"
DATE_COND = f"coalesce({TS} >= TIMESTAMP '{C.START_DATE} 00:00:00' AND {TS} <= TIMESTAMP '{C.END_DATE} 00:00:00', false)"

ITEMS = f"""items AS (
  SELECT CAST(event_id AS VARCHAR) AS video_id, 'events' AS source_type, event_type AS source_id,
         strftime(ts, {ISO}) AS published_at FROM events),
wm AS {_values(C.OLD_WATERMARKS, ["source_type", "source_id", "last_date"])},
kept AS (
  SELECT i.video_id, i.source_type, i.source_id, i.published_at
  FROM items i LEFT JOIN wm ON wm.source_type = i.source_type AND wm.source_id = i.source_id
  WHERE wm.last_date IS NULL OR i.published_at > wm.last_date)"""

SEGMENTS_TEXT = f"""SELECT conv_id, CAST(floor(turn / {C.BLOCK_ROWS}) AS BIGINT) AS block,
       string_agg(printf('[%d:%02d] %s', CAST(floor(turn * {C.SEGMENT_SECONDS}) AS BIGINT) // 60,
                         CAST(floor(turn * {C.SEGMENT_SECONDS}) AS BIGINT) % 60, text), chr(10) ORDER BY turn) AS text
FROM conversations
GROUP BY conv_id, CAST(floor(turn / {C.BLOCK_ROWS}) AS BIGINT)"""

ATTEMPT_STATE = """log AS (
  SELECT user_id AS video_id, date_trunc('second', ts) AS at_ts, event_id, event_type = 'purchase' AS ok
  FROM events WHERE event_type IN ('error', 'purchase')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY at_ts, event_id) AS rn FROM log),
lastok AS (SELECT video_id, max(rn) FILTER (WHERE ok) AS last_ok FROM ranked GROUP BY video_id),
st AS (
  SELECT r.video_id, CAST(count(*) AS BIGINT) AS attempts, max(r.at_ts) AS last_attempt
  FROM ranked r JOIN lastok l ON l.video_id = r.video_id
  WHERE NOT r.ok AND (l.last_ok IS NULL OR r.rn > l.last_ok)
  GROUP BY r.video_id)"""

WAITS = "[" + ", ".join(str(w) for w in WAIT_SECONDS) + "]"
RETRY = f"""{ATTEMPT_STATE},
rs AS (
  SELECT d.doc_id AS video_id, d.source AS channel_name, st.attempts, st.last_attempt,
         CASE WHEN st.attempts IS NULL THEN true
              WHEN st.attempts >= 6 THEN false
              ELSE coalesce(epoch_us(TIMESTAMP '{C.NOW}') - epoch_us(st.last_attempt)
                            >= CAST({WAITS} AS BIGINT[])[least(st.attempts, 5) + 1] * 1000000, false) END AS eligible
  FROM documents d LEFT JOIN st ON st.video_id = d.doc_id)"""

OUTCOMES = f"""{RETRY},
fetched AS (
  SELECT conv_id AS video_id, count(*) FILTER (WHERE text IS NOT NULL AND text <> '') AS n_segments, count(*) >= {C.SAVED_TURNS} AS saved
  FROM conversations GROUP BY conv_id),
oc AS (
  SELECT rs.video_id, rs.channel_name,
         CASE WHEN NOT rs.eligible THEN 'backoff_skip'
              WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = rs.video_id) THEN 'already_landed'
              WHEN f.n_segments > 0 AND f.saved THEN 'downloaded'
              WHEN f.n_segments > 0 THEN 'save_failed'
              ELSE 'unavailable' END AS outcome
  FROM rs LEFT JOIN fetched f ON f.video_id = rs.video_id)"""

SIZE_CASE = "CASE " + " ".join(
    f"WHEN size < {high} THEN {i}" for i, (_, _, high) in enumerate(SIZE_BINS) if high is not None
) + " ELSE 5 END"
BINS = "(SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{label}')" for i, (label, _, _) in enumerate(SIZE_BINS)
) + ") t(bin_no, bin))"

N = C.CHUNK_CHARS
CHUNK_K = f"""CASE WHEN length(rest) <= {N} THEN length(rest)
            WHEN substr(rest, {N + 1}, 1) = ' ' THEN {N}
            WHEN length(regexp_extract(left(rest, {N}), '(?s)^(.*) ', 1)) > 0
              THEN length(regexp_extract(left(rest, {N}), '(?s)^(.*) ', 1))
            ELSE {N} END"""


def _freq_of(texts_sql: str) -> str:
    return f"""SELECT word, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest(regexp_extract_all(lower(text), {TOKEN})) AS word FROM ({texts_sql}))
WHERE word NOT IN {SW} AND length(word) >= 3
GROUP BY word"""


CLEAN = "trim(regexp_replace(lower(text), '\\[\\p{{Nd}}+:\\p{{Nd}}+\\]', '', 'g'), {ws})"

SELECTED_TEXTS = f"""WITH {VIDEOS},
listed AS (SELECT * FROM videos WHERE {CH_COND} AND coalesce({TS} >= TIMESTAMP '{C.START_DATE} 00:00:00', false)),
landed AS (SELECT d.source AS channel_id, CAST(d.doc_id AS VARCHAR) AS video_id, d.text FROM documents d
           WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
SELECT {CLEAN.format(ws=WS)} AS text FROM listed JOIN landed
  ON landed.channel_id = listed.channel_id AND landed.video_id = listed.video_id"""

SQL: dict[str, str] = {
    "word_frequency": _freq(),
    "top_words": f"SELECT word, count FROM ({_freq()}) ORDER BY count DESC, word LIMIT {C.TOP_N}",
    "word_cloud_weights": f"SELECT word, count, CAST(count AS DOUBLE) / max(count) OVER () AS weight FROM ({_freq()})",
    "lemma_frequency": _freq(lemmas=True),
    "min_length_frequency": _freq(min_len=C.MIN_LENGTH_LONG),
    "stopword_frame_frequency": f"""SELECT word, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest(regexp_extract_all(lower(text), {TOKEN})) AS word FROM documents)
WHERE length(word) >= 3 AND word NOT IN (
  SELECT lower(regexp_extract(text, {TOKEN})) FROM documents WHERE text IS NOT NULL)
GROUP BY word""",
    "word_trend": f"WITH {TREND} SELECT word, date, count FROM trend",
    "bucketed_trend": f"WITH {TREND} SELECT word, date, count FROM trend",
    "top_word_series": f"""WITH {TREND},
totals AS (SELECT word, sum(count) AS total FROM trend GROUP BY word),
top AS (SELECT word, row_number() OVER (ORDER BY total DESC, word) AS rank FROM totals
        ORDER BY total DESC, word LIMIT {C.TREND_TOP_N})
SELECT CAST(top.rank AS INTEGER) AS rank, trend.word, trend.date, trend.count
FROM trend JOIN top ON top.word = trend.word""",
    "trend_matrix": f"""WITH {TREND} SELECT word,
{", ".join(f"CAST(coalesce(sum(count) FILTER (WHERE date = DATE '{d}'), 0) AS BIGINT) AS \"{d}\"" for d in C.MATRIX_DAYS)},
  CAST(sum(count) AS BIGINT) AS total FROM trend GROUP BY word""",
    "select_keywords": f"WITH {VIDEOS} SELECT {SELECT_COLS} FROM videos WHERE {KW_COND}",
    "select_channels": f"WITH {VIDEOS} SELECT {SELECT_COLS} FROM videos WHERE {CH_COND}",
    "select_date_range": f"WITH {VIDEOS} SELECT {SELECT_COLS} FROM videos WHERE {DATE_COND}",
    "select_date_zones": f"""SELECT CAST(event_id AS VARCHAR) AS video_id, CASE event_id % 5
    WHEN 0 THEN t || 'Z' WHEN 1 THEN t || '+02:00' WHEN 2 THEN t WHEN 3 THEN t || '.250-0530' END AS published_at
FROM (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS t,
        date_trunc('second', ts) + CASE WHEN event_id % 5 = 3 THEN INTERVAL 250 MILLISECOND ELSE INTERVAL 0 SECOND END AS wall FROM events)
WHERE event_id % 5 < 4 AND wall >= TIMESTAMP '{C.START_DATE} 00:00:00' AND wall <= TIMESTAMP '{C.END_DATE} 00:00:00'""",
    "select_all_conditions": f"WITH {VIDEOS} SELECT {SELECT_COLS} FROM videos WHERE {KW_COND} AND {CH_COND} AND {DATE_COND}",
    "union_lists": f"""WITH {VIDEOS}
SELECT * FROM videos
UNION ALL BY NAME
SELECT 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS video_id, role AS title, text AS description,
       'conversations' AS channel_id, role AS channel_name
FROM conversations""",
    "corpus_join": "SELECT l.doc_id, l.quality, l.toxic, d.source, d.text FROM labels l JOIN documents d ON d.doc_id = l.doc_id",
    "missing_transcripts": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "dedup_append": """SELECT * FROM (
  SELECT doc_id AS video_id, 'documents' AS origin, CAST(NULL AS BIGINT) AS turn FROM documents
  UNION ALL
  SELECT conv_id AS video_id, 'conversations' AS origin, turn FROM conversations) b
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = b.video_id)""",
    "incremental_items": f"WITH {ITEMS} SELECT * FROM kept",
    "new_watermarks": f"""WITH {ITEMS},
bm AS (SELECT source_type, source_id, max(published_at) AS new FROM kept GROUP BY source_type, source_id)
SELECT coalesce(wm.source_type, bm.source_type) AS source_type,
       coalesce(wm.source_id, bm.source_id) AS source_id,
       greatest(wm.last_date, bm.new) AS last_date
FROM wm FULL OUTER JOIN bm ON wm.source_type = bm.source_type AND wm.source_id = bm.source_id""",
    "api_items": f"""SELECT CAST(event_id AS VARCHAR) AS video_id, event_type AS title, strftime(ts, {ISO}) AS published_at,
       event_type AS source_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type <> 'signup'""",
    "items_with_source": f"""WITH src AS (
  SELECT event_type, CAST(min(event_id) AS VARCHAR) AS channel_id, upper(event_type) AS channel_name
  FROM events WHERE event_type <> 'signup' GROUP BY event_type)
SELECT CAST(e.event_id AS VARCHAR) AS video_id, e.event_type AS title, strftime(e.ts, {ISO}) AS published_at,
       CAST(NULL AS VARCHAR) AS description, src.channel_id, src.channel_name, 'events' AS source_type, e.event_type AS source_id
FROM events e LEFT JOIN src ON src.event_type = e.event_type""",
    "id_list_clean": f"""SELECT page_id, source_id FROM (
  SELECT page_id, trim(split_part(trim(url, {WS}), '#', 1), {WS}) AS source_id FROM pages)
WHERE source_id <> ''""",
    "resolve_identifiers": """WITH ids AS (
  SELECT c.c_custkey,
         CASE WHEN c.c_custkey % 2 = 0
              THEN 'UC' || CAST(c.c_nationkey + CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 1000 ELSE 0 END AS VARCHAR)
              ELSE CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN lower(n.n_name) ELSE n.n_name END END AS identifier
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey),
dim AS (
  SELECT 'UC' || CAST(n_nationkey AS VARCHAR) AS channel_id, n_name AS channel_name, r_name AS region
  FROM nation JOIN region ON r_regionkey = n_regionkey),
best AS (
  SELECT channel_name, arg_min(channel_id, channel_id) AS channel_id, arg_min(region, channel_id) AS region
  FROM dim GROUP BY channel_name),
res AS (
  SELECT ids.c_custkey, ids.identifier,
         CASE WHEN starts_with(ids.identifier, 'UC') THEN di.channel_id ELSE b.channel_id END AS channel_id,
         CASE WHEN starts_with(ids.identifier, 'UC') THEN di.channel_name ELSE b.channel_name END AS channel_name,
         CASE WHEN starts_with(ids.identifier, 'UC') THEN di.region ELSE b.region END AS region
  FROM ids
  LEFT JOIN dim di ON starts_with(ids.identifier, 'UC') AND di.channel_id = ids.identifier
  LEFT JOIN best b ON NOT starts_with(ids.identifier, 'UC') AND b.channel_name = ids.identifier)
SELECT *, CASE WHEN channel_id IS NULL THEN 'unresolved' ELSE 'resolved' END AS status FROM res""",
    "sanitize_names": """SELECT page_id, left(translate(url, ' <>:"/\\|?*', '_'), 50) AS name FROM pages""",
    "segments_to_text": SEGMENTS_TEXT,
    "strip_time_marks": f"""WITH b AS ({SEGMENTS_TEXT}),
m AS (SELECT conv_id, block, regexp_replace(lower(text), '\\[\\p{{Nd}}+:\\p{{Nd}}+\\]', '', 'g') AS t FROM b),
bd AS (
  SELECT conv_id,
         min(block) FILTER (WHERE length(trim(t, {WS})) > 0) AS f,
         max(block) FILTER (WHERE length(trim(t, {WS})) > 0) AS l,
         min(block) AS mn
  FROM m GROUP BY conv_id)
SELECT m.conv_id, m.block,
       CASE WHEN bd.f IS NULL THEN ''
            WHEN m.block = bd.f AND m.block = bd.l THEN trim(m.t, {WS})
            WHEN m.block = bd.f THEN ltrim(m.t, {WS})
            WHEN m.block = bd.l THEN rtrim(m.t, {WS})
            ELSE m.t END AS text
FROM m JOIN bd ON bd.conv_id = m.conv_id
WHERE (m.block BETWEEN bd.f AND bd.l) OR (bd.f IS NULL AND m.block = bd.mn)""",
    "chunk_text": f"""WITH RECURSIVE c(doc_id, chunk_no, rest, chunk) AS (
  SELECT doc_id, -1, text, CAST(NULL AS VARCHAR) FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, chunk_no + 1, substr(rest, k + 1), trim(left(rest, k), {WS})
  FROM (SELECT doc_id, chunk_no, rest, {CHUNK_K} AS k FROM c WHERE length(rest) > 0))
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, chunk FROM c WHERE chunk_no >= 0""",
    "keyword_list_occurrences": f"""WITH lines AS (
  SELECT conv_id, turn, unnest(range(len(l))) AS line_no, unnest(l) AS line
  FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations WHERE text IS NOT NULL)),
kw AS {_values([(k,) for k in C.KEYWORD_LIST], ["keyword"])}
SELECT conv_id, turn AS ord, CAST(turn * {C.SEGMENT_SECONDS} AS DOUBLE) AS start, CAST(line_no AS INTEGER) AS line_no, keyword, line
FROM lines JOIN kw ON contains(lower(line), kw.keyword)""",
    "chunk_blocks": f"""WITH RECURSIVE w AS (
  SELECT conv_id, string_agg(text, chr(10) ORDER BY block) AS text FROM ({SEGMENTS_TEXT}) GROUP BY conv_id),
c(conv_id, chunk_no, rest, chunk) AS (
  SELECT conv_id, -1, text, CAST(NULL AS VARCHAR) FROM w
  UNION ALL
  SELECT conv_id, chunk_no + 1, substr(rest, k + 1), trim(left(rest, k), {WS})
  FROM (SELECT conv_id, chunk_no, rest, {CHUNK_K} AS k FROM c WHERE length(rest) > 0))
SELECT conv_id, CAST(chunk_no AS INTEGER) AS chunk_no, chunk FROM c WHERE chunk_no >= 0""",
    "keyword_occurrences": f"""WITH lines AS (
  SELECT conv_id, turn, unnest(range(len(l))) AS line_no, unnest(l) AS line
  FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations WHERE text IS NOT NULL)),
kw AS {_values([(k,) for k in C.OCCURRENCE_KEYWORDS], ["keyword"])}
SELECT conv_id, turn AS ord, CAST(turn * {C.SEGMENT_SECONDS} AS DOUBLE) AS start, CAST(line_no AS INTEGER) AS line_no, keyword, line
FROM lines JOIN kw ON regexp_matches(line, kw.keyword, 'i')""",
    "attempt_state": f"WITH {ATTEMPT_STATE} SELECT video_id, attempts, last_attempt FROM st",
    "retry_eligibility": f"WITH {RETRY} SELECT video_id, attempts, last_attempt, eligible FROM rs",
    "retry_work_list": f"""WITH {RETRY}
SELECT video_id FROM rs
WHERE eligible AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = rs.video_id)""",
    "outcome_classes": f"""WITH {OUTCOMES}
SELECT video_id, outcome, outcome IN ('already_landed', 'downloaded') AS success FROM oc""",
    "outcome_counts": f"""WITH {OUTCOMES}
SELECT channel_name,
       count(*) FILTER (WHERE outcome IN ('already_landed', 'downloaded')) AS downloaded,
       count(*) FILTER (WHERE outcome NOT IN ('already_landed', 'downloaded')) AS missing
FROM oc GROUP BY channel_name""",
    "language_preference": f"""SELECT source, lang, doc_id, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY source
                               ORDER BY list_position({list(C.LANGUAGES)}, lang), doc_id) AS rn
  FROM documents WHERE lang IN {_str_list(C.LANGUAGES)})
WHERE rn = 1""",
    "files_per_channel": "SELECT source AS channel_id, count(*) AS files FROM documents GROUP BY source",
    "size_histogram": f"""WITH s AS (SELECT strlen(text) AS size FROM documents WHERE text IS NOT NULL),
b AS (SELECT {SIZE_CASE} AS bin_no FROM s)
SELECT bins.bin_no, bins.bin, CAST(count(b.bin_no) AS BIGINT) AS files
FROM {BINS} bins LEFT JOIN b ON b.bin_no = bins.bin_no
GROUP BY bins.bin_no, bins.bin""",
    "row_counts": f"""SELECT (SELECT count(*) FROM documents) AS loaded,
       (SELECT count(*) FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS landed,
       (SELECT CAST(coalesce(sum(count), 0) AS BIGINT) FROM ({_freq()})) AS tokens""",
    "selected_corpus_frequency": _freq_of(SELECTED_TEXTS),
    "transcript_frequency": _freq_of(f"SELECT regexp_replace(lower(text), '\\[\\p{{Nd}}+:\\p{{Nd}}+\\]', '', 'g') AS text FROM ({SEGMENTS_TEXT})"),
    "stopword_union": f"""SELECT DISTINCT word FROM (
  SELECT lower(trim(line, {WS})) AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
  UNION ALL
  SELECT * FROM (VALUES {", ".join("('" + w + "')" for w in CONFIG_STOPWORDS)}) t(word))
WHERE word <> ''""",
}
