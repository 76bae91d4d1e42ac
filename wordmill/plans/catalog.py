"""Query catalog: every operator family run over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables; the
mapping of driver tables onto the corpus model is:

* a *video* is a ``documents`` row: ``video_id = doc_id``, title = first
  line of the text, description = the text, channel = ``source``;
* its publish time is the ``events`` row with ``event_id = doc_id * 5``,
  rendered as the API's ISO-8601 UTC text;
* a *landed transcript* is a document that has a ``labels`` row;
* *segments* are ``conversations`` turns (``start = turn * 37`` seconds);
* the *attempt log* is the ``error`` (failure) and ``purchase`` (success)
  events, ``user_id`` being the video;
* the *channel dimension* is ``nation`` (attribute ``region.r_name``),
  looked up from identifiers built per ``customer``.

The same mapping is written in SQL in :mod:`wordmill.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.constants import CONFIG_STOPWORDS
from wordmill.functions.text import TOKEN_PATTERN, cut_comment, sanitize_path_part, strip_ws
from wordmill.functions.time import iso_utc, trunc_second
from wordmill.operators import analytics, attempts, chunking, ingest, occurrences, profile, selection, transcripts
from wordmill.operators.tokens import lemma_table
from wordmill.plans.physical import materialize, scratch_path, small_table, spread
from wordmill.schemas import PAGE
from wordmill.sources import bucketed

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------------------
# Query parameters (ours; the oracle SQL uses the same values).
# ---------------------------------------------------------------------------
STOPWORDS = CONFIG_STOPWORDS + ("the", "and", "der", "die", "und", "les", "des", "que", "los", "las", "for", "that", "with")
LEMMAS = (("are", "be"), ("was", "be"), ("were", "be"), ("this", "that"), ("ist", "sein"), ("sind", "sein"), ("est", "être"), ("son", "ser"))
KEYWORDS = ("ndre", "zuver")
CHANNELS = ("SRC1", "SRC3", "SRC5", "SRC12")
START_DATE = "2024-01-05"
END_DATE = "2024-01-12"
OLD_WATERMARKS = (
    ("events", "view", "2024-01-20T00:00:00Z"),
    ("events", "click", "2024-02-15T00:00:00Z"),
    ("events", "legacy", "2023-12-31T00:00:00Z"),
)
NOW = "2024-01-30 12:00:00"
LANGUAGES = ("de", "fr", "es", "en")
OCCURRENCE_KEYWORDS = ("ing", "der", "que")
# A long list of plain keywords: all strings of three of these letters.
KEYWORD_LIST = tuple(a + b + c for a in "aeinrst" for b in "aeinrst" for c in "aeinrst")
TOP_N = 50
TREND_TOP_N = 15
CHUNK_CHARS = 1000
# Short cells, so that conversations of some thousand characters have several.
CELL_CHARS = 2500
SEGMENT_SECONDS = 37
MIN_LENGTH_LONG = 5
# Short blocks, so that conversations of a few turns have several.
BLOCK_ROWS = 3
# Fetched conversations of at least so many turns count as saved.
SAVED_TURNS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Shared relations
# ---------------------------------------------------------------------------


def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text`` spread over the cluster before regex work."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The video list view of ``documents`` (publish time from ``events``)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    joined = docs.join(ev, docs["doc_id"] * 5 == ev["event_id"], "left")
    return joined.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("description"),
        iso_utc("ts").alias("published_at"),
        F.col("source").alias("channel_id"),
        F.upper("source").alias("channel_name"),
    )


def dated_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, published_at, text`` for the trend analyses."""
    docs = documents_text(spark, sf_dir)
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    joined = docs.join(ev, docs["doc_id"] * 5 == ev["event_id"], "left")
    return joined.select(F.col("doc_id").alias("video_id"), iso_utc("ts").alias("published_at"), "text")


def trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.word_trend(dated_corpus(spark, sf_dir), stopwords=STOPWORDS)


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ingest items of source ``('events', event_type)``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("video_id"),
        F.lit("events").alias("source_type"),
        F.col("event_type").alias("source_id"),
        iso_utc("ts").alias("published_at"),
    )


def old_watermarks(spark: SparkSession) -> DataFrame:
    return small_table(spark, OLD_WATERMARKS, "source_type string, source_id string, last_date string")


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("error", "purchase"))
    return ev.select(
        F.col("user_id").alias("video_id"),
        trunc_second("ts").alias("at"),
        (F.col("event_type") == "purchase").alias("ok"),
        "event_id",
    )


def attempt_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts.fold_attempts(attempt_log(spark, sf_dir), seq_col="event_id")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    return conv.select(
        "conv_id",
        F.col("turn").alias("ord"),
        (F.col("turn") * SEGMENT_SECONDS).cast("double").alias("start"),
        "text",
    )


def listed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("video_id"), F.col("source").alias("channel_name"))


# ---------------------------------------------------------------------------
# Frequency family
# ---------------------------------------------------------------------------


def q_word_frequency(spark, sf_dir):
    return analytics.word_frequency(documents_text(spark, sf_dir), stopwords=STOPWORDS)


def q_top_words(spark, sf_dir):
    return analytics.top_words(q_word_frequency(spark, sf_dir), TOP_N)


def q_word_cloud_weights(spark, sf_dir):
    return analytics.word_cloud_weights(q_word_frequency(spark, sf_dir))


def q_lemma_frequency(spark, sf_dir):
    lemmas = small_table(spark, LEMMAS, "token string, lemma string")
    return analytics.word_frequency(documents_text(spark, sf_dir), normalizer=lemma_table(lemmas), stopwords=STOPWORDS)


def q_min_length_frequency(spark, sf_dir):
    return analytics.word_frequency(documents_text(spark, sf_dir), stopwords=STOPWORDS, min_len=MIN_LENGTH_LONG)


def q_stopword_frame_frequency(spark, sf_dir):
    """Stop words as a frame, not yet trimmed: the first word of each document."""
    docs = documents_text(spark, sf_dir)
    first = F.regexp_extract("text", TOKEN_PATTERN, 0)
    words = docs.select(F.concat(F.lit(" "), first, F.lit(" ")).alias("stop")).distinct()
    return analytics.word_frequency(docs, stopwords=words)


# ---------------------------------------------------------------------------
# Trend family
# ---------------------------------------------------------------------------


def q_word_trend(spark, sf_dir):
    return trend(spark, sf_dir)


def q_bucketed_trend(spark, sf_dir):
    """The word trend from transcripts in buckets: written once, then joined
    with the publish times where they lie. The rows of the trend are written
    before the table goes."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("video_id"), "text")
    times = table(spark, sf_dir, "events").filter("event_id % 5 = 0")
    times = times.select((F.col("event_id") / 5).cast("bigint").alias("video_id"), iso_utc("ts").alias("published_at"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    landed = bucketed.create_bucketed(spark, scratch_path(spark, "bucketed"), docs.schema, ["video_id"], buckets, slots=1)
    try:
        landed.append(docs, block_col=None)
        return materialize(analytics.word_trend(landed.join(times), stopwords=STOPWORDS), "bucketed-trend")
    finally:
        landed.forget(spark, delete=True)


def q_top_word_series(spark, sf_dir):
    return analytics.top_series(trend(spark, sf_dir), TREND_TOP_N)


# The matrix's columns: every day on which the driver's events lie. Any other
# day is an error.
MATRIX_DAYS = [f"2024-01-{day:02d}" for day in range(1, 31)]


def q_trend_matrix(spark, sf_dir):
    return analytics.trend_matrix(trend(spark, sf_dir), days=MATRIX_DAYS, must_cover=True)


# ---------------------------------------------------------------------------
# Selection family
# ---------------------------------------------------------------------------

_SELECT_COLS = ("video_id", "title", "published_at", "channel_id", "channel_name")


def q_select_keywords(spark, sf_dir):
    return selection.select_videos(videos(spark, sf_dir), keywords=KEYWORDS).select(*_SELECT_COLS)


def q_select_channels(spark, sf_dir):
    return selection.select_videos(videos(spark, sf_dir), channels=CHANNELS).select(*_SELECT_COLS)


def q_select_date_range(spark, sf_dir):
    out = selection.select_videos(videos(spark, sf_dir), start_date=START_DATE, end_date=END_DATE)
    return out.select(*_SELECT_COLS)


def q_select_date_zones(spark, sf_dir):
    """Publish times as text with and without a zone, with fractions, and text
    that is no time: the wall clock as written counts."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    text = F.regexp_replace(iso_utc("ts"), "Z$", "")
    kind = F.col("event_id") % 5
    times = (
        F.when(kind == 0, F.concat(text, F.lit("Z")))
        .when(kind == 1, F.concat(text, F.lit("+02:00")))
        .when(kind == 2, text)
        .when(kind == 3, F.concat(text, F.lit(".250-0530")))
        .otherwise(F.concat(F.lit("on "), text))
    )
    rows = ev.select(F.col("event_id").cast("string").alias("video_id"), times.alias("published_at"))
    return selection.select_videos(rows, start_date=START_DATE, end_date=END_DATE)


def q_select_all_conditions(spark, sf_dir):
    out = selection.select_videos(
        videos(spark, sf_dir), keywords=KEYWORDS, channels=CHANNELS, start_date=START_DATE, end_date=END_DATE
    )
    return out.select(*_SELECT_COLS)


def q_union_lists(spark, sf_dir):
    playlist = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("video_id"),
        F.col("role").alias("title"),
        F.col("text").alias("description"),
        F.lit("conversations").alias("channel_id"),
        F.col("role").alias("channel_name"),
    )
    return selection.union_lists(videos(spark, sf_dir), playlist)


# ---------------------------------------------------------------------------
# Corpus joins
# ---------------------------------------------------------------------------


def q_corpus_join(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return labels.join(docs, "doc_id", "inner").select("doc_id", "quality", "toxic", "source", "text")


def q_missing_transcripts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return analytics.missing_transcripts(docs, table(spark, sf_dir, "labels"), keys=("doc_id",))


# ---------------------------------------------------------------------------
# Ingest family
# ---------------------------------------------------------------------------


def q_dedup_append(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("video_id"), F.lit("documents").alias("origin"), F.lit(None).cast("bigint").alias("turn")
    )
    conv = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("video_id"), F.lit("conversations").alias("origin"), "turn"
    )
    existing = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("video_id"))
    return ingest.new_rows(docs.unionByName(conv), existing)


def q_incremental_items(spark, sf_dir):
    return ingest.after_watermark(event_items(spark, sf_dir), old_watermarks(spark))


def q_new_watermarks(spark, sf_dir):
    kept = ingest.after_watermark(event_items(spark, sf_dir), old_watermarks(spark))
    return ingest.advance_watermarks(old_watermarks(spark), kept)


def q_api_items(spark, sf_dir):
    # JSON encode/parse is per-row CPU work: spread a few large files first.
    ev = spread(table(spark, sf_dir, "events"), "event_id")
    item = F.struct(
        F.struct(
            F.col("event_type").alias("title"),
            F.col("props").alias("description"),
            iso_utc("ts").alias("publishedAt"),
            F.struct(F.col("event_id").cast("string").alias("videoId")).alias("resourceId"),
        ).alias("snippet")
    )
    # 'signup' pages come without items (an empty API response page).
    page = F.struct(
        F.lit("events").alias("source_type"),
        F.col("event_type").alias("source_id"),
        F.when(F.col("event_type") != "signup", F.array(item)).alias("items"),
    )
    landed = ev.select(F.to_json(page).alias("json"))
    pages = landed.select(F.from_json("json", PAGE).alias("p")).select("p.*")
    items = ingest.flatten_pages(pages)
    return items.select(
        "video_id",
        "title",
        "published_at",
        "source_id",
        F.from_json("description", "k BIGINT")["k"].alias("k"),
    )


def q_items_with_source(spark, sf_dir):
    """Event items with channel columns of their source; the sources are the
    event types, and an item of any other source has none."""
    ev = table(spark, sf_dir, "events")
    items = event_items(spark, sf_dir).withColumns({"title": F.col("source_id"), "description": F.lit(None).cast("string")})
    kinds = ev.filter("event_type <> 'signup'").groupBy("event_type").agg(F.min("event_id").cast("string").alias("channel_id"))
    sources = kinds.select(
        F.lit("events").alias("source_type"), F.col("event_type").alias("source_id"), "channel_id", F.upper("event_type").alias("channel_name")
    )
    return ingest.attach_source(items, sources)


def q_id_list_clean(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", cut_comment("url").alias("source_id"))
    return pages.filter(F.col("source_id") != "")


def q_resolve_identifiers(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    names = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    unknown = F.col("c_mktsegment") == "AUTOMOBILE"
    ident = F.when(
        F.col("c_custkey") % 2 == 0,
        F.concat(F.lit("UC"), (F.col("c_nationkey") + F.when(unknown, 1000).otherwise(0)).cast("string")),
    ).otherwise(F.when(unknown, F.lower("n_name")).otherwise(F.col("n_name")))
    identifiers = cust.join(names, "c_nationkey", "inner").select("c_custkey", ident.alias("identifier"))
    channels = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner").select(
        F.concat(F.lit("UC"), F.col("n_nationkey").cast("string")).alias("channel_id"),
        F.col("n_name").alias("channel_name"),
        F.col("r_name").alias("region"),
    )
    return ingest.resolve_identifiers(identifiers, channels)


def q_sanitize_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", sanitize_path_part("url").alias("name"))


# ---------------------------------------------------------------------------
# Transcript text
# ---------------------------------------------------------------------------


def q_segments_to_text(spark, sf_dir):
    return transcripts.segments_to_text(segments(spark, sf_dir), keys=("conv_id",), block_rows=BLOCK_ROWS)


def q_strip_time_marks(spark, sf_dir):
    return transcripts.clean_blocks(q_segments_to_text(spark, sf_dir), keys=("conv_id",))


def q_chunk_text(spark, sf_dir):
    return chunking.chunk_text(documents_text(spark, sf_dir), ("doc_id",), max_chars=CHUNK_CHARS)


def q_keyword_list_occurrences(spark, sf_dir):
    return occurrences.keyword_list_occurrences(segments(spark, sf_dir), KEYWORD_LIST, keys=("conv_id", "ord", "start"))


def q_chunk_blocks(spark, sf_dir):
    """Chunks of whole conversations, cut from their landed blocks."""
    blocks = transcripts.segments_to_text(segments(spark, sf_dir), keys=("conv_id",), block_rows=BLOCK_ROWS)
    return chunking.chunk_blocks(blocks, ("conv_id",), max_chars=CHUNK_CHARS, cell_chars=CELL_CHARS)


def q_keyword_occurrences(spark, sf_dir):
    return occurrences.keyword_occurrences(segments(spark, sf_dir), OCCURRENCE_KEYWORDS, keys=("conv_id", "ord", "start"))


# ---------------------------------------------------------------------------
# Attempt state
# ---------------------------------------------------------------------------


def q_attempt_state(spark, sf_dir):
    return attempt_state(spark, sf_dir)


def q_retry_eligibility(spark, sf_dir):
    vids = listed_documents(spark, sf_dir).select("video_id")
    return attempts.retry_status(vids, attempt_state(spark, sf_dir), NOW)


def q_retry_work_list(spark, sf_dir):
    vids = listed_documents(spark, sf_dir).select("video_id")
    landed = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("video_id"))
    return attempts.work_list(vids, attempt_state(spark, sf_dir), landed, NOW).select("video_id")


def _outcomes(spark, sf_dir):
    landed = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("video_id"))
    conv = table(spark, sf_dir, "conversations")
    fetched = conv.groupBy(F.col("conv_id").alias("video_id")).agg(
        F.count_if(F.col("text").isNotNull() & (F.col("text") != "")).alias("n_segments"),
        (F.count(F.lit(1)) >= SAVED_TURNS).alias("saved"),
    )
    return attempts.classify_outcomes(listed_documents(spark, sf_dir), attempt_state(spark, sf_dir), landed, fetched, NOW)


def q_outcome_classes(spark, sf_dir):
    return _outcomes(spark, sf_dir).select("video_id", "outcome", "success")


def q_outcome_counts(spark, sf_dir):
    return attempts.outcome_counts(_outcomes(spark, sf_dir), "channel_name")


def q_language_preference(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars")
    return attempts.language_preference(docs, LANGUAGES, keys=("source",), tie_col="doc_id")


# ---------------------------------------------------------------------------
# Profile
# ---------------------------------------------------------------------------


def q_files_per_channel(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("channel_id"))
    return profile.files_per_channel(docs)


def q_size_histogram(spark, sf_dir):
    return profile.size_histogram(table(spark, sf_dir, "documents").select("text"))


def q_row_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    loaded = docs.select(F.count(F.lit(1))).scalar()
    landed = docs.join(labels, "doc_id", "left_semi").select(F.count(F.lit(1))).scalar()
    tokens = analytics.token_count(documents_text(spark, sf_dir), stopwords=STOPWORDS).scalar()
    return spark.range(1).select(loaded.alias("loaded"), landed.alias("landed"), tokens.alias("tokens"))


def q_stopword_union(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    custom = lines.select(F.lower(strip_ws("line")).alias("word")).filter(F.col("word") != "")
    base = small_table(spark, [(w,) for w in CONFIG_STOPWORDS], "word string")
    return base.union(custom).distinct()


# ---------------------------------------------------------------------------
# End to end: list -> transcripts -> clean -> count
# ---------------------------------------------------------------------------


def q_selected_corpus_frequency(spark, sf_dir):
    """Select videos (channels + start date), join the landed transcripts
    (labelled documents), clean, count words."""
    listed = selection.select_videos(videos(spark, sf_dir), channels=CHANNELS, start_date=START_DATE)
    landed = table(spark, sf_dir, "labels").select("doc_id")
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")
    texts = docs.join(landed, "doc_id", "left_semi").select(
        F.col("source").alias("channel_id"), F.col("doc_id").cast("string").alias("video_id"), "text"
    )
    return analytics.word_frequency(analytics.cleaned(analytics.corpus(listed, texts)), stopwords=STOPWORDS)


def q_transcript_frequency(spark, sf_dir):
    """Segments -> transcript text blocks -> cleaned -> word counts. Tokens
    never span a line, so per-block cleaning gives the same words as
    cleaning the joined text (the exact whole-text strip is
    ``strip_time_marks``)."""
    blocks = transcripts.segments_to_text(segments(spark, sf_dir), keys=("conv_id",), block_rows=BLOCK_ROWS)
    return analytics.word_frequency(analytics.cleaned(blocks), stopwords=STOPWORDS)


QUERIES: dict[str, Query] = {
    "word_frequency": q_word_frequency,
    "top_words": q_top_words,
    "word_cloud_weights": q_word_cloud_weights,
    "lemma_frequency": q_lemma_frequency,
    "min_length_frequency": q_min_length_frequency,
    "stopword_frame_frequency": q_stopword_frame_frequency,
    "word_trend": q_word_trend,
    "bucketed_trend": q_bucketed_trend,
    "top_word_series": q_top_word_series,
    "trend_matrix": q_trend_matrix,
    "select_keywords": q_select_keywords,
    "select_channels": q_select_channels,
    "select_date_range": q_select_date_range,
    "select_date_zones": q_select_date_zones,
    "select_all_conditions": q_select_all_conditions,
    "union_lists": q_union_lists,
    "corpus_join": q_corpus_join,
    "missing_transcripts": q_missing_transcripts,
    "dedup_append": q_dedup_append,
    "incremental_items": q_incremental_items,
    "new_watermarks": q_new_watermarks,
    "api_items": q_api_items,
    "items_with_source": q_items_with_source,
    "id_list_clean": q_id_list_clean,
    "resolve_identifiers": q_resolve_identifiers,
    "sanitize_names": q_sanitize_names,
    "segments_to_text": q_segments_to_text,
    "strip_time_marks": q_strip_time_marks,
    "chunk_text": q_chunk_text,
    "chunk_blocks": q_chunk_blocks,
    "keyword_occurrences": q_keyword_occurrences,
    "keyword_list_occurrences": q_keyword_list_occurrences,
    "attempt_state": q_attempt_state,
    "retry_eligibility": q_retry_eligibility,
    "retry_work_list": q_retry_work_list,
    "outcome_classes": q_outcome_classes,
    "outcome_counts": q_outcome_counts,
    "language_preference": q_language_preference,
    "files_per_channel": q_files_per_channel,
    "size_histogram": q_size_histogram,
    "row_counts": q_row_counts,
    "stopword_union": q_stopword_union,
    "selected_corpus_frequency": q_selected_corpus_frequency,
    "transcript_frequency": q_transcript_frequency,
}
