"""Declared schemas (no inference anywhere)."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from wordmill.constants import VIDEO_COLUMNS

VIDEOS = StructType([StructField(c, StringType()) for c in VIDEO_COLUMNS])

SOURCES = StructType(
    [
        StructField("source_type", StringType()),
        StructField("source_id", StringType()),
        StructField("channel_id", StringType()),
        StructField("channel_name", StringType()),
    ]
)

SNIPPET = StructType(
    [
        StructField("title", StringType()),
        StructField("description", StringType()),
        StructField("publishedAt", StringType()),
        StructField("resourceId", StructType([StructField("videoId", StringType())])),
    ]
)

# A landed API page: the source it was fetched for and its items.
PAGE = StructType(
    [
        StructField("source_type", StringType()),
        StructField("source_id", StringType()),
        StructField("items", ArrayType(StructType([StructField("snippet", SNIPPET)]))),
    ]
)

SEGMENT = StructType([StructField("start", DoubleType()), StructField("text", StringType())])

SEGMENTS = StructType(
    [
        StructField("video_id", StringType()),
        StructField("channel_id", StringType()),
        StructField("ord", IntegerType()),
        StructField("start", DoubleType()),
        StructField("text", StringType()),
    ]
)

TRANSCRIPTS = StructType(
    [
        StructField("channel_id", StringType()),
        StructField("video_id", StringType()),
        StructField("text", StringType()),
    ]
)

# Landed transcripts in block form: a video's text is its blocks joined in
# ``block`` order with a newline (see operators.transcripts).
TRANSCRIPT_BLOCKS = StructType(
    [
        StructField("channel_id", StringType()),
        StructField("video_id", StringType()),
        StructField("block", LongType()),
        StructField("text", StringType()),
    ]
)

STOPWORDS = StructType([StructField("word", StringType())])

WATERMARKS = StructType(
    [
        StructField("source_type", StringType()),
        StructField("source_id", StringType()),
        StructField("last_date", StringType()),
    ]
)

ATTEMPT_LOG = StructType(
    [
        StructField("video_id", StringType()),
        StructField("at", TimestampNTZType()),
        StructField("ok", BooleanType()),
    ]
)

ATTEMPTS = StructType(
    [
        StructField("video_id", StringType()),
        StructField("attempts", LongType()),
        StructField("last_attempt", TimestampNTZType()),
    ]
)

WORDS = StructType([StructField("word", StringType()), StructField("count", LongType())])

TREND = StructType(
    [StructField("word", StringType()), StructField("date", DateType()), StructField("count", LongType())]
)
