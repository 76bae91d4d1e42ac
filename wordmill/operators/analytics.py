"""Corpus analytics: corpus join, word frequency, trend, top-N, matrix.

Covers J1, J2, J5, F10-F12, A1-A6, A12, T1-T5, T7.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.constants import (
    BROADCAST_MAX_ROWS,
    CONDITIONAL_PIVOT_MAX_DAYS,
    DEFAULT_MIN_LENGTH,
    DEFAULT_TOP_N,
    DEFAULT_TREND_TOP_N,
)
from wordmill.functions.text import clean_transcript
from wordmill.functions.time import day_of
from wordmill.operators.tokens import Normalizer, counted_words, regex_tokens, tokens

TRANSCRIPT_KEYS = ("channel_id", "video_id")


def corpus(videos: DataFrame, transcripts: DataFrame, keys: Sequence[str] = TRANSCRIPT_KEYS) -> DataFrame:
    """J1 + F12: listed videos joined to their transcripts.

    Inner equi-join on ``keys``; a video listed twice appears twice (bag
    semantics). Returns ``video_id, published_at, text``. Transcripts may be
    stored as several text rows per video (e.g. blocks); every row joins.
    """
    listed = videos.select(*keys, "published_at")
    texts = transcripts.select(*keys, "text")
    return listed.join(texts, list(keys), "inner").select("video_id", "published_at", "text")


def missing_transcripts(videos: DataFrame, transcripts: DataFrame, keys: Sequence[str] = TRANSCRIPT_KEYS) -> DataFrame:
    """Listed videos that have no transcript (coverage report)."""
    return videos.join(transcripts.select(*keys), list(keys), "left_anti")


def cleaned(corpus_df: DataFrame, text_col: str = "text") -> DataFrame:
    """X1-X3 applied to the corpus text column."""
    return corpus_df.withColumn(text_col, clean_transcript(text_col))


def word_frequency(
    corpus_df: DataFrame,
    text_col: str = "text",
    normalizer: Normalizer = regex_tokens,
    stopwords=None,
    min_len: int = DEFAULT_MIN_LENGTH,
) -> DataFrame:
    """A1: ``word, count`` over the whole corpus.

    Counting is a partial (map-side) + final hash aggregation, so a word
    holding a large share of all tokens is pre-combined in every task and
    does not skew the shuffle.
    """
    return counted_words(corpus_df, text_col, (), normalizer, stopwords, min_len).select("word", "count")


def sorted_counts(freq: DataFrame) -> DataFrame:
    """Count descending, ties by word (the original leaves ties open)."""
    return freq.orderBy(F.desc("count"), F.asc("word"))


def top_words(freq: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """The ``n`` most frequent words (planned as TakeOrderedAndProject)."""
    return sorted_counts(freq).limit(n)


def word_cloud_weights(freq: DataFrame) -> DataFrame:
    """Every word with ``weight = count / max(count)``.

    The maximum is a scalar subquery (one partial + final aggregate), not a
    global window, so no single task ever holds all words.
    """
    peak = freq.select(F.max("count")).scalar()
    return freq.select("word", "count", (F.col("count") / peak).alias("weight"))


def token_total(freq: DataFrame) -> DataFrame:
    """Number of tokens kept after cleaning, from word counts."""
    return freq.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("tokens"))


def token_count(
    corpus_df: DataFrame,
    text_col: str = "text",
    normalizer: Normalizer = regex_tokens,
    stopwords=None,
    min_len: int = DEFAULT_MIN_LENGTH,
) -> DataFrame:
    """A12 without the word counts: one global count over the cleaned word
    stream (a partial count per task, no shuffle of the vocabulary). Equal to
    ``token_total(word_frequency(...))`` with the same arguments."""
    words = tokens(corpus_df, text_col, (), normalizer, stopwords, min_len)
    return words.agg(F.count(F.lit(1)).cast("bigint").alias("tokens"))


def word_trend(
    corpus_df: DataFrame,
    text_col: str = "text",
    published_col: str = "published_at",
    normalizer: Normalizer = regex_tokens,
    stopwords=None,
    min_len: int = DEFAULT_MIN_LENGTH,
) -> DataFrame:
    """A2 (with F10, F11): ``word, date, count``.

    Documents without a publish time (null or empty) are dropped before any
    text work; the day is the first 10 characters of the publish time.
    """
    dated = corpus_df.filter(F.col(published_col).isNotNull() & (F.col(published_col) != ""))
    dated = dated.select(day_of(published_col).alias("date"), text_col).filter(F.col("date").isNotNull())
    return counted_words(dated, text_col, ("date",), normalizer, stopwords, min_len).select("word", "date", "count")


def sorted_trend(trend: DataFrame) -> DataFrame:
    """T4: by date, then word."""
    return trend.orderBy("date", "word")


def word_totals(trend: DataFrame) -> DataFrame:
    """A4: total count per word over all days."""
    return trend.groupBy("word").agg(F.sum("count").cast("bigint").alias("total"))


def top_trend_words(trend: DataFrame, n: int = DEFAULT_TREND_TOP_N) -> DataFrame:
    """The ``n`` words with the largest totals, ties by word; ``rank`` 1..n.

    The window runs over the ``n`` rows left after the top-k, never over the
    corpus.
    """
    top = word_totals(trend).orderBy(F.desc("total"), F.asc("word")).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), F.asc("word"))))


def top_series(trend: DataFrame, n: int = DEFAULT_TREND_TOP_N) -> DataFrame:
    """T5 (with J5): the trend rows of the top-``n`` words, in rank then date
    order. The top list has at most ``n`` rows: it is broadcast when ``n`` is
    within ``BROADCAST_MAX_ROWS`` (always, for chart-sized N), otherwise
    Catalyst/AQE choose the join."""
    top = top_trend_words(trend, n).select("word", "rank")
    if n <= BROADCAST_MAX_ROWS:
        top = F.broadcast(top)
    return trend.join(top, "word", "inner").select("rank", "word", "date", "count").orderBy("rank", "date")


def trend_days(trend: DataFrame) -> list[str]:
    """Distinct days of a trend as ``YYYY-MM-DD`` labels, ascending.

    The only driver collect of the analytics: one label per calendar day,
    which are the matrix's column names; it does not grow with the data.
    """
    rows = trend.select(F.col("date").cast("date").alias("d")).filter(F.col("d").isNotNull()).distinct().orderBy("d").collect()
    return [r["d"].isoformat() for r in rows]


def trend_matrix(trend: DataFrame, days: Iterable[str] | None = None, must_cover: bool = False) -> DataFrame:
    """A5 + A6: word x day matrix of counts (missing cells 0) plus ``total``,
    the sum of the row's cells. ``days`` lists the columns; without it, all
    days of the trend. With ``must_cover``, a dated row outside ``days`` is an
    error when the matrix is computed.

    Covers all words, not only the top ones. Up to ``CONDITIONAL_PIVOT_MAX_DAYS``
    day columns: one grouped aggregation with a conditional sum per day (a
    single shuffle with partial aggregation; measured fastest). Wider matrices
    use Spark's two-phase pivot, whose cost does not grow with days per row.
    The result is the same either way. No group is ever collected.
    """
    labels = list(days) if days is not None else trend_days(trend)
    # Rows are matched on the date value (an int compare per cell); the
    # ``YYYY-MM-DD`` labels are only the column names.
    dates = [dt.date.fromisoformat(d) for d in labels]
    dated = trend.select("word", F.col("date").cast("date").alias("_day"), "count")
    if must_cover:
        listed = F.col("_day").isNull() | F.col("_day").isin(dates)
        stray = F.raise_error(F.concat(F.lit("trend_matrix: no column for the day "), F.col("_day").cast("string"))).cast("date")
        dated = dated.select("word", F.when(listed, F.col("_day")).otherwise(stray).alias("_day"), "count")
    if len(labels) <= CONDITIONAL_PIVOT_MAX_DAYS:
        sums = [F.sum(F.when(F.col("_day") == F.lit(d), F.col("count"))).alias(label) for d, label in zip(dates, labels)]
        wide = dated.groupBy("word").agg(F.count(F.lit(1)).alias("_n"), *sums).drop("_n")
    else:
        wide = dated.groupBy("word").pivot("_day", dates).agg(F.sum("count"))
    cells = [F.coalesce(wide[i + 1], F.lit(0)).cast("bigint") for i in range(len(dates))]
    total = F.aggregate(F.array(*cells), F.lit(0).cast("bigint"), lambda acc, x: acc + x) if cells else F.lit(0).cast("bigint")
    return wide.select("word", *[c.alias(d) for c, d in zip(cells, labels)], total.alias("total"))
