"""Video selection (U1, F1-F5): keyword, channel and date-range filters.

One narrow stage: every condition is a Column, the conjunction is pushed
into the scan where the source supports it, and nothing shuffles.
"""

from __future__ import annotations

import datetime as dt
import functools
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions.time import parse_date_param, timestamp_param
from wordmill.plans.physical import bounded_broadcast


def union_lists(*lists: DataFrame) -> DataFrame:
    """Union all by column name; a column missing on one side is null.
    No de-duplication (a video in two lists is kept twice)."""
    if not lists:
        raise ValueError("union_lists needs at least one DataFrame")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists)


def keyword_pattern(keywords: Sequence[str], literal: bool = False) -> str:
    """Keywords joined with ``|`` into one case-insensitive regex.

    Keywords are regex fragments (Java syntax) unless ``literal`` quotes
    them. ``(?iu)`` makes case folding Unicode-aware (``(?i)`` alone is
    ASCII-only in Java).
    """
    parts = [re.escape(k) if literal else k for k in keywords]
    return "(?iu)(?:" + "|".join(parts) + ")"


def keyword_condition(keywords: Sequence[str], columns: Sequence[str] = ("title", "description"), literal: bool = False) -> Column:
    """the pattern found in any of ``columns``; null never matches."""
    pattern = keyword_pattern(keywords, literal)
    hits = [F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in columns]
    return functools.reduce(lambda a, b: a | b, hits)


# Channel lists up to this length become an in-code hash set; longer ones, and
# any frame, are joined.
INLINE_CHANNELS_MAX = 1_000


def channel_condition(channels: Sequence[str], column: str = "channel_name") -> Column:
    """exact, case-sensitive membership (an in-code hash set)."""
    return F.coalesce(F.col(column).isin(list(channels)), F.lit(False))


def in_channels(videos: DataFrame, channels: Sequence[str] | DataFrame, column: str = "channel_name") -> DataFrame:
    """F2 for long lists: a semi join with the names (a list, or the first
    column of a frame). The names are broadcast after a check of their size;
    beyond it Spark shuffles both sides and may filter the scan with a Bloom
    filter of the names. The list is no part of the plan's text."""
    if isinstance(channels, DataFrame):
        names = channels.select(F.col(channels.columns[0]).alias(column)).filter(F.col(column).isNotNull()).distinct()
    else:
        rows = pa.table({column: pa.array(sorted({c for c in channels if c is not None}), pa.string())})
        names = videos.sparkSession.createDataFrame(rows)
    return videos.join(bounded_broadcast(names), column, "left_semi").select(*videos.columns)


# A time of day followed by a zone: "Z", "UTC", "+02:00", "+0200", "+02".
_ZONE = r"(:[0-9]{2}(?:\.[0-9]+)?)\s*(?:[Zz]|UTC|[+-][0-9]{2}(?::?[0-9]{2})?)$"


def _wall_clock(column: str) -> Column:
    """X9 + X10: the publish time as written, its zone dropped (not
    converted). The session zone plays no part."""
    return F.regexp_replace(F.trim(F.col(column)), _ZONE, "$1").try_cast("timestamp_ntz")


def start_condition(start_date: str, column: str = "published_at") -> Column:
    """publish wall clock at or after ``start_date`` 00:00; unparsable ->
    false."""
    return F.coalesce(_wall_clock(column) >= timestamp_param(parse_date_param(start_date)), F.lit(False))


def end_condition(end_date: str, column: str = "published_at", inclusive_day: bool = False) -> Column:
    """publish wall clock at or before ``end_date`` 00:00:00.

    As originally defined the end day itself is excluded except for its very
    first instant; ``inclusive_day=True`` keeps the whole end day instead.
    """
    end = parse_date_param(end_date)
    ts = _wall_clock(column)
    if inclusive_day:
        cond = ts < timestamp_param(end + dt.timedelta(days=1))
    else:
        cond = ts <= timestamp_param(end)
    return F.coalesce(cond, F.lit(False))


def selection_condition(
    keywords: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    literal_keywords: bool = False,
    end_inclusive_day: bool = False,
) -> Column:
    """conjunction of the active conditions; none active -> true.

    Catalyst keeps the order of the conjuncts and generated code stops at
    the first false one, so the cheap tests (hash-set membership, date
    comparisons) come first and the regex over the whole description runs
    only on rows that passed them. Every conjunct is null-safe, so the
    order does not change the result.
    """
    conds: list[Column] = []
    if channels:
        conds.append(channel_condition(channels))
    if start_date:
        conds.append(start_condition(start_date))
    if end_date:
        conds.append(end_condition(end_date, inclusive_day=end_inclusive_day))
    if keywords:
        conds.append(keyword_condition(keywords, literal=literal_keywords))
    return functools.reduce(lambda a, b: a & b, conds, F.lit(True))


def select_videos(
    videos: DataFrame,
    keywords: Sequence[str] | None = None,
    channels: Sequence[str] | DataFrame | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    literal_keywords: bool = False,
    end_inclusive_day: bool = False,
    dedupe: bool = False,
) -> DataFrame:
    """Filter a video list. Channels beyond ``INLINE_CHANNELS_MAX`` names, or in
    a frame, are joined (:func:`in_channels`). ``published_at`` keeps its original text; the
    parsed time is used only inside the predicate. ``dedupe`` drops repeated
    ``video_id`` rows (off by default: the original keeps them)."""
    long = isinstance(channels, DataFrame) or (channels is not None and len(channels) > INLINE_CHANNELS_MAX)
    inline = None if long else channels
    cond = selection_condition(keywords, inline, start_date, end_date, literal_keywords, end_inclusive_day)
    out = (in_channels(videos, channels) if long else videos).filter(cond)
    return out.dropDuplicates(["video_id"]) if dedupe else out
