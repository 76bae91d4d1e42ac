"""Segments -> transcript text (X4, X5) and its cleaning.

A transcript is the ordered, newline-joined list of ``[m:ss] text`` lines.
To keep every aggregation group bounded whatever the video length, lines
are assembled in *blocks* of at most ``block_rows`` consecutive segments:
``(video keys..., block, text)``. Joining a video's blocks in ``block``
order with a newline gives the full transcript; a video shorter than one
block has exactly one row holding its whole text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.constants import SEGMENT_BLOCK_ROWS
from wordmill.functions.text import WHITESPACE, lower_text, segment_line, strip_time_marks
from wordmill.plans.physical import salted_join


def has_segments(segments_col: str = "segments") -> Column:
    """a fetched transcript counts only if its segment list is neither
    null nor empty."""
    return F.coalesce(F.size(F.col(segments_col)) > 0, F.lit(False))


def segments_from_arrays(df: DataFrame, keys: Sequence[str] = ("video_id",), segments_col: str = "segments") -> DataFrame:
    """Per-video ``ARRAY<STRUCT<start, text>>`` -> one row per segment with
    its position ``ord`` (the form every other operator takes). Narrow:
    no shuffle; an empty or null list gives no rows."""
    return df.select(*keys, F.posexplode(segments_col).alias("ord", "_seg")).select(
        *keys, "ord", F.col("_seg.start").alias("start"), F.col("_seg.text").alias("text")
    )


def segment_lines(segments: DataFrame, keys: Sequence[str], order_col: str = "ord", start_col: str = "start", text_col: str = "text") -> DataFrame:
    """One formatted line per segment."""
    return segments.select(*keys, order_col, segment_line(start_col, text_col).alias("line"))


def segments_to_text(
    segments: DataFrame,
    keys: Sequence[str] = ("video_id",),
    order_col: str = "ord",
    start_col: str = "start",
    text_col: str = "text",
    block_rows: int = SEGMENT_BLOCK_ROWS,
) -> DataFrame:
    """X4 + X5: segment rows -> ``keys..., block, text``.

    ``order_col`` is the segment position (a non-negative integer, unique per
    video). Each block gathers the lines of positions
    ``[block*block_rows, (block+1)*block_rows)`` in order.
    """
    lines = segment_lines(segments, keys, order_col, start_col, text_col)
    lines = lines.withColumn("block", F.floor(F.col(order_col) / block_rows).cast("bigint"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col("line").alias("l"))))
    return lines.groupBy(*keys, "block").agg(F.array_join(F.transform(ordered, lambda s: s["l"]), "\n").alias("text"))


def text_to_blocks(
    texts: DataFrame, keys: Sequence[str] = ("video_id",), text_col: str = "text", block_rows: int = SEGMENT_BLOCK_ROWS
) -> DataFrame:
    """Whole texts -> ``keys..., block, text`` of at most ``block_rows`` lines;
    joined by newlines they are the text again. Narrow: no shuffle."""
    lines = F.split(F.col(text_col), "\n", -1)
    starts = F.sequence(F.lit(0), F.floor((F.size("_lines") - 1) / block_rows).cast("int"))
    part = F.array_join(F.slice("_lines", F.col("block") * block_rows + 1, F.lit(block_rows)), "\n")
    rows = texts.filter(F.col(text_col).isNotNull()).select(*keys, lines.alias("_lines"))
    rows = rows.select(*keys, "_lines", F.explode(starts).alias("block"))
    return rows.select(*keys, F.col("block").cast("bigint").alias("block"), part.alias("text"))


def clean_blocks(blocks: DataFrame, keys: Sequence[str] = ("video_id",), text_col: str = "text") -> DataFrame:
    """X1-X3 on block-form transcripts, exactly as on the joined text.

    Lower-casing and time-mark removal are per line. Stripping the whole
    text equals: drop leading/trailing blocks that are only whitespace,
    left-strip the first remaining block, right-strip the last one. The
    first/last non-blank block per video comes from a grouped aggregate
    (partial + final), joined back on the video keys with a salted join so a
    very long video is split over many tasks.
    """
    marked = blocks.withColumn(text_col, strip_time_marks(lower_text(text_col)))
    blank = F.length(F.btrim(F.col(text_col), F.lit(WHITESPACE))) == 0
    bounds = marked.groupBy(*keys).agg(
        F.min(F.when(~blank, F.col("block"))).alias("_first"),
        F.max(F.when(~blank, F.col("block"))).alias("_last"),
        F.min("block").alias("_min"),
        F.count(F.lit(1)).alias("_n"),
    )
    joined = salted_join(marked, bounds, list(keys), "inner", "_n", ["block"]).drop("_n")
    text = F.col(text_col)
    text = F.when(F.col("block") == F.col("_first"), F.ltrim(text, F.lit(WHITESPACE))).otherwise(text)
    text = F.when(F.col("block") == F.col("_last"), F.rtrim(text, F.lit(WHITESPACE))).otherwise(text)
    inside = (F.col("block") >= F.col("_first")) & (F.col("block") <= F.col("_last"))
    # A video whose text is all whitespace keeps one empty first block.
    empty_video = F.col("_first").isNull() & (F.col("block") == F.col("_min"))
    return joined.filter(inside | empty_video).select(
        *keys, "block", F.when(empty_video, F.lit("")).otherwise(text).alias(text_col)
    )

