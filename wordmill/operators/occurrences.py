"""E5: keyword occurrences in transcripts (declared but empty originally;
semantics are ours): every line that matches a keyword, with its position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.constants import BROADCAST_MAX_ROWS
from wordmill.plans.physical import small_table

GRAM = 3


def keyword_occurrences(
    texts: DataFrame,
    keywords: Sequence[str],
    keys: Sequence[str] = ("video_id",),
    text_col: str = "text",
) -> DataFrame:
    """``keys..., line_no, keyword, line`` for each (line, keyword) match.

    Keywords are case-insensitive Unicode regex fragments. Each keyword is
    its own literal pattern (compiled once per task), and the matches of a
    line are exploded from an array: no join with the keyword list. For long
    lists of plain keywords see :func:`keyword_list_occurrences`.
    """
    lines = texts.select(*keys, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    hits = F.array(*[F.when(F.col("line").rlike("(?iu)" + k), F.lit(k)) for k in keywords])
    matched = lines.select(*keys, "line_no", "line", F.explode(F.filter(hits, lambda k: k.isNotNull())).alias("keyword"))
    return matched.select(*keys, "line_no", "keyword", "line")


def _folded(text: Column) -> Column:
    """One form for all cases of a character that a case-insensitive Unicode
    pattern takes as equal: lower case of upper case, but for the dotted capital
    I, the final sigma and the sharp s, which depend on neighbours or lengthen."""
    low = F.lower(F.translate(F.upper(text), "İ", "I"))
    return F.replace(F.translate(low, "ς", "σ"), F.lit("ß"), F.lit("ss"))


def _grams(chars: Column, size: int) -> Column:
    """The distinct runs of ``size`` characters, in time linear in the text."""
    run = F.transform(chars, lambda c, i: F.concat(c, *(F.get(chars, i + n) for n in range(1, size))))
    return F.array_distinct(F.filter(run, lambda g: g.isNotNull()))


def keyword_list_occurrences(
    texts: DataFrame,
    keywords: Sequence[str],
    keys: Sequence[str] = ("video_id",),
    text_col: str = "text",
    slice_keywords: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """The result of :func:`keyword_occurrences` for a long list of plain
    keywords (texts, not patterns; an empty one is ignored, a repeated one
    counts once), in one pass whatever the length of the list.

    Every keyword is filed under one of its substrings of ``GRAM`` characters
    (all of a shorter one). The distinct substrings of a line meet that table by
    a broadcast equi-join inside the scan's stage, and only the keywords met are
    matched with the line. Lists beyond ``slice_keywords`` take a pass for each
    part of that length.
    """
    spark = texts.sparkSession
    words = sorted({k for k in keywords if k})
    lines = texts.select(*keys, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    found = None
    for start in range(0, len(words), slice_keywords):
        part = words[start : start + slice_keywords]
        table = small_table(spark, [(w,) for w in part], "keyword string", max_rows=slice_keywords)
        folded = table.select("keyword", _folded(F.col("keyword")).alias("f"))
        size = F.least(F.length("f"), F.lit(GRAM))
        # Any of a keyword's substrings will do; the last differs more often
        # between keywords than the first.
        filed = folded.select("keyword", F.right(F.col("f"), size).alias("gram"))
        sizes = sorted({min(GRAM, len(w)) for w in part})
        # Folding may change a length by one or more; then all sizes are asked.
        sizes = sizes if all(w.isascii() for w in part) else list(range(1, GRAM + 1))
        chars = F.regexp_extract_all(_folded(F.col("line")), F.lit("(?s)."), 0)
        split = lines.select(*keys, "line_no", "line", chars.alias("_chars"))
        grams = F.flatten(F.array(*[_grams(F.col("_chars"), n) for n in sizes]))
        asked = split.select(*keys, "line_no", "line", F.explode(grams).alias("gram"))
        met = asked.join(F.broadcast(filed), "gram").drop("gram")
        pattern = F.concat(F.lit("(?iu)\\Q"), F.replace("keyword", F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        hits = met.filter(F.rlike("line", pattern)).select(*keys, "line_no", "keyword", "line")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return lines.select(*keys, "line_no", F.lit("").alias("keyword"), "line").limit(0)
    return found
