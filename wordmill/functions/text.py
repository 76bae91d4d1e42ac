"""Text column expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordmill.constants import PATH_FORBIDDEN_CHARS, PATH_PART_MAX_LEN

ColumnOrName = Column | str

# Every code point Python treats as whitespace (str.isspace), derived by rule
# rather than listed: this is the set ``str.strip()`` removes.
WHITESPACE = "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace())

# A word: a run of letters, combining marks and digits (any script).
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}]+"

# A time mark written in front of every transcript line: "[m:ss]" with any
# number of digits, any script's decimal digits.
TIME_MARK_PATTERN = r"\[\p{Nd}+:\p{Nd}+\]"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_text(c: ColumnOrName) -> Column:
    """Full Unicode lower case."""
    return F.lower(_col(c))


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace of any kind.

    ``trim`` alone removes only the space character; here the trim set is
    every Unicode whitespace code point, so tabs, newlines and no-break
    spaces go too.
    """
    return F.btrim(_col(c), F.lit(WHITESPACE))


def strip_time_marks(c: ColumnOrName) -> Column:
    """Delete every ``[digits:digits]`` mark; spacing around it stays."""
    return F.regexp_replace(_col(c), TIME_MARK_PATTERN, "")


def clean_transcript(c: ColumnOrName) -> Column:
    """X1-X3 in the order the analyses apply them: lower, drop marks, strip."""
    return strip_ws(strip_time_marks(lower_text(c)))


def segment_line(start_seconds: ColumnOrName, text: ColumnOrName) -> Column:
    """``[minutes:ss] text``; seconds are floored, minutes unbounded."""
    secs = F.floor(_col(start_seconds)).cast("bigint")
    return F.format_string("[%d:%02d] %s", F.floor(secs / 60).cast("bigint"), F.pmod(secs, F.lit(60)), _col(text))


def sanitize_path_part(c: ColumnOrName) -> Column:
    """Space -> underscore, drop characters invalid in file names, cut
    to the first 50 characters. One ``translate`` pass, no regex."""
    return F.substring(F.translate(_col(c), " " + PATH_FORBIDDEN_CHARS, "_"), 1, PATH_PART_MAX_LEN)


def chunk_pattern(max_chars: int) -> str:
    """X7 as one regular expression.

    Greedy: take the longest run of at most ``max_chars`` characters that is
    followed by a space or the end of the text; if there is none, cut hard at
    ``max_chars``. Successive matches continue where the last one ended, so
    the next chunk starts at the space, exactly like a cut-at-last-space loop.
    """
    if max_chars < 1:
        raise ValueError("max_chars must be >= 1")
    return rf"(?s).{{1,{max_chars}}}(?= |\z)|.{{{max_chars}}}"


def split_chunks(c: ColumnOrName, max_chars: int) -> Column:
    """Array of stripped chunks (empty text -> empty array)."""
    parts = F.regexp_extract_all(_col(c), F.lit(chunk_pattern(max_chars)), 0)
    return F.transform(parts, strip_ws)


def token_array(c: ColumnOrName) -> Column:
    """X8 (surface form): lower-case word tokens of a text, as an array."""
    return F.regexp_extract_all(lower_text(c), F.lit(TOKEN_PATTERN), 0)


def cut_comment(c: ColumnOrName) -> Column:
    """Text before the first ``#``, stripped. Blank results and
    whole-line comments both come out empty and are dropped by callers."""
    return strip_ws(F.substring_index(strip_ws(c), "#", 1))
