"""Column expressions (scalar functions). All are Spark built-ins, so they
stay inside whole-stage code generation."""

from wordmill.functions.text import (
    TOKEN_PATTERN,
    WHITESPACE,
    chunk_pattern,
    clean_transcript,
    cut_comment,
    lower_text,
    sanitize_path_part,
    segment_line,
    split_chunks,
    strip_time_marks,
    strip_ws,
    token_array,
)
from wordmill.functions.time import (
    day_label,
    day_of,
    elapsed_micros,
    instant_param,
    iso_utc,
    parse_date_param,
    parse_timestamp,
    timestamp_param,
    trunc_second,
)

__all__ = [
    "TOKEN_PATTERN",
    "WHITESPACE",
    "chunk_pattern",
    "clean_transcript",
    "cut_comment",
    "day_label",
    "day_of",
    "elapsed_micros",
    "instant_param",
    "iso_utc",
    "lower_text",
    "parse_date_param",
    "parse_timestamp",
    "sanitize_path_part",
    "segment_line",
    "split_chunks",
    "strip_time_marks",
    "strip_ws",
    "timestamp_param",
    "token_array",
    "trunc_second",
]
