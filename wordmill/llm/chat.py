"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A conversation is written turn by turn as ``### role: text</turn>`` and a line
end. Inside roles and texts the characters ``\\``, ``<``, ``#`` and ``:`` get a
backslash in front, so no text can hold a control string, and taking the
backslashes away gives the text back exactly.

Every assistant turn becomes an example: all turns before it are its context,
and only its own text is trainable (``loss_start`` and ``loss_length`` in code
points of ``formatted``). Turns after the last assistant turn are in no target's
context; they are kept in one more row that holds the whole conversation and
trains on nothing, so that the output holds every turn.

A conversation is gathered into one row: it is the unit that a prefix needs.
The examples are cut from its formatted text one after the other, so a task
holds one conversation and one example at a time, not all its examples.

Defined cases: turns are ordered by turn, then role, then text (nulls first);
repeated rows are repeated turns; null roles and texts are empty; rows without
a conversation id form one conversation with a null id; a conversation without
an assistant turn gives the one untrained row; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import quoted

OPEN, CLOSE = "### ", "</turn>\n"
TARGET = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<#:])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\<#:])", "$1")


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(": "), escape(text), F.lit(CLOSE))


def expand_examples(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    target: str = TARGET,
) -> DataFrame:
    """``conv_id, example, n_turns, formatted, loss_start, loss_length,
    whole``: one row per assistant turn, and one untrained row where turns
    follow the last of them. ``whole`` marks the row with all turns."""
    empty = lambda name: F.coalesce(quoted(name).cast("string"), F.lit(""))
    entry = F.struct(quoted(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    talks = turns.groupBy(quoted(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(entry)).alias("said"))
    written = talks.select(
        "conv_id",
        F.transform("said", lambda t: format_turn(t["role"], t["text"])).alias("lines"),
        F.transform("said", lambda t: F.length(escape(t["text"]))).alias("text_sizes"),
        F.transform("said", lambda t: t["role"] == target).alias("targets"),
    )
    # Where each turn ends in the formatted conversation.
    ends = F.aggregate(
        F.transform("lines", F.length),
        F.array(F.lit(0)),
        lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)),
    )
    n = F.size("lines")
    numbers = F.sequence(F.lit(1), n)
    chosen = F.filter(numbers, lambda i: F.element_at(F.col("targets"), i) | (i == n))
    placed = written.select(
        "conv_id", "targets", "text_sizes", F.array_join("lines", "").alias("all"), ends.alias("ends"), n.alias("n"), chosen.alias("chosen")
    )
    rows = placed.select("*", F.posexplode("chosen").alias("example", "n_turns"))
    end = F.element_at("ends", F.col("n_turns") + 1)
    trained = F.element_at("targets", F.col("n_turns"))
    size = F.element_at("text_sizes", F.col("n_turns"))
    return rows.select(
        "conv_id",
        "example",
        "n_turns",
        F.substr("all", F.lit(1), end).alias("formatted"),
        F.when(trained, end - len(CLOSE) - size).alias("loss_start"),
        F.when(trained, size).otherwise(F.lit(0)).alias("loss_length"),
        (F.col("n_turns") == F.col("n")).alias("whole"),
    )


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted conversation."""
    lines = F.split(formatted, CLOSE, -1)  # the last part is empty
    said = F.slice(lines, F.lit(1), F.size(lines) - 1)
    pattern = r"(?s)^### ((?:[^\\:]|\\.)*): (.*)$"
    return F.transform(
        said,
        lambda line: F.struct(
            unescape(F.regexp_extract(line, pattern, 1)).alias("role"),
            unescape(F.regexp_extract(line, pattern, 2)).alias("text"),
        ),
    )


def trained_text(formatted: Column, loss_start: Column, loss_length: Column) -> Column:
    """The unescaped text under the loss mask; empty for an untrained row."""
    return F.coalesce(unescape(F.substr(formatted, loss_start + 1, loss_length)), F.lit(""))
