"""Corpus profile (A9-A12): files per channel, size histogram, row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wordmill.constants import SIZE_BINS


def files_per_channel(transcripts: DataFrame, channel_col: str = "channel_id") -> DataFrame:
    """Number of transcripts per channel."""
    return transcripts.groupBy(channel_col).agg(F.count(F.lit(1)).alias("files"))


def transcript_sizes(blocks: DataFrame, keys=("channel_id", "video_id"), text_col: str = "text") -> DataFrame:
    """Byte size of each video's full text from its blocks: the block bytes
    plus one newline between consecutive blocks. A grouped sum (partial
    aggregation), so a long video is never gathered in one place."""
    return blocks.groupBy(*keys).agg(
        (F.sum(F.octet_length(text_col)) + F.count(F.lit(1)) - 1).cast("bigint").alias("size")
    )


def size_bin(size: Column) -> Column:
    """Index (0-5) of the size bin of a byte size."""
    expr = F.lit(len(SIZE_BINS) - 1)
    for i, (_, _, high) in reversed(list(enumerate(SIZE_BINS))):
        if high is not None:
            expr = F.when(size < high, F.lit(i)).otherwise(expr)
    return expr


def size_histogram(transcripts: DataFrame, text_col: str = "text", size_col: str | None = None) -> DataFrame:
    """A10: ``bin_no, bin, files`` for all six bins, empty bins with 0.

    Size is the UTF-8 byte length of the text (or a given size column). One
    global aggregate of six conditional counts (partial per task, six numbers
    per task to merge), then unpivoted to six rows: no join, no sort.
    """
    size = F.col(size_col) if size_col else F.octet_length(text_col)
    # A missing text is no file: it has no size and is not counted.
    binned = transcripts.filter(size.isNotNull()).select(size_bin(size).alias("_bin"))
    counts = binned.agg(*[F.count_if(F.col("_bin") == i).alias(f"b{i}") for i in range(len(SIZE_BINS))])
    stack = ", ".join(f"{i}, '{label}', b{i}" for i, (label, _, _) in enumerate(SIZE_BINS))
    return counts.select(F.expr(f"stack({len(SIZE_BINS)}, {stack}) AS (bin_no, bin, files)")).select(
        F.col("bin_no").cast("int"), "bin", F.col("files").cast("bigint")
    )


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the job that consumes ``df``.

    No extra job: read ``observation.get['rows']`` after an action.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
