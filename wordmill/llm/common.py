"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the text contracts: U+0020 and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_BYTES = SPACE.encode()

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH_ROWS = 500
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def long_rows(df: DataFrame) -> None:
    """Whole documents are long rows: lower the session's Arrow batches to
    ``BATCH_ROWS`` rows (never raise them), so that a Python worker holds about
    a megabyte or two of text at a time. Batches are cut when a plan runs, so
    the setting stays."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_CONF)) <= BATCH_ROWS:
        conf.set(BATCH_CONF, BATCH_ROWS)


def utf8(text: Column) -> Column:
    """The UTF-8 bytes of a text column; null counts as empty. Python tasks
    take bytes: ``bytes.lower`` changes A-Z only, and text that is not valid
    UTF-8 passes unharmed."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. The built-in ``lower`` does the same
    on pure ASCII text, where it is much faster than ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it
    (names compare without case, as in Spark)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_all(df: DataFrame, without: Sequence[str] = ()) -> list[Column]:
    drop = {c.lower() for c in without}
    return [quoted(c) for c in df.columns if c.lower() not in drop]
