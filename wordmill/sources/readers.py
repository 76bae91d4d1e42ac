"""Readers (S1-S9). Every reader returns a declared schema; a missing path
gives an empty frame with that schema instead of an error."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wordmill import schemas
from wordmill.constants import CONFIG_STOPWORDS
from wordmill.functions.text import cut_comment, strip_ws
from wordmill.operators.selection import union_lists


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_video_list(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A video list CSV (header, quoted multi-line fields, every
    column a string, only an empty cell is null); optional projection.
    Columns go by the names in the header; a missing one is null."""
    if not path_exists(spark, path):
        df = empty(spark, schemas.VIDEOS)
    else:
        # Without a schema every column is a string under its header's name.
        read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        have = set(read.columns)
        df = read.select(
            *(F.col(f.name) if f.name in have else F.lit(None).cast("string").alias(f.name) for f in schemas.VIDEOS.fields)
        )
    return df.select(*columns) if columns else df


def read_video_lists(spark: SparkSession, *paths: str) -> DataFrame:
    """S1 + U1: several lists, union all by name (missing files are empty)."""
    return union_lists(*[read_video_list(spark, p) for p in paths])


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """``ord, source_id`` from an id file: comments (``#`` to end of
    line) and blank lines dropped, ids stripped, duplicates kept. ``ord``
    follows file order."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "ord bigint, source_id string")
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), "value")
    ids = lines.select("ord", cut_comment("value").alias("source_id"))
    return ids.filter(F.col("source_id") != "")


def read_stopwords(spark: SparkSession, path: str | None = None, base: Iterable[str] = CONFIG_STOPWORDS) -> DataFrame:
    """S5 + U2: the set union of ``base`` and the words of a one-per-line
    file (stripped, lower-cased, blanks skipped)."""
    base_df = spark.createDataFrame([(w.strip().lower(),) for w in base if w.strip()], schemas.STOPWORDS)
    if path is None or not path_exists(spark, path):
        return base_df.distinct()
    words = spark.read.text(path).select(F.lower(strip_ws("value")).alias("word")).filter(F.col("word") != "")
    return base_df.union(words).distinct()


def read_transcript_tree(spark: SparkSession, base_dir: str) -> DataFrame:
    """S3: ``<base>/<channel_id>/<video_id>.txt`` files as ``channel_id,
    video_id, text`` (one row per file, whole UTF-8 text). Files directly
    in the base folder or deeper than one level are not transcripts.

    A one-off landing step: keep the result as Parquet partitioned by
    channel (see ``writers.write_transcripts``); many small files do not
    scale as a working format.
    """
    if not path_exists(spark, base_dir):
        return empty(spark, schemas.TRANSCRIPTS)
    # Spark's file sources hide names with a leading "_" or ".", which video
    # ids may have, so the tasks list and read the files themselves.
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(base_dir)
    fs = root.getFileSystem(conf)
    uri = fs.makeQualified(root).toUri()
    local = uri.getScheme() == "file"
    base = uri.getPath() if local else fs.makeQualified(root).toString()
    channels = [(s.getPath().getName(),) for s in fs.listStatus(root) if s.isDirectory()]
    folders = spark.createDataFrame(channels, "channel_id string").repartition("channel_id")
    files = folders.mapInPandas(_list_folders(base, local), "channel_id string, video_id string").repartition("channel_id", "video_id")
    return files.mapInPandas(_read_files(base, local), "channel_id string, video_id string, text string")


def _file_system(base: str, local: bool):
    """The store of ``base`` and the folder's path in it."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), base) if local else fs.FileSystem.from_uri(base)


def _list_folders(base: str, local: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = _file_system(base, local)
        for batch in batches:
            for channel in batch["channel_id"]:
                found = store.get_file_info(fs.FileSelector(f"{root}/{channel}"))
                names = [f.base_name[: -len(".txt")] for f in found if f.is_file and f.base_name.endswith(".txt")]
                yield pd.DataFrame({"channel_id": [channel] * len(names), "video_id": names}, dtype=object)

    return run


def _read_files(base: str, local: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _file_system(base, local)
        for batch in batches:
            for channel, video in zip(batch["channel_id"], batch["video_id"]):
                with store.open_input_stream(f"{root}/{channel}/{video}.txt", compression=None) as f:
                    text = f.read().decode("utf-8", "replace")
                yield pd.DataFrame({"channel_id": [channel], "video_id": [video], "text": [text]}, dtype=object)

    return run


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """S6 input: landed API pages (JSON lines, declared schema)."""
    if not path_exists(spark, path):
        return empty(spark, schemas.PAGE)
    return spark.read.schema(schemas.PAGE).json(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Landed transcript segments (Parquet, exploded form)."""
    if not path_exists(spark, path):
        return empty(spark, schemas.SEGMENTS)
    return spark.read.schema(schemas.SEGMENTS).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table; missing -> empty with ``schema``."""
    if not path_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)
