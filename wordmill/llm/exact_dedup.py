"""Exact deduplication as a stateful stream.

Texts are equal when they are identical after lower-casing A-Z; null counts
as empty. Of equal texts the row with the largest document id stays.

1. A Structured Streaming query reads the table's files and keeps one state
   entry per SHA-256 digest of the normalised text, in RocksDB on disk, with
   no watermark and so no expiry. An entry holds the digest, the stable
   identifier (largest document id so far), the content locator (file and
   row of that document's text) and the number of rows. Copies are folded
   inside each task before they are shuffled, so a text that a third of all
   rows share is one state row per task. The checkpoint lives in the shared
   folder: a restarted query goes on where it stopped, and files that arrive
   later meet the old state.
2. Hits (digests of two rows or more) are checked on full bytes: their texts
   are grouped by digest *and* whole text (copies collapse in each task). A
   digest with more than one text is split into one group per text. With a
   state of earlier runs, a kept text in a file that no longer lies under the
   path (a folder per day, say) is read through its locator and compared too.
3. Every row then looks up its group.

Defined cases: null ids come last (they stay only in a group without other
ids); a kept text that cannot be read through its locator any more (the file is
gone, or holds another row there) leaves ``checked`` false: its group is told by
digest alone; where different texts share a digest, ``group_size`` counts the
rows that can be read; of rows with equal text and equal id the one with the greater locator
stays, so exactly one row of each group is kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm.common import ascii_lower, quoted
from wordmill.plans.physical import bounded_broadcast, materialize, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Only changes since the last snapshot are uploaded after a batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # No space is reserved ahead: there is a store for each shuffle partition,
    # and many of them are small.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# Every micro-batch takes at most so many files; later batches meet the state
# of the earlier ones.
MAX_FILES_PER_BATCH = 10_000


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text.cast("string"), F.lit("")))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _keyed(rows: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """``digest, keeper, text`` of a file-backed frame (batch or stream)."""
    locator = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    text = normalised(quoted(text_col))
    return rows.select(
        digest(text).alias("digest"),
        F.struct(quoted(id_col).cast("bigint").alias("id"), locator.alias("locator")).alias("keeper"),
        text.alias("text"),
    )


# Files of any age are read; the file source's default drops what is 7 days
# older than the newest file.
MAX_FILE_AGE = "36500d"


def _any_file(path: str) -> str:
    """A glob that matches ``path`` alone: a file stream takes a single file
    only as a match of a pattern."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def stream_state(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_files_per_batch: int = MAX_FILES_PER_BATCH,
    digest=sha256,
) -> DataFrame:
    """Run the stream over all files under ``path`` that ``checkpoint`` has
    not seen, and return the state: ``digest, keeper, n``."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        source = (
            spark.readStream.schema(spark.read.parquet(path).schema)
            .option("maxFilesPerTrigger", max_files_per_batch)
            .option("maxFileAge", MAX_FILE_AGE)
            .parquet(_any_file(path))
        )
        state = (
            _keyed(source, id_col, text_col, digest)
            .groupBy("digest")
            .agg(F.max("keeper").alias("keeper"), F.count(F.lit(1)).alias("n"))
        )
        query = (
            state.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        # The reader opens the RocksDB files of the checkpoint on the
        # executors; its two value fields are the two aggregates in order.
        stored = materialize(spark.read.format("statestore").load(checkpoint).select("key", "value"), "dedup-state")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    keeper, n = (F.col("value")[f.name] for f in stored.schema["value"].dataType.fields)
    return stored.select(F.col("key.digest").alias("digest"), keeper.alias("keeper"), n.alias("n"))


def _readable(spark: SparkSession, urls: list[str]) -> list[str]:
    """The files among ``urls`` (encoded, as in the locators) that exist, as
    paths for the reader, which takes them for patterns."""
    jvm, found = spark._jvm, []
    for url in urls:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(url))
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            found.append(re.sub(r"([\[\]{}*?\\])", r"\\\1", path.toString()))
    return found


def _left_behind(
    spark: SparkSession, state: DataFrame, rows: DataFrame, schema, id_col: str, text_col: str, digest
) -> tuple[DataFrame, DataFrame]:
    """Hits whose kept text lies in no file of ``rows``: their ``digest`` and
    ``keeper``, and the texts read through the locators (``digest, keeper,
    text``). Only names of files pass the driver."""
    here = rows.select(F.col("keeper.locator.file").alias("file")).distinct()
    kept = state.filter(F.col("n") > 1).select("digest", "keeper", F.col("keeper.locator.file").alias("file"))
    gone = materialize(kept.join(here, "file", "left_anti"), "dedup-gone")
    paths = _readable(spark, [r["file"] for r in gone.select("file").distinct().collect()])
    gone = gone.drop("file")
    if not paths:
        return gone, rows.limit(0)
    older = _keyed(spark.read.schema(schema).parquet(*paths), id_col, text_col, digest)
    # The row at the locator must still be the one that the state knows.
    known = gone.select(F.col("digest").alias("d"), F.col("keeper").alias("k"))
    return gone, older.join(known, (F.col("digest") == F.col("d")) & F.col("keeper").eqNullSafe(F.col("k")), "left_semi")


def dedup_exact(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    checkpoint: str | None = None,
    max_files_per_batch: int = MAX_FILES_PER_BATCH,
    digest=sha256,
) -> DataFrame:
    """Per row of the Parquet table at ``path``: ``doc_id, keep_id,
    group_size, kept, digest, keep_file, keep_row, checked``.

    ``checkpoint`` names a state to go on with; by default the run gets its
    own under the shared checkpoint folder.
    """
    table = spark.read.parquet(path)
    state = stream_state(
        spark, path, checkpoint or scratch_path(spark, "dedup-stream"), id_col, text_col, max_files_per_batch, digest
    )
    rows = _keyed(table, id_col, text_col, digest)
    groups = state.select("digest", F.col("keeper").alias("stays"), "n")

    hits = bounded_broadcast(state.filter(F.col("n") > 1).select("digest"))
    compared = rows
    if checkpoint:
        gone, older = _left_behind(spark, state, rows, table.schema, id_col, text_col, digest)
        compared = rows.unionByName(older)
    texts = compared.join(hits, "digest", "left_semi").groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
    mixed = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n_texts")).filter(F.col("n_texts") > 1)
    mixed = materialize(mixed.select("digest"), "dedup-mixed")

    # Every row has a state, or the run fails.
    missing = F.raise_error(F.concat(F.lit("dedup_exact: no state for the digest "), F.hex("digest"))).cast("boolean")
    result = rows.drop("text").join(groups, "digest", "left").filter(F.when(F.col("n").isNotNull(), F.lit(True)).otherwise(missing))
    if not mixed.isEmpty():
        # Different texts under one digest: their rows are grouped by text.
        by_text = rows.join(mixed, "digest", "left_semi")
        split = compared.join(mixed, "digest", "left_semi").groupBy("digest", "text").agg(F.max("keeper").alias("stays"), F.count(F.lit(1)).alias("n"))
        result = result.join(mixed, "digest", "left_anti").unionByName(
            by_text.join(split, ["digest", "text"]).drop("text")
        )
    if checkpoint:
        unread = gone.join(older.select("digest"), "digest", "left_anti").select("digest", F.lit(False).alias("checked"))
        result = result.join(unread, "digest", "left").withColumn("checked", F.col("checked").isNull())
    else:
        result = result.withColumn("checked", F.lit(True))
    return result.select(
        F.col("keeper.id").alias("doc_id"),
        F.col("stays.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("keeper") == F.col("stays")).alias("kept"),
        "digest",
        F.col("stays.locator.file").alias("keep_file"),
        F.col("stays.locator.row").alias("keep_row"),
        "checked",
    )
