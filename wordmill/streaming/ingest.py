"""D1 / D2 as Structured Streaming jobs over landed API pages.

``readStream.json(landing)`` -> ``foreachBatch`` -> append new video rows
and a new watermark version. With ``trigger(availableNow=True)`` one call
processes everything landed since the last run and stops (the scheduled,
incremental behaviour of the original fetchers); with a processing-time
trigger it runs continuously.

Exactly-once: the video rows are written first, the watermark second. A
micro-batch replayed after a failure skips rows already appended (anti join
against the target) and rewrites its own watermark version, so the result
is the same as a single successful run.

State versions are the stream's batch ids, so a state table belongs to one
checkpoint location: a stream started over with a fresh checkpoint needs a
fresh state path (or a copy of the last version written as version -1).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wordmill import schemas
from wordmill.operators.ingest import ingest_batch
from wordmill.sources.writers import StateTable, append_indexed


def ingest_microbatch(
    sources: DataFrame, target_path: str, watermark_path: str, use_watermark: bool = True
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body of the ingest stream.

    Rows first, watermark version ``batch_id`` second. The batch starts
    from the watermark version before its own, so a replay (after a failure
    at any point) sees the state of the first attempt; rows it already
    appended are skipped by the anti join against the target, which reads
    only the files that may hold a key of the batch (``writers.append_indexed``).
    """
    wm_table = StateTable(watermark_path, schemas.WATERMARKS)

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        old = wm_table.read(session, before=batch_id)
        result = ingest_batch(batch, sources, None, old, use_watermark)
        append_indexed(result.rows, target_path)
        wm_table.write(result.watermarks, batch_id)

    return process


def start_ingest(
    spark: SparkSession,
    landing_dir: str,
    sources: DataFrame,
    target_path: str,
    watermark_path: str,
    checkpoint_location: str,
    use_watermark: bool = True,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingest stream; returns the running query.

    ``sources``: static ``(source_type, source_id, channel_id, channel_name)``.
    ``use_watermark=False`` is the channel path (no watermark filter).
    """
    reader = spark.readStream.schema(schemas.PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.json(landing_dir)
    process = ingest_microbatch(sources, target_path, watermark_path, use_watermark)
    writer = pages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
