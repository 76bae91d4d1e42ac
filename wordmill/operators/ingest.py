"""Incremental ingest of video metadata.

The original fetches API pages per source in a loop; here the pages are
landed JSON records ``{source_type, source_id, items: [...]}`` and one job
handles every source at once (D4). ``ingest_batch`` is the pure core used by
both the batch entry point and the streaming ``foreachBatch`` wrapper.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.constants import CHANNEL_ID_PREFIX, VIDEO_COLUMNS
from wordmill.plans.physical import bounded_broadcast, fits_broadcast, salted_join

SOURCE_KEYS = ("source_type", "source_id")


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per API item: ``video_id, title, description,
    published_at`` plus the page's source keys. A page without ``items``
    gives no rows."""
    items = pages.select(*SOURCE_KEYS, F.explode("items").alias("item"))
    snippet = F.col("item.snippet")
    return items.select(
        snippet["resourceId"]["videoId"].alias("video_id"),
        snippet["title"].alias("title"),
        snippet["description"].alias("description"),
        snippet["publishedAt"].alias("published_at"),
        *SOURCE_KEYS,
    )


def attach_source(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Channel id and name of each item's source, in the video-list
    column order. One row per source, broadcast after a size check."""
    dim = bounded_broadcast(sources.select(*SOURCE_KEYS, "channel_id", "channel_name"))
    joined = items.join(dim, list(SOURCE_KEYS), "left")
    return joined.select(*VIDEO_COLUMNS, *SOURCE_KEYS)


def is_channel_id(c) -> F.Column:
    """F16: identifiers starting with ``UC`` are ids, others are names."""
    col = F.col(c) if isinstance(c, str) else c
    return col.startswith(CHANNEL_ID_PREFIX)


def resolve_identifiers(
    identifiers: DataFrame,
    channels: DataFrame,
    ident_col: str = "identifier",
    rank_col: str | None = None,
) -> DataFrame:
    """J9 + J11: resolve channel identifiers against a channel dimension
    ``channels(channel_id, channel_name, ...)``.

    Ids are looked up by id (giving the name); names by name, keeping the
    best hit only (lowest ``rank_col``, else lowest id). Extra dimension
    columns (e.g. the uploads playlist) come along. Rows that resolve to
    nothing get ``status = 'unresolved'`` instead of failing the job.
    The best hit per name is a grouped ``min_by`` (partial aggregation, one
    row kept per name), never a collected group.
    """
    extra = [c for c in channels.columns if c not in ("channel_id", "channel_name")]
    rank = F.col(rank_col) if rank_col else F.col("channel_id")
    best = channels.groupBy("channel_name").agg(
        F.min_by(F.struct("channel_id", *extra), F.struct(rank, F.col("channel_id"))).alias("_hit")
    )
    by_name = best.select(
        F.col("channel_name").alias("_n_name"),
        F.col("_hit.channel_id").alias("_n_id"),
        *[F.col(f"_hit.{c}").alias(f"_n_{c}") for c in extra],
    )
    by_id = channels.select(
        F.col("channel_id").alias("_i_id"),
        F.col("channel_name").alias("_i_name"),
        *[F.col(c).alias(f"_i_{c}") for c in extra],
    )
    ident = F.col(ident_col)
    kind_id = is_channel_id(ident)
    # The channel dimension is normally small: broadcast after a size check
    # (a hot identifier then never meets a shuffle). Both lookup sides come
    # from ``channels`` with no more rows and no wider rows, so one check of
    # the dimension bounds both.
    if fits_broadcast(channels):
        out = identifiers.join(F.broadcast(by_id), kind_id & (ident == F.col("_i_id")), "left")
        out = out.join(F.broadcast(by_name), ~kind_id & (ident == F.col("_n_name")), "left")
    else:
        # Shuffle joins. Each lookup is an equi-join on a key that is null
        # for the other identifier kind; by_name is an aggregate, so AQE
        # cannot split a hot identifier, and all null keys would meet in one
        # task: salted joins spread hot keys (null included) over many tasks.
        keyed = identifiers.select(
            "*", F.when(kind_id, ident).alias("_i_id"), F.when(~kind_id, ident).alias("_n_name")
        )
        cols = list(keyed.columns)
        out = salted_join(keyed, by_id.withColumn("_i_hit", F.lit(True)), ["_i_id"], "left", None, cols)
        out = salted_join(out, by_name.withColumn("_n_hit", F.lit(True)), ["_n_name"], "left", None, cols)
        # The key columns come from the identifier side: keep them only on a match.
        out = out.withColumn("_i_id", F.when(F.col("_i_hit"), F.col("_i_id"))).withColumn(
            "_n_name", F.when(F.col("_n_hit"), F.col("_n_name"))
        )
    channel_id = F.when(kind_id, F.col("_i_id")).otherwise(F.col("_n_id"))
    channel_name = F.when(kind_id, F.col("_i_name")).otherwise(F.col("_n_name"))
    cols = [c for c in identifiers.columns]
    extras = [F.when(kind_id, F.col(f"_i_{c}")).otherwise(F.col(f"_n_{c}")).alias(c) for c in extra]
    return out.select(
        *cols,
        channel_id.alias("channel_id"),
        channel_name.alias("channel_name"),
        *extras,
        F.when(channel_id.isNull(), F.lit("unresolved")).otherwise(F.lit("resolved")).alias("status"),
    )


def after_watermark(items: DataFrame, watermarks: DataFrame) -> DataFrame:
    """F6 + J6: keep items published strictly after their source's
    watermark; a source without a watermark keeps everything.

    ISO-8601 UTC strings of one format order like time, so the comparison is
    on the text, as the original does.
    """
    wm = watermarks.select(*SOURCE_KEYS, F.col("last_date").alias("_last"))
    joined = items.join(bounded_broadcast(wm), list(SOURCE_KEYS), "left")
    keep = F.col("_last").isNull() | (F.col("published_at") > F.col("_last"))
    return joined.filter(keep).drop("_last")


def new_rows(batch: DataFrame, existing: DataFrame | None, key: str = "video_id") -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``.

    Duplicates inside the batch are kept (the original appends them all).
    The target side is a plain key projection (no ``distinct``): both join
    inputs stay raw shuffles, so AQE can split a hot batch key over several
    tasks, and an anti join needs only one match per key.
    """
    if existing is None:
        return batch
    return batch.join(existing.select(key), key, "left_anti")


def advance_watermarks(old: DataFrame | None, kept: DataFrame) -> DataFrame:
    """A7 + K7: new watermark per source = greatest(old, max published_at of
    the kept items). Sources with no kept items keep their old value; the
    value never moves backwards."""
    batch = kept.groupBy(*SOURCE_KEYS).agg(F.max("published_at").alias("_new"))
    if old is None:
        return batch.select(*SOURCE_KEYS, F.col("_new").alias("last_date"))
    prev = old.select(*SOURCE_KEYS, F.col("last_date").alias("_old"))
    merged = prev.join(batch, list(SOURCE_KEYS), "full_outer")
    return merged.select(*SOURCE_KEYS, F.greatest("_old", "_new").alias("last_date"))


@dataclass
class IngestResult:
    rows: DataFrame  # rows to append to the video list
    watermarks: DataFrame  # full new watermark table


def ingest_batch(
    pages: DataFrame,
    sources: DataFrame,
    existing: DataFrame | None,
    watermarks: DataFrame | None,
    use_watermark: bool = True,
) -> IngestResult:
    """D1 / D2 / D3 for every source in ``pages`` at once.

    ``use_watermark=True`` is the playlist path (items at or before the
    watermark are skipped); ``False`` is the channel path (full re-scan,
    dedup by id only, watermark still advanced).
    """
    items = flatten_pages(pages)
    if use_watermark and watermarks is not None:
        items = after_watermark(items, watermarks)
    items = attach_source(items, sources)
    rows = new_rows(items, existing).select(*VIDEO_COLUMNS, *SOURCE_KEYS)
    return IngestResult(rows=rows, watermarks=advance_watermarks(watermarks, items))
