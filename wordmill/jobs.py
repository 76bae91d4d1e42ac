"""Job-level entry points: the original scripts' workflows as Spark jobs.

Each function reads its inputs, runs the operators and writes its outputs;
every parameter is an explicit argument (paths, ``now``, thresholds).

| original workflow | function |
| --- | --- |
| build the analysis list (keywords, channels, dates) | :func:`build_analysis_list` |
| word frequency (counts, top-N, word-cloud weights) | :func:`analyze_frequency` |
| word trend (trend rows, top-N series, matrix) | :func:`analyze_trend` |
| transcript count and size profile | :func:`profile_transcripts` |
| ingest every channel and playlist | :func:`ingest_listed` (from the list files), :func:`ingest_sources` |
| land transcripts with retry bookkeeping | :func:`land_transcripts` |
| take over a tree of text files | :func:`import_transcripts` |
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill import schemas
from wordmill.constants import DEFAULT_MIN_LENGTH, DEFAULT_TOP_N, DEFAULT_TREND_TOP_N
from wordmill.functions.time import day_of
from wordmill.metrics import JobMetrics
from wordmill.operators import analytics, attempts, ingest, profile, selection, transcripts
from wordmill.operators.tokens import Normalizer, regex_tokens
from wordmill.plans.physical import bounded_broadcast, materialize, materialized
from wordmill.sources import bucketed, readers, writers


def build_analysis_list(
    spark: SparkSession,
    list_paths: Sequence[str],
    output: str,
    keywords: Sequence[str] | None = None,
    channels: Sequence[str] | DataFrame | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    fmt: str = "csv",
    metrics: JobMetrics | None = None,
) -> DataFrame:
    """Union the video lists (missing files are empty), filter, overwrite
    ``output``. Returns the selected rows as written. Metrics: ``loaded`` rows
    of all lists, ``kept`` rows."""
    metrics = metrics or JobMetrics()
    videos = metrics.count(readers.read_video_lists(spark, *list_paths), "loaded")
    chosen = metrics.count(selection.select_videos(videos, keywords, channels, start_date, end_date), "kept")
    writers.write_list(chosen, output, fmt)
    return readers.read_video_list(spark, output) if fmt == "csv" else spark.read.format(fmt).load(output)


def _corpus(
    spark: SparkSession,
    list_path: str,
    transcripts_path: str,
    metrics: JobMetrics | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Listed videos joined to the landed transcript blocks (or to those in
    ``files``), cleaned. Transcripts in buckets are joined where they lie."""
    listed = readers.read_video_list(spark, list_path)
    if metrics:
        dated = F.coalesce(F.col("published_at") != "", F.lit(False))
        rejected = dated & day_of("published_at").isNull()
        listed = metrics.count(listed, "listed", undated=~dated, rejected_days=rejected)
    table = bucketed.open_bucketed(spark, transcripts_path)
    if files is not None:
        reader = spark.read.schema(schemas.TRANSCRIPT_BLOCKS).option("basePath", transcripts_path)
        corpus = analytics.corpus(listed, reader.parquet(*files))
    elif table is not None:
        texts = table.join(listed.select(*analytics.TRANSCRIPT_KEYS, "published_at"))
        corpus = texts.select("video_id", "published_at", "text")
    else:
        corpus = analytics.corpus(listed, readers.read_table(spark, transcripts_path, schemas.TRANSCRIPT_BLOCKS))
    # Cleaning is per line except the final strip, which only touches the
    # ends of the text; tokens never span a block boundary.
    return analytics.cleaned(metrics.count(corpus, "blocks") if metrics else corpus)


def _missing(spark: SparkSession, list_path: str, transcripts_path: str) -> DataFrame:
    """The coverage report: listed videos without a transcript."""
    listed = readers.read_video_list(spark, list_path)
    return analytics.missing_transcripts(listed, readers.read_table(spark, transcripts_path, schemas.TRANSCRIPT_BLOCKS))


@dataclass
class FrequencyResult:
    counts: DataFrame
    top: DataFrame
    cloud: DataFrame
    missing: DataFrame
    metrics: dict[str, int]


def analyze_frequency(
    spark: SparkSession,
    list_path: str,
    transcripts_path: str,
    output: str,
    stopwords_path: str | None = None,
    top_n: int = DEFAULT_TOP_N,
    min_length: int = DEFAULT_MIN_LENGTH,
    normalizer: Normalizer = regex_tokens,
    cache_dir: str | None = None,
) -> FrequencyResult:
    """Word counts of the listed transcripts, sorted and written to
    ``output/counts``; top-N and word-cloud weights under ``output``.

    With ``cache_dir`` the counts are kept as partial counts per group of
    transcript files while the list, the stop words and the parameters are
    unchanged: only files that landed since the last run are counted
    (``writers.PartialCounts``). Metrics: ``listed`` videos, ``blocks`` joined,
    ``words`` counted, ``files`` counted (with a cache).
    """
    stop = readers.read_stopwords(spark, stopwords_path)
    metrics = JobMetrics()

    def compute(files: Sequence[str] | None = None) -> DataFrame:
        corpus = _corpus(spark, list_path, transcripts_path, metrics, files)
        return analytics.word_frequency(corpus, normalizer=normalizer, stopwords=stop, min_len=min_length)

    if cache_dir:
        paths = [list_path] + ([stopwords_path] if stopwords_path else [])
        name = getattr(normalizer, "cache_key", None)
        if name is None:
            raise ValueError("a cached analysis needs a normalizer with a cache_key that names its model or table")
        key = writers.fingerprint(spark, paths, {"min_length": min_length, "normalizer": name, "transcripts": transcripts_path})
        partial = writers.PartialCounts(cache_dir, key, schemas.WORDS)
        counts = partial.update(spark, transcripts_path, compute)
        metrics.put("files", len(partial.counted))
        # The sum over the generations feeds three outputs.
        counts = materialize(metrics.count(counts, "words"), "counts")
    else:
        counts = materialize(metrics.count(compute(), "words"), "counts")
    writers.write_counts(counts, f"{output}/counts")
    top = analytics.top_words(counts, top_n)
    cloud = analytics.word_cloud_weights(counts)
    writers.write_list(top, f"{output}/top")
    writers.write_list(cloud, f"{output}/cloud")
    return FrequencyResult(counts, top, cloud, _missing(spark, list_path, transcripts_path), metrics.values())


@dataclass
class TrendResult:
    trend: DataFrame
    series: DataFrame
    matrix: DataFrame
    metrics: dict[str, int]


def analyze_trend(
    spark: SparkSession,
    list_path: str,
    transcripts_path: str,
    output: str,
    stopwords_path: str | None = None,
    top_n: int = DEFAULT_TREND_TOP_N,
    min_length: int = DEFAULT_MIN_LENGTH,
    normalizer: Normalizer = regex_tokens,
) -> TrendResult:
    """Per-day word counts (``output/trend``, date order), the top-N series
    (``output/series``) and the word x day matrix (``output/matrix``). The
    trend is written once and both reports read it back.

    Metrics: ``listed`` videos; of these ``undated`` (no publish time) and
    ``rejected_days`` (a publish time whose first ten characters are no day),
    which the trend leaves out; ``blocks`` joined; ``rows`` of the trend."""
    stop = readers.read_stopwords(spark, stopwords_path)
    metrics = JobMetrics()
    corpus = _corpus(spark, list_path, transcripts_path, metrics)
    trend = analytics.word_trend(corpus, normalizer=normalizer, stopwords=stop, min_len=min_length)
    trend = materialize(metrics.count(trend, "rows"), "trend")
    writers.write_trend(trend, f"{output}/trend")
    series = analytics.top_series(trend, top_n)
    writers.write_list(series, f"{output}/series")
    matrix = analytics.trend_matrix(trend)
    writers.write_matrix(matrix, f"{output}/matrix")
    return TrendResult(trend, series, matrix, metrics.values())


@dataclass
class ProfileResult:
    files: DataFrame
    sizes: DataFrame


def profile_transcripts(spark: SparkSession, transcripts_path: str) -> ProfileResult:
    """Transcripts per channel and the six-bin size histogram of the full
    per-video texts."""
    blocks = readers.read_table(spark, transcripts_path, schemas.TRANSCRIPT_BLOCKS)
    sizes = profile.transcript_sizes(blocks)
    return ProfileResult(profile.files_per_channel(sizes), profile.size_histogram(sizes, size_col="size"))


def import_transcripts(spark: SparkSession, base_dir: str, transcripts_path: str, metrics: JobMetrics | None = None) -> None:
    """Land a folder tree of ``<channel>/<video>.txt`` files: their lines in
    blocks, as if they had been fetched. Videos that have landed already are
    left as they are. Metrics: ``files`` read, ``landed`` videos."""
    metrics = metrics or JobMetrics()
    texts = metrics.count(readers.read_transcript_tree(spark, base_dir), "files")
    there = readers.read_table(spark, transcripts_path, schemas.TRANSCRIPT_BLOCKS).select(*analytics.TRANSCRIPT_KEYS)
    new = metrics.count(texts.join(there, list(analytics.TRANSCRIPT_KEYS), "left_anti"), "landed")
    blocks = transcripts.text_to_blocks(new, analytics.TRANSCRIPT_KEYS)
    _land(spark, blocks.select("channel_id", "video_id", "block", "text"), transcripts_path, None)


@dataclass
class IngestReport:
    unresolved: DataFrame  # listed identifiers that name no known channel
    metrics: dict[str, int]


def ingest_sources(
    spark: SparkSession,
    pages_path: str,
    sources: DataFrame,
    channel_target: str,
    playlist_target: str,
    watermark_path: str,
    version: int,
    metrics: JobMetrics | None = None,
) -> None:
    """Every channel (full re-scan, dedup by id) and every playlist
    (watermark filter) from landed pages, in two jobs over all sources;
    rows appended with dedup, then one new watermark version. Metrics:
    ``pages`` read, ``items`` past the watermark."""
    pages = readers.read_pages(spark, pages_path)
    table = writers.StateTable(watermark_path, schemas.WATERMARKS)
    _ingest(pages, sources, channel_target, playlist_target, table, version, metrics or JobMetrics())


def _ingest(
    pages: DataFrame,
    sources: DataFrame,
    channel_target: str,
    playlist_target: str,
    table: writers.StateTable,
    version: int,
    metrics: JobMetrics,
) -> None:
    spark = pages.sparkSession
    old = table.read(spark, before=version)  # a re-run of this version starts from the same state
    merged = old
    for source_type, target, use_wm in (("channels", channel_target, False), ("playlists", playlist_target, True)):
        part = metrics.count(pages.filter(F.col("source_type") == source_type), "pages")
        result = ingest.ingest_batch(part, sources, None, old, use_wm)
        writers.append_indexed(metrics.count(result.rows, "items"), target)
        merged = result.watermarks.unionByName(merged).groupBy("source_type", "source_id").agg(
            F.max("last_date").alias("last_date")
        )
    table.write(merged, version)


def ingest_listed(
    spark: SparkSession,
    channels_file: str,
    playlists_file: str,
    pages_path: str,
    channels: DataFrame,
    playlists: DataFrame,
    channel_target: str,
    playlist_target: str,
    watermark_path: str,
    version: int | None = None,
) -> IngestReport:
    """The whole ingest: the ids of both list files (D4), channel identifiers
    resolved by id or name (J9, J11), and the pages of these sources ingested.

    ``channels(channel_id, channel_name)`` and ``playlists(playlist_id,
    channel_id, channel_name)`` are the directories. Pages of sources that no
    list names are left out. ``version`` is that of the watermarks, by default
    the next one. Metrics: ``channels`` and ``playlists`` listed,
    ``unresolved``, ``pages``, ``items`` and ``videos`` appended."""
    metrics = JobMetrics()
    ids = metrics.count(readers.read_id_list(spark, channels_file), "channels")
    named = ingest.resolve_identifiers(ids.withColumnRenamed("source_id", "identifier"), channels)
    named = materialize(metrics.count(named, None, unresolved=F.col("status") == "unresolved"), "ingest-channels")
    lists = metrics.count(readers.read_id_list(spark, playlists_file), "playlists")
    known = playlists.select(F.col("playlist_id").alias("source_id"), "channel_id", "channel_name")
    sources = (
        named.filter("status = 'resolved'")
        .select(F.lit("channels").alias("source_type"), F.col("channel_id").alias("source_id"), "channel_id", "channel_name")
        .unionByName(lists.join(known, "source_id", "left").select(F.lit("playlists").alias("source_type"), "source_id", "channel_id", "channel_name"))
        .distinct()
    )
    sources = materialize(sources, "ingest-sources")
    table = writers.StateTable(watermark_path, schemas.WATERMARKS)
    if version is None:
        version = max(table.versions(spark), default=-1) + 1
    before = sum(_rows(spark, t) for t in (channel_target, playlist_target))
    listed_pages = readers.read_pages(spark, pages_path).join(bounded_broadcast(sources), list(ingest.SOURCE_KEYS), "left_semi")
    with materialized(listed_pages, "ingest-pages") as pages:
        _ingest(pages, sources, channel_target, playlist_target, table, version, metrics)
    metrics.put("videos", sum(_rows(spark, t) for t in (channel_target, playlist_target)) - before)
    return IngestReport(named.filter("status = 'unresolved'").select("identifier"), metrics.values())


def _rows(spark: SparkSession, target: str) -> int:
    """Rows of a Parquet target, from the files' footers."""
    return spark.read.parquet(target).count() if readers.path_exists(spark, target) else 0


def _land(spark: SparkSession, blocks: DataFrame, path: str, buckets: int | None) -> None:
    """Append transcript blocks; a folder in buckets stays so."""
    table = bucketed.open_bucketed(spark, path)
    if table is None and buckets and not readers.path_exists(spark, path):
        table = bucketed.create_bucketed(spark, path, schemas.TRANSCRIPT_BLOCKS, analytics.TRANSCRIPT_KEYS, buckets)
    if table is not None:
        table.append(blocks)
    else:
        writers.write_transcripts(blocks, path)


def land_transcripts(
    spark: SparkSession,
    list_path: str,
    fetched: DataFrame,
    transcripts_path: str,
    attempt_log_path: str,
    now: str,
    languages: Sequence[str] | None = None,
    state_path: str | None = None,
    buckets: int | None = None,
    metrics: JobMetrics | None = None,
) -> DataFrame:
    """One landing round.

    ``fetched`` holds what the downloader returned this round:
    ``video_id, channel_id, segments ARRAY<STRUCT<start, text>>``, and with
    ``languages`` a ``lang`` column: of several transcripts of a video the one
    whose language comes first in ``languages`` is taken (D10). Videos
    are classified (back-off skip, already landed, downloaded, unavailable),
    new transcripts are appended as text blocks, the attempt log gets this round's
    entries, and the per-channel outcome counts are returned.

    With ``state_path`` the retry state is kept there and this round's entries
    are merged into it, in place of folding the whole log (a missing or damaged
    state is folded from the log once). ``buckets`` makes a new transcript
    folder one in buckets (``sources.bucketed``). Metrics: ``listed`` videos and
    the videos of each outcome.
    """
    metrics = metrics or JobMetrics()
    listed = readers.read_video_list(spark, list_path, ["video_id", "channel_id", "channel_name", "published_at"])
    log = readers.read_table(spark, attempt_log_path, schemas.ATTEMPT_LOG)
    table = writers.StateTable(state_path, schemas.ATTEMPTS) if state_path else None
    version = table.latest_version(spark) if table else None
    state = attempts.fold_attempts(log) if version is None else table.read(spark)
    if version is None and table:
        state = materialize(state, "attempt-state")
    if languages:
        fetched = attempts.language_preference(fetched, languages, keys=("video_id",))
    landed = readers.read_table(spark, transcripts_path, schemas.TRANSCRIPT_BLOCKS).select("video_id")
    seg_rows = transcripts.segments_from_arrays(fetched, keys=("video_id", "channel_id"))
    counts = fetched.select("video_id", F.coalesce(F.size("segments"), F.lit(0)).cast("bigint").alias("n_segments"), F.lit(True).alias("saved"))
    outcomes = attempts.classify_outcomes(listed, state, landed, counts, now)
    kinds = {kind: F.col("outcome") == kind for kind in attempts.OUTCOMES}
    outcomes = materialize(metrics.count(outcomes, "listed", **kinds), "outcomes")
    new_ids = outcomes.filter(F.col("outcome") == "downloaded").select("video_id").distinct()
    new_segments = seg_rows.join(new_ids, "video_id", "left_semi")
    blocks = transcripts.segments_to_text(new_segments, keys=("video_id", "channel_id"))
    _land(spark, blocks.select("channel_id", "video_id", "block", "text"), transcripts_path, buckets)
    entries = attempts.attempt_entries(outcomes, now)
    writers.append_log(entries, attempt_log_path)
    if table:
        table.write(attempts.merge_attempts(state, entries), max(table.versions(spark), default=-1) + 1)
    return attempts.outcome_counts(outcomes)
