"""Command line for the batch workflows, for ``spark-submit`` or ``python -m wordmill``.

    select   --lists A.csv B.csv --output DIR [--keywords ..] [--channels ..]
             [--start-date YYYY-MM-DD] [--end-date YYYY-MM-DD]
    analyze  --mode frequency|trend --input LIST --transcripts DIR --output DIR
             [--top N] [--min-length N] [--stopwords FILE] [--cache-dir DIR]
    profile  --transcripts DIR --output DIR
    ingest   --channels FILE --playlists FILE --pages DIR --channel-directory DIR
             --playlist-directory DIR --channel-videos DIR --playlist-videos DIR
             --watermarks DIR
    land     --input LIST --fetched DIR --transcripts DIR --log DIR --now TIME
             [--state DIR] [--languages ..] [--buckets N] [--output DIR]
    import   --tree DIR --transcripts DIR

Every command runs one job layer function (:mod:`wordmill.jobs`); the
session comes from ``spark-submit`` (its master and settings win); a plain
``python -m wordmill`` run may pass ``--master`` (Spark's default is
``local[*]``).
Filters default to none: only the conditions given are applied. Commands print
their row counts as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from wordmill import jobs
from wordmill.constants import DEFAULT_MIN_LENGTH, DEFAULT_TOP_N, DEFAULT_TREND_TOP_N
from wordmill.metrics import JobMetrics
from wordmill.session import build_session
from wordmill.sources import writers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wordmill", description="Transcript and corpus analytics on Spark")
    p.add_argument("--master", default=None, help="Spark master when not run by spark-submit")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("select", help="union video lists, filter, write the analysis list")
    s.add_argument("--lists", nargs="+", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--keywords", nargs="+")
    s.add_argument("--channels", nargs="+")
    s.add_argument("--start-date")
    s.add_argument("--end-date")

    a = sub.add_parser("analyze", help="word frequency or word trend of the listed transcripts")
    a.add_argument("--mode", choices=["frequency", "trend"], default="frequency")
    a.add_argument("--input", required=True, help="analysis list (CSV)")
    a.add_argument("--transcripts", required=True, help="landed transcript blocks (Parquet)")
    a.add_argument("--output", required=True)
    a.add_argument("--top", type=int, help=f"top words (default {DEFAULT_TOP_N}; trend {DEFAULT_TREND_TOP_N})")
    a.add_argument("--min-length", type=int, default=DEFAULT_MIN_LENGTH)
    a.add_argument("--stopwords", help="custom stop-word file, one word per line")
    a.add_argument("--cache-dir", help="reuse frequency counts while the inputs are unchanged")

    i = sub.add_parser("ingest", help="video metadata of the listed channels and playlists from landed API pages")
    i.add_argument("--channels", required=True, help="file of channel ids or names, # starts a comment")
    i.add_argument("--playlists", required=True, help="file of playlist ids")
    i.add_argument("--pages", required=True, help="landed API pages (JSON lines)")
    i.add_argument("--channel-directory", required=True, help="Parquet: channel_id, channel_name")
    i.add_argument("--playlist-directory", required=True, help="Parquet: playlist_id, channel_id, channel_name")
    i.add_argument("--channel-videos", required=True)
    i.add_argument("--playlist-videos", required=True)
    i.add_argument("--watermarks", required=True)

    t = sub.add_parser("land", help="one landing round of fetched transcripts")
    t.add_argument("--input", required=True, help="analysis list (CSV)")
    t.add_argument("--fetched", required=True, help="Parquet: video_id, channel_id, segments and, with --languages, lang")
    t.add_argument("--transcripts", required=True)
    t.add_argument("--log", required=True, help="attempt log")
    t.add_argument("--now", required=True, help="UTC wall clock, YYYY-MM-DD HH:MM:SS")
    t.add_argument("--state", help="retry state; without it the log is folded")
    t.add_argument("--languages", nargs="+", help="preferred first")
    t.add_argument("--buckets", type=int, help="make a new transcript folder one in so many buckets")
    t.add_argument("--output", help="outcome counts per channel")

    m = sub.add_parser("import", help="take over a tree of <channel>/<video>.txt files")
    m.add_argument("--tree", required=True)
    m.add_argument("--transcripts", required=True)

    f = sub.add_parser("profile", help="transcripts per channel and the size histogram")
    f.add_argument("--transcripts", required=True)
    f.add_argument("--output", required=True)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(args.master)
    metrics = JobMetrics()
    if args.command == "select":
        jobs.build_analysis_list(
            spark, args.lists, args.output, keywords=args.keywords, channels=args.channels,
            start_date=args.start_date, end_date=args.end_date, metrics=metrics,
        )
        counts = metrics.values()
    elif args.command == "analyze" and args.mode == "frequency":
        counts = jobs.analyze_frequency(
            spark, args.input, args.transcripts, args.output, stopwords_path=args.stopwords,
            top_n=args.top or DEFAULT_TOP_N, min_length=args.min_length, cache_dir=args.cache_dir,
        ).metrics
    elif args.command == "analyze":
        counts = jobs.analyze_trend(
            spark, args.input, args.transcripts, args.output, stopwords_path=args.stopwords,
            top_n=args.top or DEFAULT_TREND_TOP_N, min_length=args.min_length,
        ).metrics
    elif args.command == "ingest":
        report = jobs.ingest_listed(
            spark, args.channels, args.playlists, args.pages,
            spark.read.parquet(args.channel_directory), spark.read.parquet(args.playlist_directory),
            args.channel_videos, args.playlist_videos, args.watermarks,
        )
        counts = report.metrics
    elif args.command == "land":
        landed = jobs.land_transcripts(
            spark, args.input, spark.read.parquet(args.fetched), args.transcripts, args.log, args.now,
            languages=args.languages, state_path=args.state, buckets=args.buckets, metrics=metrics,
        )
        if args.output:
            writers.write_list(landed.orderBy("channel_name"), args.output)
        counts = metrics.values()
    elif args.command == "import":
        jobs.import_transcripts(spark, args.tree, args.transcripts, metrics)
        counts = metrics.values()
    else:
        prof = jobs.profile_transcripts(spark, args.transcripts)
        writers.write_list(prof.files.orderBy("channel_id"), f"{args.output}/files")
        writers.write_list(prof.sizes.orderBy("bin_no"), f"{args.output}/sizes")
        counts = {}
    if counts:
        print(json.dumps(counts))


if __name__ == "__main__":
    main(sys.argv[1:])
