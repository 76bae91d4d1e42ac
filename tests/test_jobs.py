"""The job layer end to end on the FIXTURES data: list -> landing rounds ->
frequency / trend / profile."""

import csv
import os

from tests.fixtures import CHANNEL_LIST, PLAYLIST_LIST
from wordmill import jobs
from wordmill.constants import VIDEO_COLUMNS

NOW = "2025-02-01 12:00:00"


def write_csv(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(VIDEO_COLUMNS)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def fetched(spark):
    rows = [
        ("v1", "UCa", [(0.0, "Kot widzi psa."), (7.0, "Pies widzi kota, KOT!")]),
        ("v2", "UCa", [(4503.0, "pies i kot")]),
        ("v3", "UCa", []),
        ("v4", "UCb", [(1.0, "kot oraz dom")]),
    ]
    return spark.createDataFrame(rows, "video_id string, channel_id string, segments array<struct<start:double,text:string>>")


def test_jobs_end_to_end(spark, scratch):
    ch, pl = os.path.join(scratch, "channel.csv"), os.path.join(scratch, "playlist.csv")
    write_csv(ch, CHANNEL_LIST)
    write_csv(pl, PLAYLIST_LIST)
    selected = jobs.build_analysis_list(spark, [ch, pl], os.path.join(scratch, "sel"), keywords=["wybory"], channels=["Radio A"], start_date="2025-01-29")
    assert sorted(r["video_id"] for r in selected.collect()) == ["v1", "v1"]

    # The analysis list: v1-v4 (FIXTURES §3).
    listing = os.path.join(scratch, "list.csv")
    write_csv(listing, [r for r in CHANNEL_LIST] + [PLAYLIST_LIST[0]])
    tdir, logdir = os.path.join(scratch, "transcripts"), os.path.join(scratch, "attempts")
    counts = {r["channel_name"]: (r["downloaded"], r["missing"]) for r in jobs.land_transcripts(spark, listing, fetched(spark), tdir, logdir, NOW).collect()}
    assert counts == {"Radio A": (2, 1), "Radio B": (1, 0)}
    # Second round one minute later: landed videos count as success, v3 was
    # tried once 60 s ago (wait 60 s) -> eligible again, still unavailable.
    counts = {r["channel_name"]: (r["downloaded"], r["missing"]) for r in jobs.land_transcripts(spark, listing, fetched(spark), tdir, logdir, "2025-02-01 12:01:00").collect()}
    assert counts == {"Radio A": (2, 1), "Radio B": (1, 0)}
    # Third round 10 s later: v3 has 2 failures, wait 3600 s -> back-off skip.
    counts = {r["channel_name"]: (r["downloaded"], r["missing"]) for r in jobs.land_transcripts(spark, listing, fetched(spark), tdir, logdir, "2025-02-01 12:01:10").collect()}
    assert counts == {"Radio A": (2, 1), "Radio B": (1, 0)}
    assert spark.read.parquet(logdir).filter("video_id = 'v3'").count() == 2
    assert spark.read.parquet(tdir).count() == 3

    out = os.path.join(scratch, "freq")
    freq = jobs.analyze_frequency(spark, listing, tdir, out, cache_dir=os.path.join(scratch, "cache"))
    assert {r["word"]: r["count"] for r in freq.counts.collect()} == {"kot": 4, "pies": 2, "widzi": 2, "dom": 1, "kota": 1, "psa": 1}
    assert [r["video_id"] for r in freq.missing.collect()] == ["v3"]
    written = spark.read.option("header", True).csv(f"{out}/counts").collect()
    assert [r["word"] for r in written][:3] == ["kot", "pies", "widzi"]
    again = jobs.analyze_frequency(spark, listing, tdir, out, cache_dir=os.path.join(scratch, "cache"))
    assert sorted(map(tuple, again.counts.collect())) == sorted(map(tuple, freq.counts.collect()))

    trend = jobs.analyze_trend(spark, listing, tdir, os.path.join(scratch, "trend"), top_n=2)
    matrix = [tuple(r) for r in spark.read.option("header", True).csv(os.path.join(scratch, "trend", "matrix")).collect()]
    assert matrix[0] == ("dom", "0", "1", "1") and len(matrix) == 6
    assert [r["word"] for r in trend.series.collect()][:2] == ["kot", "kot"]

    prof = jobs.profile_transcripts(spark, tdir)
    assert {r["channel_id"]: r["files"] for r in prof.files.collect()} == {"UCa": 2, "UCb": 1}
    assert [r["files"] for r in prof.sizes.orderBy("bin_no").collect()] == [3, 0, 0, 0, 0, 0]


def test_ingest_sources(spark, scratch):
    import json

    from wordmill import schemas
    from wordmill.sources.writers import StateTable

    def item(v, ts):
        return {"snippet": {"title": v, "description": "", "publishedAt": ts, "resourceId": {"videoId": v}}}

    pages = os.path.join(scratch, "pages")
    os.makedirs(pages)
    with open(os.path.join(pages, "p.json"), "w") as f:
        f.write(json.dumps({"source_type": "channels", "source_id": "UCa", "items": [item("a1", "2025-01-01T00:00:00Z"), item("a2", "2025-01-02T00:00:00Z")]}) + "\n")
        f.write(json.dumps({"source_type": "playlists", "source_id": "PL1", "items": [item("p1", "2025-01-03T00:00:00Z")]}) + "\n")
    sources = spark.createDataFrame([("channels", "UCa", "UCa", "Radio A"), ("playlists", "PL1", "UCb", "Radio B")], schemas.SOURCES)
    ch, pl, wm = (os.path.join(scratch, n) for n in ("ch", "pl", "wm"))
    jobs.ingest_sources(spark, pages, sources, ch, pl, wm, version=1)
    jobs.ingest_sources(spark, pages, sources, ch, pl, wm, version=2)  # a re-run adds nothing
    assert sorted(r["video_id"] for r in spark.read.parquet(ch).collect()) == ["a1", "a2"]
    assert [(r["video_id"], r["channel_name"]) for r in spark.read.parquet(pl).collect()] == [("p1", "Radio B")]
    marks = {r["source_id"]: r["last_date"] for r in StateTable(wm, schemas.WATERMARKS).read(spark).collect()}
    assert marks == {"UCa": "2025-01-02T00:00:00Z", "PL1": "2025-01-03T00:00:00Z"}


def test_command_line(spark, scratch):
    from wordmill.__main__ import main

    ch = os.path.join(scratch, "channel.csv")
    write_csv(ch, CHANNEL_LIST + PLAYLIST_LIST[:1])
    sel = os.path.join(scratch, "sel")
    main(["select", "--lists", ch, "--output", sel, "--channels", "Radio A"])
    assert sorted(r["video_id"] for r in spark.read.option("header", True).csv(sel).collect()) == ["v1", "v2", "v3"]
    tdir, logdir = os.path.join(scratch, "transcripts"), os.path.join(scratch, "attempts")
    jobs.land_transcripts(spark, ch, fetched(spark), tdir, logdir, NOW).collect()
    out = os.path.join(scratch, "freq")
    main(["analyze", "--mode", "frequency", "--input", ch, "--transcripts", tdir, "--output", out, "--top", "2"])
    assert [r["word"] for r in spark.read.option("header", True).csv(f"{out}/top").collect()] == ["kot", "pies"]
    main(["analyze", "--mode", "trend", "--input", ch, "--transcripts", tdir, "--output", os.path.join(scratch, "trend")])
    assert spark.read.option("header", True).csv(os.path.join(scratch, "trend", "matrix")).count() == 6
    main(["profile", "--transcripts", tdir, "--output", os.path.join(scratch, "prof")])
    sizes = spark.read.option("header", True).csv(os.path.join(scratch, "prof", "sizes")).collect()
    assert [int(r["files"]) for r in sizes] == [3, 0, 0, 0, 0, 0]
