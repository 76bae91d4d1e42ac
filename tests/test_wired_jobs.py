"""Ingest, landing and import from files to files, with their counts."""

import json
import os

from tests.fixtures import CHANNEL_LIST
from tests.test_jobs import NOW, write_csv
from wordmill import jobs, schemas
from wordmill.metrics import JobMetrics
from wordmill.operators import attempts
from wordmill.sources.writers import StateTable


def item(v, ts):
    return {"snippet": {"title": v, "description": "", "publishedAt": ts, "resourceId": {"videoId": v}}}


def test_ingest_from_the_list_files(spark, scratch):
    path = lambda name: os.path.join(scratch, name)
    with open(path("channels.txt"), "w") as f:
        f.write("# all\nUCa # by id\nRadio B\nUCnone\n\n")
    with open(path("playlists.txt"), "w") as f:
        f.write("PL1\n")
    os.makedirs(path("pages"))
    with open(path("pages/p.json"), "w") as f:
        for kind, source, ids in (("channels", "UCa", "a1 a2"), ("channels", "UCb", "b1"), ("channels", "UCother", "o1"), ("playlists", "PL1", "p1"), ("playlists", "PL9", "q1")):
            f.write(json.dumps({"source_type": kind, "source_id": source, "items": [item(v, "2025-01-01T00:00:00Z") for v in ids.split()]}) + "\n")
    channels = spark.createDataFrame([("UCa", "Radio A"), ("UCb", "Radio B")], "channel_id string, channel_name string")
    playlists = spark.createDataFrame([("PL1", "UCb", "Radio B")], "playlist_id string, channel_id string, channel_name string")
    channels.write.parquet(path("channel-directory"))
    playlists.write.parquet(path("playlist-directory"))
    run = lambda: jobs.ingest_listed(
        spark, path("channels.txt"), path("playlists.txt"), path("pages"), channels, playlists, path("cv"), path("pv"), path("wm")
    )
    report = run()
    assert [r["identifier"] for r in report.unresolved.collect()] == ["UCnone"]
    want = {"channels": 3, "unresolved": 1, "playlists": 1, "pages": 3, "items": 4, "videos": 4}
    assert report.metrics == want
    assert sorted((r["video_id"], r["channel_name"]) for r in spark.read.parquet(path("cv")).collect()) == [("a1", "Radio A"), ("a2", "Radio A"), ("b1", "Radio B")]
    assert [r["video_id"] for r in spark.read.parquet(path("pv")).collect()] == ["p1"]
    assert run().metrics["videos"] == 0  # nothing new
    from wordmill.__main__ import main

    main(["ingest", "--channels", path("channels.txt"), "--playlists", path("playlists.txt"), "--pages", path("pages"),
          "--channel-directory", path("channel-directory"), "--playlist-directory", path("playlist-directory"),
          "--channel-videos", path("cv"), "--playlist-videos", path("pv"), "--watermarks", path("wm")])
    assert spark.read.parquet(path("cv")).count() == 3


def test_landing_with_languages_and_state(spark, scratch):
    path = lambda name: os.path.join(scratch, name)
    write_csv(path("list.csv"), CHANNEL_LIST)
    rows = [("v1", "UCa", "en", [(0.0, "the cat")]), ("v1", "UCa", "pl", [(0.0, "kot")]), ("v2", "UCa", "fr", [(0.0, "chat")])]
    fetched = spark.createDataFrame(rows, "video_id string, channel_id string, lang string, segments array<struct<start:double,text:string>>")
    state = StateTable(path("state"), schemas.ATTEMPTS)
    for i, now in enumerate((NOW, "2025-02-01 12:05:00", "2025-02-01 14:00:00")):
        metrics = JobMetrics()
        jobs.land_transcripts(spark, path("list.csv"), fetched, path("t"), path("log"), now, languages=["pl", "en"], state_path=path("state"), metrics=metrics)
        found = metrics.values()
        assert found["listed"] == 3 and found["downloaded"] == (1 if i == 0 else 0) and found["already_landed"] == (i > 0)
        log = spark.read.schema(schemas.ATTEMPT_LOG).parquet(path("log"))
        as_set = lambda df: {tuple(r) for r in df.select("video_id", "attempts", "last_attempt").collect()}
        assert as_set(state.read(spark)) == as_set(attempts.fold_attempts(log))
    assert [r["text"] for r in spark.read.parquet(path("t")).collect()] == ["[0:00] kot"]


def test_tree_import_and_trend_rejects(spark, scratch):
    path = lambda name: os.path.join(scratch, name)
    long = "\n".join(f"[0:{i:02d}] word{i}" for i in range(600)) + "\n"
    for video, text in (("v1", long), ("v2", "kot"), ("v3", "pies pies")):
        os.makedirs(path("tree/UCa"), exist_ok=True)
        with open(path(f"tree/UCa/{video}.txt"), "w") as f:
            f.write(text)
    metrics = JobMetrics()
    jobs.import_transcripts(spark, path("tree"), path("t"), metrics)
    assert metrics.values() == {"files": 3, "landed": 3}
    jobs.import_transcripts(spark, path("tree"), path("t"))  # nothing new
    rows = spark.read.parquet(path("t")).filter("video_id = 'v1'").orderBy("block").collect()
    assert "\n".join(r["text"] for r in rows) == long and len(rows) == 3
    listed = [("v1", "a", "b", "2025-01-29T10:00:00Z", "UCa", "A"), ("v2", "a", "b", "2024-13-99T00:00:00Z", "UCa", "A"), ("v3", "a", "b", None, "UCa", "A")]
    write_csv(path("list.csv"), listed)
    trend = jobs.analyze_trend(spark, path("list.csv"), path("t"), path("out"))
    assert (trend.metrics["listed"], trend.metrics["rejected_days"], trend.metrics["undated"]) == (3, 1, 1)
    assert trend.metrics["rows"] == trend.trend.count() == 600
    chosen = JobMetrics()
    jobs.build_analysis_list(spark, [path("list.csv"), path("none.csv")], path("sel"), start_date="2025-01-01", metrics=chosen)
    assert chosen.values() == {"loaded": 3, "kept": 1}
