"""Streaming wrappers (D1-D3, D9): availableNow runs over landed files."""

import datetime as dt
import json
import os

from wordmill import schemas
from wordmill.operators import attempts as T
from wordmill.sources.writers import StateTable
from wordmill.streaming.attempts import read_attempt_state, start_attempt_state
from wordmill.streaming.ingest import start_ingest


def land(folder, name, pages):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")


def item(vid, ts):
    return {"snippet": {"title": vid, "description": "", "publishedAt": ts, "resourceId": {"videoId": vid}}}


def test_ingest_stream_incremental(spark, scratch):
    landing, target, wm, ckpt = (os.path.join(scratch, n) for n in ("landing", "videos", "wm", "ckpt"))
    sources = spark.createDataFrame([("playlists", "PL1", "UCa", "Radio A")], schemas.SOURCES)
    land(landing, "p1.json", [{"source_type": "playlists", "source_id": "PL1",
                               "items": [item("v1", "2025-01-29T10:00:00Z"), item("v2", "2025-01-29T11:00:00Z"), item("v2", "2025-01-29T11:00:00Z")]}])
    start_ingest(spark, landing, sources, target, wm, ckpt).awaitTermination()
    assert sorted(r["video_id"] for r in spark.read.parquet(target).collect()) == ["v1", "v2", "v2"]
    # A second page repeats v1 (old) and adds v3 (newer than the watermark).
    land(landing, "p2.json", [{"source_type": "playlists", "source_id": "PL1",
                               "items": [item("v1", "2025-01-29T10:00:00Z"), item("v3", "2025-01-30T09:00:00Z")]}])
    start_ingest(spark, landing, sources, target, wm, ckpt).awaitTermination()
    assert sorted(r["video_id"] for r in spark.read.parquet(target).collect()) == ["v1", "v2", "v2", "v3"]
    assert StateTable(wm, schemas.WATERMARKS).read(spark).first()["last_date"] == "2025-01-30T09:00:00Z"
    # Nothing new: a third run appends nothing.
    start_ingest(spark, landing, sources, target, wm, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == 4


def test_attempt_state_stream(spark, scratch):
    logdir, state, ckpt = (os.path.join(scratch, n) for n in ("log", "state", "ckpt2"))
    t = lambda s: dt.datetime.fromisoformat(s)
    first = [("x", t("2025-01-01 00:00:01"), False), ("x", t("2025-01-01 00:00:02"), False), ("y", t("2025-01-01 00:00:03"), False)]
    second = [("x", t("2025-01-01 00:00:04"), True), ("x", t("2025-01-01 00:00:05"), False), ("y", t("2025-01-01 00:00:06"), False)]
    spark.createDataFrame(first, schemas.ATTEMPT_LOG).write.mode("append").parquet(logdir)
    start_attempt_state(spark, logdir, state, ckpt).awaitTermination()
    spark.createDataFrame(second, schemas.ATTEMPT_LOG).write.mode("append").parquet(logdir)
    start_attempt_state(spark, logdir, state, ckpt).awaitTermination()
    got = {r["video_id"]: (r["attempts"], r["last_attempt"]) for r in read_attempt_state(spark, state).collect()}
    whole = spark.createDataFrame(first + second, schemas.ATTEMPT_LOG)
    assert got == {r["video_id"]: (r["attempts"], r["last_attempt"]) for r in T.fold_attempts(whole).collect()}
    assert got == {"x": (1, t("2025-01-01 00:00:05")), "y": (2, t("2025-01-01 00:00:06"))}


def test_replayed_attempt_batch_counts_once(spark, scratch):
    """A batch that failed after its rows were written runs again."""
    logdir, state, ckpt = (os.path.join(scratch, n) for n in ("log", "state", "ckpt3"))
    t = lambda s: dt.datetime.fromisoformat(s)
    for i, rows in enumerate(([("x", t("2025-01-01 00:00:01"), False)], [("x", t("2025-01-01 00:00:02"), False), ("y", t("2025-01-01 00:00:03"), False)])):
        spark.createDataFrame(rows, schemas.ATTEMPT_LOG).write.mode("append").parquet(logdir)
        start_attempt_state(spark, logdir, state, ckpt).awaitTermination()
    # Undo the commit of the last batch, as if the run had died before it.
    for name in ("1", ".1.crc"):
        os.remove(os.path.join(ckpt, "commits", name))
    start_attempt_state(spark, logdir, state, ckpt).awaitTermination()
    assert {r["video_id"]: r["attempts"] for r in read_attempt_state(spark, state).collect()} == {"x": 2, "y": 1}


def test_replayed_ingest_batch_is_harmless(spark, scratch):
    from wordmill.streaming.ingest import ingest_microbatch

    target, wm = os.path.join(scratch, "videos"), os.path.join(scratch, "wm")
    sources = spark.createDataFrame([("playlists", "PL1", "UCa", "Radio A")], schemas.SOURCES)
    process = ingest_microbatch(sources, target, wm)
    page = [("playlists", "PL1", [{"snippet": {"title": "v1", "description": "", "publishedAt": "2025-01-29T10:00:00Z", "resourceId": {"videoId": "v1"}}}])]
    batch = spark.createDataFrame(page, schemas.PAGE)
    process(batch, 0)
    process(batch, 0)
    assert [r["video_id"] for r in spark.read.parquet(target).collect()] == ["v1"]
    assert StateTable(wm, schemas.WATERMARKS).read(spark).first()["last_date"] == "2025-01-29T10:00:00Z"
