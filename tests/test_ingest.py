"""Ingest (FIXTURES §5): K1, F6, A7, S6, J9-J11."""

from pyspark.sql import functions as F

from wordmill import schemas
from wordmill.operators import ingest as I
from wordmill.sources.writers import StateTable, append_new


def item(vid, ts, title="t"):
    return {"snippet": {"title": title, "description": "d", "publishedAt": ts, "resourceId": {"videoId": vid}}}


def pages_df(spark, pages):
    return spark.createDataFrame(pages, schemas.PAGE)


def sources_df(spark):
    return spark.createDataFrame(
        [("playlists", "PL1", "UCa", "Radio A"), ("channels", "UCb", "UCb", "Radio B")], schemas.SOURCES
    )


def test_append_dedup(spark, scratch):
    target = f"{scratch}/videos"
    first = spark.createDataFrame([("v1", "a")], "video_id string, title string")
    append_new(first, target)
    batch = spark.createDataFrame([("v1", "a"), ("v2", "b"), ("v2", "b")], "video_id string, title string")
    append_new(batch, target)
    assert sorted(r["video_id"] for r in spark.read.parquet(target).collect()) == ["v1", "v2", "v2"]
    append_new(batch, target)  # second run adds nothing
    assert spark.read.parquet(target).count() == 3


def test_append_absent_target_keeps_batch_duplicates(spark, scratch):
    target = f"{scratch}/new"
    batch = spark.createDataFrame([("v1",), ("v1",)], "video_id string")
    append_new(batch, target, fmt="csv")
    assert spark.read.option("header", True).csv(target).count() == 2


def test_watermark_filter_and_advance(spark):
    pages = pages_df(spark, [
        {"source_type": "playlists", "source_id": "PL1",
         "items": [item("a", "2025-01-29T10:00:00Z"), item("b", "2025-01-29T10:00:01Z")]},
        {"source_type": "playlists", "source_id": "PL1", "items": None},
    ])
    wm = spark.createDataFrame([("playlists", "PL1", "2025-01-29T10:00:00Z"), ("playlists", "PL9", "2024-01-01T00:00:00Z")], schemas.WATERMARKS)
    res = I.ingest_batch(pages, sources_df(spark), None, wm)
    assert [r["video_id"] for r in res.rows.collect()] == ["b"]
    assert res.rows.first()["channel_name"] == "Radio A"
    new = {r["source_id"]: r["last_date"] for r in res.watermarks.collect()}
    assert new == {"PL1": "2025-01-29T10:00:01Z", "PL9": "2024-01-01T00:00:00Z"}


def test_no_kept_items_leaves_watermark(spark):
    pages = pages_df(spark, [{"source_type": "playlists", "source_id": "PL1", "items": [item("a", "2025-01-01T00:00:00Z")]}])
    wm = spark.createDataFrame([("playlists", "PL1", "2025-01-29T10:00:00Z")], schemas.WATERMARKS)
    res = I.ingest_batch(pages, sources_df(spark), None, wm)
    assert res.rows.count() == 0
    assert res.watermarks.first()["last_date"] == "2025-01-29T10:00:00Z"


def test_channel_path_ignores_watermark_but_is_monotone(spark):
    pages = pages_df(spark, [{"source_type": "channels", "source_id": "UCb", "items": [item("a", "2025-01-01T00:00:00Z")]}])
    wm = spark.createDataFrame([("channels", "UCb", "2025-01-29T10:00:00Z")], schemas.WATERMARKS)
    res = I.ingest_batch(pages, sources_df(spark), None, wm, use_watermark=False)
    assert res.rows.count() == 1
    assert res.watermarks.first()["last_date"] == "2025-01-29T10:00:00Z"


def test_resolve_identifiers(spark):
    channels = spark.createDataFrame(
        [("UC1", "Radio A", "up1"), ("UC2", "Radio B", "up2"), ("UC0", "Radio B", "up0")],
        "channel_id string, channel_name string, uploads string",
    )
    idents = spark.createDataFrame([("UC1",), ("Radio B",), ("UC9",), ("Nope",)], "identifier string")
    out = {r["identifier"]: (r["channel_id"], r["channel_name"], r["uploads"], r["status"]) for r in I.resolve_identifiers(idents, channels).collect()}
    assert out["UC1"] == ("UC1", "Radio A", "up1", "resolved")
    assert out["Radio B"] == ("UC0", "Radio B", "up0", "resolved")  # best hit: lowest id
    assert out["UC9"][3] == "unresolved" and out["Nope"][3] == "unresolved"


def test_state_table_versions(spark, scratch):
    t = StateTable(f"{scratch}/wm", schemas.WATERMARKS)
    assert t.read(spark).count() == 0
    t.write(spark.createDataFrame([("p", "a", "1")], schemas.WATERMARKS), 0)
    t.write(spark.createDataFrame([("p", "a", "2")], schemas.WATERMARKS), 1)
    t.write(spark.createDataFrame([("p", "a", "3")], schemas.WATERMARKS), 1)  # replay rewrites its version
    assert [r["last_date"] for r in t.read(spark).collect()] == ["3"]


def test_resolve_identifiers_shuffle_path_agrees(spark):
    # A zero byte bound forces the salted shuffle joins; with a hot-key
    # threshold of 2 the repeated identifiers and the null keys are salted.
    channels = spark.createDataFrame(
        [("UC1", "Radio A", "up1"), ("UC2", "Radio B", "up2"), ("UC0", "Radio B", "up0")],
        "channel_id string, channel_name string, uploads string",
    )
    idents = spark.createDataFrame(
        [(i, v) for i, v in enumerate(["UC1", "Radio B", "UC9", "Nope", "UC1", "Radio B", "Radio B", None])],
        "n int, identifier string",
    )
    cols = ["n", "identifier", "channel_id", "channel_name", "uploads", "status"]
    want = sorted(tuple(r) for r in I.resolve_identifiers(idents, channels).select(*cols).collect())
    spark.conf.set("wordmill.broadcast.maxBytes", "0")
    spark.conf.set("wordmill.skew.hotKeyRows", "2")
    try:
        got = sorted(tuple(r) for r in I.resolve_identifiers(idents, channels).select(*cols).collect())
    finally:
        spark.conf.unset("wordmill.broadcast.maxBytes")
        spark.conf.unset("wordmill.skew.hotKeyRows")
    assert got == want
    assert [r for r in got if r[1] == "UC9"][0][5] == "unresolved"
