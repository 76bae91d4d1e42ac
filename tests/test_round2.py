"""State versions, file tree, CSV lists, wall-clock dates, matrix totals."""

import datetime as dt
import os

import pytest

from wordmill import jobs, schemas
from wordmill.operators import analytics as A
from wordmill.operators import selection as S
from wordmill.operators.tokens import drop_stopwords, model_normalizer
from wordmill.sources import readers as R
from wordmill.sources import writers as W


def test_matrix_total_is_the_sum_of_the_cells(spark):
    days = [(dt.date(2025, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(100)]
    trend = spark.createDataFrame([("w", d, 1) for d in days] + [("late", days[99], 2)], "word string, date string, count long")
    for n in (64, 65):
        rows = {r["word"]: r for r in A.trend_matrix(trend, days[:n]).collect()}
        assert rows["w"]["total"] == n == sum(rows["w"][d] for d in days[:n])
        assert rows["late"]["total"] == 0
    assert {r["word"]: r["total"] for r in A.trend_matrix(trend).collect()} == {"w": 100, "late": 2}


def test_matrix_query_fails_on_a_day_without_a_column(spark, monkeypatch):
    from wordmill.plans import catalog

    days = [*catalog.MATRIX_DAYS, None]
    monkeypatch.setattr(catalog, "trend", lambda *_: spark.createDataFrame([("w", d, 1) for d in days], "word string, date string, count long"))
    assert [(r["word"], r["total"]) for r in catalog.q_trend_matrix(spark, "").collect()] == [("w", 30)]
    days.append("2024-01-31")
    with pytest.raises(Exception, match="no column for the day 2024-01-31"):
        catalog.q_trend_matrix(spark, "").collect()


def test_state_table_keeps_empty_versions(spark, scratch):
    table = W.StateTable(f"{scratch}/s", schemas.WATERMARKS)
    row = spark.createDataFrame([("p", "a", "1")], schemas.WATERMARKS)
    none = spark.createDataFrame([], schemas.WATERMARKS)
    table.write(none, 0)
    assert table.read(spark).count() == 0
    table.write(row, 1)
    table.write(none, 2)  # the state was cleared
    assert table.read(spark).count() == 0
    assert table.read(spark, before=2).count() == 1
    for v in range(3, 20):
        table.write(row, v)
    assert table.versions(spark) == [15, 16, 17, 18, 19]


def test_tree_reads_every_name(spark, scratch):
    base = f"{scratch}/my tree"
    files = {("UCa", "_v2"): "x", ("UCa", "v3"): "", ("kanał x", "v 4"): "ż\n", ("a+b%20", ".v5"): "y"}
    for (channel, video), text in files.items():
        os.makedirs(f"{base}/{channel}", exist_ok=True)
        with open(f"{base}/{channel}/{video}.txt", "w", encoding="utf-8") as f:
            f.write(text)
    open(f"{base}/direct.txt", "w").close()
    got = {(r["channel_id"], r["video_id"]): r["text"] for r in R.read_transcript_tree(spark, base).collect()}
    assert got == files


def video(video_id, description="d"):
    return (video_id, "t", description, "2025-01-01T00:00:00Z", "UC", "n")


def test_csv_lists_go_by_header(spark, scratch):
    with open(f"{scratch}/list.csv", "w") as f:
        f.write("channel_id,video_id,title\nUC1,v1,one\n")
    row = R.read_video_list(spark, f"{scratch}/list.csv").first()
    assert (row["video_id"], row["channel_id"], row["title"], row["published_at"]) == ("v1", "UC1", "one", None)


def test_csv_append_and_blanks(spark, scratch):
    target = f"{scratch}/out"
    rows = spark.createDataFrame([video("v1", '  lead "q" trail \nv2,trap')], schemas.VIDEOS)
    W.append_new(rows, target, fmt="csv")
    W.append_new(spark.createDataFrame([video("v2")], schemas.VIDEOS), target, fmt="csv")
    got = {r["video_id"]: r["description"] for r in R.read_video_list(spark, target).collect()}
    assert got == {"v1": '  lead "q" trail \nv2,trap', "v2": "d"}
    before = sorted(os.listdir(target))
    W.append_new(rows, target, fmt="csv")  # nothing new: nothing written
    assert sorted(os.listdir(target)) == before


@pytest.mark.parametrize("zone", ["UTC", "Europe/Warsaw", "America/New_York"])
def test_dates_are_wall_clock(spark, zone):
    texts = ["2025-01-29 00:30:00", "2025-01-28 23:30:00", "2025-01-29T01:00:00+02:00", "2025-01-29T00:00:00Z",
             "2025-01-28T23:59:59.5-0500", "2025-01-29", "bad", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, published_at string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert [r["i"] for r in frame.filter(S.start_condition("2025-01-29")).collect()] == [0, 2, 3, 5]
        assert [r["i"] for r in frame.filter(S.end_condition("2025-01-29")).collect()] == [1, 3, 4, 5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stop_word_frame_and_list_agree(spark):
    words = spark.createDataFrame([("the",), ("cat",)], "word string")
    frame = spark.createDataFrame([("The ",), ("",), (None,)], "w string")
    for stop in (["The ", ""], frame):
        assert [r["word"] for r in drop_stopwords(words, stop).collect()] == ["cat"]


def test_cache_needs_a_named_model(spark, scratch):
    spark.createDataFrame([video("v1")], schemas.VIDEOS).write.csv(f"{scratch}/l", header=True)
    with pytest.raises(ValueError, match="cache_key"):
        jobs.analyze_frequency(spark, f"{scratch}/l", f"{scratch}/t", f"{scratch}/o", cache_dir=f"{scratch}/c",
                               normalizer=model_normalizer(lambda: str.split))
