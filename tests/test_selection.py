"""Selection (FIXTURES §2): U1, F1-F5, Q8."""

import pytest

from tests.fixtures import CHANNEL_LIST, PLAYLIST_LIST, videos
from wordmill.operators.selection import select_videos, union_lists


@pytest.fixture
def lists(spark):
    return union_lists(videos(spark, CHANNEL_LIST), videos(spark, PLAYLIST_LIST))


CASES = [
    ({}, "v1 v1 v2 v3 v4 v5 v6"),
    ({"keywords": ["wybory"]}, "v1 v1 v3 v5"),
    ({"keywords": ["debata", "raport"]}, "v1 v1 v6"),
    ({"channels": ["Radio A"]}, "v1 v1 v2 v3"),
    ({"start_date": "2025-01-29"}, "v1 v1 v2 v4"),
    ({"start_date": "2025-01-29", "end_date": "2025-01-30"}, "v1 v1 v2"),
    ({"keywords": ["wybory"], "channels": ["Radio A"], "start_date": "2025-01-29"}, "v1 v1"),
    ({"end_date": "2025-01-30"}, "v1 v1 v2 v3"),
    ({"start_date": "2025-01-29", "end_date": "2025-01-30", "end_inclusive_day": True}, "v1 v1 v2 v4"),
]


@pytest.mark.parametrize("params,expected", CASES)
def test_selection(lists, params, expected):
    got = sorted(r["video_id"] for r in select_videos(lists, **params).collect())
    assert got == sorted(expected.split())


def test_published_at_text_kept(lists):
    rows = select_videos(lists, start_date="2025-01-29").collect()
    assert {r["published_at"] for r in rows} >= {"2025-01-29T10:00:00Z"}


def test_union_by_name_fills_missing(spark):
    a = videos(spark, CHANNEL_LIST)
    b = videos(spark, PLAYLIST_LIST).drop("description")
    out = union_lists(a, b)
    assert out.count() == 7
    assert out.filter("description is null").count() == 5  # v2 + the four playlist rows


def test_unicode_keyword_case(spark):
    df = videos(spark, [("v9", "ŻÓŁĆ news", None, None, "c", "C")])
    assert select_videos(df, keywords=["żółć"]).count() == 1


def test_literal_keywords(spark):
    df = videos(spark, [("a", "c++ talk", None, None, "c", "C"), ("b", "cpp", None, None, "c", "C")])
    assert [r["video_id"] for r in select_videos(df, keywords=["c++"], literal_keywords=True).collect()] == ["a"]


def test_selection_is_one_narrow_stage(lists):
    plan = select_videos(lists, keywords=["x"], channels=["Radio A"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_date_filter_independent_of_session_zone(spark, lists):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = sorted(r["video_id"] for r in select_videos(lists, start_date="2025-01-29", end_date="2025-01-30").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["v1", "v1", "v2"]
