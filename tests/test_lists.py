"""Long keyword and channel lists."""

import random

import pytest
from pyspark.sql import functions as F

from wordmill.operators import occurrences as O
from wordmill.operators import selection as S


def found(df):
    return sorted((r.video_id, r.line_no, r.keyword, r.line) for r in df.collect())


def lines(spark):
    rng = random.Random(6)
    words = ["Kot", "KOTY", "straße", "STRASSE", "İstanbul", "istanbul", "ΟΔΟΣ", "οδος", "ὈΔΟΣΑ", "a.b", "x\\Ey", "Kelvin", "ſo", "so", "ŻÓŁW", "żółw", "日本", "", "ß"]
    rows = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 6))) for _ in range(3))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "kot " * 20_000), (503, "KOT\nkot")]
    return spark.createDataFrame(rows, "video_id long, text string").repartition(3)


KEYWORDS = ["kot", "Koty", "strasse", "straße", "istanbul", "οδος", "οδοσ", "a.b", "x\\Ey", "so", "S", "żół", "日本", "日", "t k", "kelvin", "ß", "none", "kot"]


def test_list_equals_the_patterns(spark):
    """Each keyword quoted, one pattern after the other."""
    texts = lines(spark)
    quoted = [f"\\Q{k.replace(chr(92) + 'E', chr(92) + 'E' + chr(92) * 2 + 'E' + chr(92) + 'Q')}\\E" for k in sorted(set(KEYWORDS))]
    plain = dict(zip(quoted, sorted(set(KEYWORDS))))
    want = sorted((a, b, plain[k], d) for a, b, k, d in found(O.keyword_occurrences(texts, quoted)))
    assert found(O.keyword_list_occurrences(texts, KEYWORDS)) == want and len(want) > 300
    assert found(O.keyword_list_occurrences(texts, KEYWORDS, slice_keywords=4)) == want


def test_no_keywords(spark):
    assert found(O.keyword_list_occurrences(lines(spark), ["", ""])) == []
    assert found(O.keyword_list_occurrences(lines(spark).limit(0), KEYWORDS)) == []


def test_long_list_is_one_join(spark):
    """A thousand keywords: the plan has one join and no keyword in its text."""
    words = [f"keyword{i}" for i in range(1000)] + ["kot"]
    hits = O.keyword_list_occurrences(lines(spark), words)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "keyword77" not in plan
    assert {r.keyword for r in hits.collect()} == {"kot"}


@pytest.mark.parametrize("as_frame", [False, True])
def test_long_channel_list(spark, as_frame):
    videos = spark.range(1000).select(
        F.col("id").cast("string").alias("video_id"), F.lit("t").alias("title"), F.lit("d").alias("description"),
        F.lit("2025-01-01T00:00:00Z").alias("published_at"), F.lit("c").alias("channel_id"),
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("name "), F.col("id") % 100)).alias("channel_name"),
    )
    names = [f"name {i}" for i in range(50)] + [f"other {i}" for i in range(100_000)] + ["name 3", "NAME 60"]
    channels = spark.createDataFrame([(n,) for n in [*names, None]], "n string") if as_frame else [*names, None]
    got = S.select_videos(videos, channels=channels, start_date="2024-12-31")
    assert got.columns == videos.columns
    assert "other 77" not in got._jdf.queryExecution().toString()
    want = S.select_videos(videos, channels=names[:50], start_date="2024-12-31")
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() == 450
