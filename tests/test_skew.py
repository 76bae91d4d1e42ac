"""Hot keys: the salted joins give the same results when every key is hot,
and they really spread a hot key over several join buckets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import assemble
from wordmill.operators import attempts as T
from wordmill.operators.transcripts import clean_blocks, segments_to_text
from wordmill.plans.physical import salted_join


@pytest.fixture
def all_hot(spark):
    spark.conf.set("wordmill.skew.hotKeyRows", "2")
    spark.conf.set("wordmill.skew.saltBuckets", "4")
    yield
    spark.conf.unset("wordmill.skew.hotKeyRows")
    spark.conf.unset("wordmill.skew.saltBuckets")


def log(spark, n=400, videos=3, seed=5):
    rng = random.Random(seed)
    base = dt.datetime(2025, 1, 1)
    rows = [(f"v{rng.randint(0, videos - 1)}", base + dt.timedelta(seconds=i), rng.random() < 0.2, i) for i in range(n)]
    return spark.createDataFrame(rows, "video_id string, at timestamp_ntz, ok boolean, seq int"), rows


def replay(rows):
    state = {}
    for v, at, ok, _ in rows:
        if ok:
            state.pop(v, None)
        else:
            a, _ = state.get(v, (0, None))
            state[v] = (a + 1, at)
    return state


def test_fold_with_hot_videos(spark, all_hot):
    df, rows = log(spark)
    got = {r["video_id"]: (r["attempts"], r["last_attempt"]) for r in T.fold_attempts(df, "seq").collect()}
    assert got == replay(rows)


def test_merge_with_hot_videos(spark, all_hot):
    df, rows = log(spark, seed=9)
    first = df.filter(F.col("seq") < 250)
    second = df.filter(F.col("seq") >= 250)
    merged = T.merge_attempts(T.fold_attempts(first, "seq"), second, "seq")
    assert {r["video_id"]: (r["attempts"], r["last_attempt"]) for r in merged.collect()} == replay(rows)


def test_clean_blocks_with_hot_video(spark, all_hot):
    segs = [("v", i, float(i), " x " if i % 3 else " ") for i in range(40)]
    df = spark.createDataFrame(segs, "video_id string, ord int, start double, text string")
    whole = assemble(segments_to_text(df, block_rows=1000)).first()["text"]
    import re
    expected = re.sub(r"\[\d+:\d+\]", "", whole.lower()).strip()
    assert assemble(clean_blocks(segments_to_text(df, block_rows=3))).first()["text"] == expected


def test_salted_join_spreads_hot_key(spark, all_hot):
    big = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id"))
    keyed = spark.createDataFrame([("hot", 1000, "payload")], "k string, n long, p string")
    out = salted_join(big, keyed, ["k"], "inner", "n", ["id"])
    assert out.count() == 1000 and out.filter(F.col("p") == "payload").count() == 1000
    # The hot key's rows use every salt bucket.
    bucket = F.pmod(F.xxhash64("id"), F.lit(4))
    assert big.select(bucket.alias("b")).distinct().count() == 4


def test_outcomes_with_hot_listed_video(spark, all_hot):
    vids = spark.createDataFrame([("a", "R")] * 30 + [("b", "R"), ("c", "S")], "video_id string, channel_name string")
    state = spark.createDataFrame([("c", 6, dt.datetime(2025, 1, 1))], "video_id string, attempts bigint, last_attempt timestamp_ntz")
    landed = spark.createDataFrame([("a",)], "video_id string")
    fetched = spark.createDataFrame([("b", 2, True)], "video_id string, n_segments bigint, saved boolean")
    out = T.classify_outcomes(vids, state, landed, fetched, "2025-02-01 00:00:00")
    got = sorted((r["video_id"], r["outcome"]) for r in out.collect())
    assert got == [("a", "already_landed")] * 30 + [("b", "downloaded"), ("c", "backoff_skip")]
    counts = {r["channel_name"]: (r["downloaded"], r["missing"]) for r in T.outcome_counts(out).collect()}
    assert counts == {"R": (31, 0), "S": (0, 1)}


@pytest.mark.parametrize("how", ["left", "left_anti", "inner", "left_semi"])
def test_salted_join_null_keys(spark, all_hot, how):
    # A third of the rows have a null key: they match nothing, keep (left,
    # anti) or lose (inner, semi) their row exactly as in a plain join, and
    # are spread over many salts instead of one task.
    big = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 5).cast("string")).alias("k"), "id")
    keyed = spark.createDataFrame([(str(i), f"p{i}") for i in range(3)], "k string, p string")
    got = sorted((tuple(r) for r in salted_join(big, keyed, ["k"], how, None, ["id"]).collect()), key=repr)
    want = sorted((tuple(r) for r in big.join(keyed, "k", how).collect()), key=repr)
    assert got == want
    salts = big.filter(F.col("k").isNull()).select(F.pmod(F.xxhash64("id"), F.lit(1 << 16)).alias("s")).distinct().count()
    assert salts > 250


def test_hot_list_is_bounded(spark, all_hot, monkeypatch):
    """Keys beyond the hot list's length are joined without salt."""
    monkeypatch.setattr("wordmill.plans.physical.HOT_KEYS_MAX", 1)
    big = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(5)] + [("c", 9)], "k string, id int")
    keyed = spark.createDataFrame([("a", 5, "x"), ("b", 5, "y"), ("d", 0, "z")], "k string, n int, v string")
    for count_col in ("n", None):
        got = salted_join(big, keyed, ["k"], "left", count_col, ["id"]).groupBy("k", "v").count().collect()
        assert sorted((r["k"], r["v"], r["count"]) for r in got if r["v"]) == [("a", "x", 5), ("b", "y", 5)]
        assert [r["count"] for r in got if r["v"] is None] == [1]


def test_repeated_listing_keeps_every_row(spark, all_hot):
    vids = spark.createDataFrame([("a",), ("a",), ("a",), (None,), ("b",)], "video_id string")
    state = spark.sql("SELECT 'a' AS video_id, 6L AS attempts, TIMESTAMP_NTZ '2025-01-01 00:00:00' AS last_attempt")
    got = T.retry_status(vids, state, "2025-02-01 00:00:00").collect()
    rows = sorted((str(r["video_id"]), r["attempts"], r["eligible"]) for r in got)
    assert rows == [("None", None, True), ("a", 6, False), ("a", 6, False), ("a", 6, False), ("b", None, True)]
