"""Transcripts in buckets: the text is neither moved nor lost."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.test_jobs import NOW, fetched, write_csv
from tests.fixtures import CHANNEL_LIST, PLAYLIST_LIST
from wordmill import jobs, schemas
from wordmill.operators import analytics
from wordmill.sources import bucketed

KEYS = ("channel_id", "video_id")


def above_scan(plan, column):
    """Operators between the scan that reads ``column`` and the first join."""
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and re.search(rf"\b{column}#", line))
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    out, now = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < now:
            now = depth(line)
            if "Join" in line:
                return out
            out.append(line.strip(" :+-"))
    raise AssertionError("no join above the scan")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def blocks(spark, n=60):
    rows = spark.range(n * 40).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias("channel_id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % n)).alias("video_id"),
        F.floor(F.col("id") / 2).alias("block"),
        F.concat_ws(" ", F.lit("word"), "id").alias("text"),
    )
    return rows


def test_join_moves_no_text(spark, scratch, no_broadcast):
    table = bucketed.create_bucketed(spark, f"{scratch}/it's here", schemas.TRANSCRIPT_BLOCKS, KEYS, buckets=6, slots=8)
    everything = blocks(spark)
    table.append(everything.filter("block < 500"))
    table.append(everything.filter("block >= 500"))
    try:
        listed = spark.createDataFrame([("c0", "hot", "x"), ("c0", "hot", "x"), ("c1", "v7", None), ("c1", "none", "y"), (None, "hot", "z")], "channel_id string, video_id string, published_at string")
        joined = table.join(listed)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert not any("Exchange" in x or "Sort" in x for x in above_scan(plan, "text")), plan
        counted = analytics.word_trend(joined.withColumn("published_at", F.lit("2025-01-01")))
        assert not any("Exchange" in x for x in above_scan(counted._jdf.queryExecution().executedPlan().toString(), "text"))
        want = listed.join(everything, list(KEYS)).select(*joined.columns)
        assert sorted(joined.collect(), key=str) == sorted(want.collect(), key=str) and want.count() > 500
        # A hot video lies over several buckets.
        hot = table.read(spark).filter("video_id = 'hot'").select(F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1)).distinct()
        assert hot.count() > 2
    finally:
        table.forget(spark)
    # Another session knows the folder by its layout.
    again = bucketed.open_bucketed(spark, f"{scratch}/it's here")
    assert again == table and again.read(spark).count() == everything.count()
    with pytest.raises(ValueError):
        bucketed.create_bucketed(spark, f"{scratch}/it's here", schemas.TRANSCRIPT_BLOCKS, KEYS)
    again.forget(spark, delete=True)
    assert bucketed.open_bucketed(spark, f"{scratch}/it's here") is None


def test_jobs_with_buckets_equal_those_without(spark, scratch):
    listing = os.path.join(scratch, "list.csv")
    write_csv(listing, [*CHANNEL_LIST, PLAYLIST_LIST[0]])
    out = {}
    for name, buckets in (("plain", None), ("bucketed", 4)):
        tdir = os.path.join(scratch, name)
        log = os.path.join(scratch, f"log-{name}")
        for now in (NOW, "2025-02-01 12:01:00"):
            counts = jobs.land_transcripts(spark, listing, fetched(spark), tdir, log, now, buckets=buckets).collect()
        trend = jobs.analyze_trend(spark, listing, tdir, os.path.join(scratch, f"trend-{name}"))
        freq = jobs.analyze_frequency(spark, listing, tdir, os.path.join(scratch, f"freq-{name}"), cache_dir=os.path.join(scratch, "cache"))
        prof = jobs.profile_transcripts(spark, tdir)
        out[name] = [sorted(map(str, x.collect())) for x in (trend.trend, freq.counts, freq.missing, prof.files, prof.sizes)] + [sorted(map(str, counts))]
    assert out["plain"] == out["bucketed"]
    assert bucketed.open_bucketed(spark, os.path.join(scratch, "plain")) is None
    bucketed.open_bucketed(spark, os.path.join(scratch, "bucketed")).forget(spark)
