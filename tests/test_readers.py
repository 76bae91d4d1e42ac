"""Readers (S1-S5, S9) and sinks over temporary folders."""

import os

from pyspark.sql import functions as F

from wordmill.operators import analytics as A
from wordmill.sources import readers as R
from wordmill.sources import writers as W


def test_video_list_csv(spark, scratch):
    path = os.path.join(scratch, "list.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('video_id,title,description,published_at,channel_id,channel_name\n')
        f.write('v1,"Multi\nline ""quoted""",,2025-01-29T10:00:00Z,UCa,Radio A\n')
        f.write('v2,null,NA,,UCb,Radio B\n')
    df = R.read_video_list(spark, path)
    rows = {r["video_id"]: r for r in df.collect()}
    assert rows["v1"]["title"] == 'Multi\nline "quoted"'
    assert rows["v1"]["description"] is None
    assert rows["v2"]["title"] == "null" and rows["v2"]["description"] == "NA"
    assert R.read_video_list(spark, os.path.join(scratch, "missing.csv")).count() == 0
    assert R.read_video_list(spark, path, ["video_id", "published_at"]).columns == ["video_id", "published_at"]
    both = R.read_video_lists(spark, path, os.path.join(scratch, "missing.csv"), path)
    assert both.count() == 4


def test_id_list(spark, scratch):
    path = os.path.join(scratch, "ids.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("UCx  # note\n# only\n\na#b\n c \nUCx\n")
    got = [r["source_id"] for r in R.read_id_list(spark, path).orderBy("ord").collect()]
    assert got == ["UCx", "a", "c", "UCx"]


def test_stopwords(spark, scratch):
    path = os.path.join(scratch, "stop.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write(" Także \n\nNOWE\ni\n")
    got = sorted(r["word"] for r in R.read_stopwords(spark, path).collect())
    assert "nowe" in got and "także" in got and got.count("i") == 1


def test_transcript_tree(spark, scratch):
    base = os.path.join(scratch, "transcripts")
    os.makedirs(os.path.join(base, "UCa"))
    os.makedirs(os.path.join(base, "UCb", "deep"))
    with open(os.path.join(base, "UCa", "v1.txt"), "w", encoding="utf-8") as f:
        f.write("[0:00] Kot\n[0:07] Pies")
    with open(os.path.join(base, "top.txt"), "w") as f:
        f.write("not a transcript")
    with open(os.path.join(base, "UCb", "deep", "v9.txt"), "w") as f:
        f.write("too deep")
    rows = R.read_transcript_tree(spark, base).collect()
    assert [(r["channel_id"], r["video_id"], r["text"]) for r in rows] == [("UCa", "v1", "[0:00] Kot\n[0:07] Pies")]


def test_sinks_sorted_outputs(spark, scratch):
    df = spark.createDataFrame([("b", 1), ("a", 3), ("c", 3)], "word string, count long")
    W.write_counts(df, os.path.join(scratch, "counts"))
    back = spark.read.option("header", True).csv(os.path.join(scratch, "counts")).collect()
    assert [r["word"] for r in back] == ["a", "c", "b"]


def test_cache_by_fingerprint(spark, scratch):
    src = os.path.join(scratch, "src")
    spark.createDataFrame([("kot pies kot",)], "text string").write.parquet(src)
    calls = []

    def compute():
        calls.append(1)
        return A.word_frequency(spark.read.parquet(src))

    key = W.fingerprint(spark, [src], {"min_len": 3})
    a = W.cached(spark, os.path.join(scratch, "cache"), key, compute)
    b = W.cached(spark, os.path.join(scratch, "cache"), key, compute)
    assert len(calls) == 1 and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert W.fingerprint(spark, [src], {"min_len": 4}) != key
    spark.createDataFrame([("nowy",)], "text string").write.mode("append").parquet(src)
    assert W.fingerprint(spark, [src], {"min_len": 3}) != key
    # words such as "null" stay strings
    spark.createDataFrame([("null nan",)], "text string").write.mode("overwrite").parquet(src)
    words = {r["word"] for r in W.cached(spark, os.path.join(scratch, "cache"), W.fingerprint(spark, [src]), compute).collect()}
    assert words == {"null", "nan"}
