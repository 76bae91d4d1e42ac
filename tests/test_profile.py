"""Profile (FIXTURES §7): A9-A12."""

from pyspark.sql import functions as F

from wordmill.operators import profile as P


def test_size_histogram(spark):
    sizes = [0, 1023, 1024, 10239, 10240, 20480, 51199, 51200, 102400]
    df = spark.createDataFrame([(s,) for s in sizes], "size long")
    got = [(r["bin"], r["files"]) for r in P.size_histogram(df, size_col="size").orderBy("bin_no").collect()]
    assert got == [("< 1 KB", 2), ("1 KB - 10 KB", 2), ("10 KB - 20 KB", 1), ("20 KB - 50 KB", 2), ("50 KB - 100 KB", 1), ("> 100 KB", 1)]


def test_histogram_keeps_zero_bins_and_counts_bytes(spark):
    df = spark.createDataFrame([("ż" * 600,), ("a",)], "text string")  # 1200 bytes, 1 byte
    got = [r["files"] for r in P.size_histogram(df).orderBy("bin_no").collect()]
    assert got == [1, 1, 0, 0, 0, 0]
    assert sum(got) == df.count()


def test_files_per_channel_and_observation(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "channel_id string, video_id string")
    observed, obs = P.observe_rows(df, "loaded")
    got = {r["channel_id"]: r["files"] for r in P.files_per_channel(observed).collect()}
    assert got == {"a": 2, "b": 1}
    assert obs.get["rows"] == 3
