"""State, counts and keys that grow by increments: each equals its full
computation after any batching, restart or damage, at the cost of what is new."""

import datetime as dt
import os
import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordmill import schemas
from wordmill.metrics import JobMetrics
from wordmill.operators import attempts as T
from wordmill.operators.ingest import new_rows
from wordmill.sources import writers as W
from wordmill.sources.files import data_files
from wordmill.sources.key_index import KeyIndex, any_in, bloom
from wordmill.streaming import attempts as S


def at(seconds):
    return dt.datetime(2025, 1, 1) + dt.timedelta(seconds=seconds)


def state_of(frame):
    return {r["video_id"]: (r["attempts"], r["last_attempt"]) for r in frame.collect()}


@pytest.mark.parametrize("shuffled", [False, True])
def test_keyed_attempts_equal_the_fold(spark, scratch, monkeypatch, shuffled):
    """Any batches, three runs on one checkpoint, entries out of order."""
    monkeypatch.setattr(S, "COMPACT_BATCHES", 4)
    rng = random.Random(shuffled)
    log = [(f"v{rng.randrange(9)}", at(i // 2), rng.random() < 0.3) for i in range(240)]
    log += [("hot", at(1000 + i), False) for i in range(60)] + [("hot", at(1030), True)]
    if shuffled:
        rng.shuffle(log)
    logdir, state, ckpt = (os.path.join(scratch, n) for n in ("log", "state", "ckpt"))
    for run in range(3):
        for part in range(2):
            rows = log[(2 * run + part) * 50 : (2 * run + part + 1) * 50 if run + part < 3 else None]
            spark.createDataFrame(rows, schemas.ATTEMPT_LOG).coalesce(1).write.mode("append").parquet(logdir)
        S.start_attempt_state(spark, logdir, state, ckpt, max_files_per_trigger=1).awaitTermination()
    whole = spark.createDataFrame(log, schemas.ATTEMPT_LOG)
    assert state_of(S.read_attempt_state(spark, state)) == state_of(T.fold_attempts(whole))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != S.ROCKSDB


def test_delta_table(spark, scratch):
    table = W.DeltaTable(f"{scratch}/d", schemas.ATTEMPTS, "video_id")
    rows = lambda *r: spark.createDataFrame(list(r), schemas.ATTEMPTS)
    assert table.read(spark).count() == 0
    table.compact(spark)
    table.write(rows(("a", 1, at(1)), ("b", 1, at(1))), 0)
    table.write(rows(("a", 2, at(2))), 1)
    table.write(rows(("a", 3, at(3))), 1)  # a replay replaces its rows
    want = {"a": (3, at(3)), "b": (1, at(1))}
    assert state_of(table.read(spark)) == want
    table.compact(spark)
    assert state_of(table.read(spark)) == want
    table.write(rows(("b", 0, None)), 12)
    assert state_of(table.read(spark)) == want | {"b": (0, None)}
    table.compact(spark, keep=F.col("attempts") > 0)
    assert state_of(table.read(spark)) == {"a": (3, at(3))}


# --- counts ----------------------------------------------------------------


def test_partial_counts_read_only_what_is_new(spark, scratch, monkeypatch):
    monkeypatch.setattr(W.PartialCounts, "MERGE", 2)
    root, part = f"{scratch}/my words", W.PartialCounts(f"{scratch}/cache", "k", schemas.WORDS)
    rng = random.Random(1)

    def add(n):
        rows = [(rng.choice("abcdef"),) for _ in range(n)]
        spark.createDataFrame(rows, "word string").coalesce(1).write.mode("append").parquet(root)

    def count(files):
        return spark.read.parquet(*files).groupBy("word").agg(F.count(F.lit(1)).alias("count"))

    def check(n_files):
        got = {r["word"]: r["count"] for r in part.update(spark, root, count).collect()}
        want = {r["word"]: r["count"] for r in spark.read.parquet(root).groupBy("word").count().collect()}
        assert got == want and len(part.counted) == n_files

    assert part.update(spark, root, count).count() == 0
    add(50), add(20)
    check(2)
    for _ in range(4):  # merged on the way
        add(10)
        check(1)
    check(0)
    os.remove(data_files(spark, root)[0].path.removeprefix("file:"))  # its generation is counted anew
    check(5)
    add(5)
    check(1)


def test_partial_counts_after_a_crash(spark, scratch):
    root, part = f"{scratch}/words", W.PartialCounts(f"{scratch}/cache", "k", schemas.WORDS)
    spark.createDataFrame([("a",)], "word string").write.parquet(root)
    count = lambda files: spark.read.parquet(*files).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    count([root]).write.parquet(f"{part.path}/counts/v=0")  # counts without a list of files
    assert [tuple(r) for r in part.update(spark, root, count).collect()] == [("a", 1)]


# --- keys ------------------------------------------------------------------


def test_bloom_has_no_false_negatives():
    rng = np.random.default_rng(5)
    held = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    body = bloom(held)
    assert all(any_in(body, held[i : i + 1]) for i in range(0, 3000, 7))
    others = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    assert sum(any_in(body, others[i : i + 1]) for i in range(2000)) < 2
    assert not any_in(bloom(np.zeros(0, np.uint64)), others)


def test_append_reads_only_files_that_may_hold_a_key(spark, scratch):
    target = f"{scratch}/videos"
    frame = lambda ids: spark.createDataFrame([(i, "x") for i in ids], "video_id string, title string").coalesce(1)
    ids = lambda a, b: [f"v{i}" for i in range(a, b)]
    assert W.append_indexed(frame(ids(0, 500)), target) == []
    assert W.append_indexed(frame(ids(500, 900)), target) == []  # no known key: nothing is read
    assert len(data_files(spark, target)) == 2
    read = W.append_indexed(frame(["v3", "new", "new", None]), target)
    assert len(read) == 1 and spark.read.parquet(target).filter("video_id = 'new'").count() == 2
    rows = spark.read.parquet(target).count()
    W.append_indexed(frame(["v3", "v700", "new"]), target)  # nothing new: nothing is written
    assert spark.read.parquet(target).count() == rows and len(data_files(spark, target)) == 3
    # Written past the index: always read until it is indexed.
    frame(["late"]).write.mode("append").parquet(target)
    batch = frame(["late", "later"])
    existing, files = KeyIndex(target).known(batch)
    assert len(files) == 1
    want = new_rows(batch, spark.read.parquet(target)).collect()
    assert new_rows(batch, existing).collect() == want and len(want) == 1


# --- damaged state ---------------------------------------------------------


@pytest.mark.parametrize("damage", ["cut", "gone", "extra", "manifest", "rows"])
def test_a_torn_version_is_skipped(spark, scratch, damage):
    table = W.StateTable(f"{scratch}/s", schemas.WATERMARKS)
    row = lambda d: spark.createDataFrame([("p", "a", d)], schemas.WATERMARKS)
    table.write(row("1"), 1)
    table.write(row("2"), 2)
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert table.read(spark).first()["last_date"] == "2"
    folder = f"{scratch}/s/v=2"
    name = next(n for n in os.listdir(folder) if n.endswith(".parquet") and os.path.getsize(f"{folder}/{n}") > 500)
    if damage == "cut":
        body = open(f"{folder}/{name}", "rb").read()
        open(f"{folder}/{name}", "wb").write(body[: len(body) // 2])
    elif damage == "gone":
        os.remove(f"{folder}/{name}")
    elif damage == "extra":
        open(f"{folder}/part-more.parquet", "wb").write(b"PAR1")
    elif damage == "manifest":
        open(f"{folder}/_manifest", "w").write("{")
    else:
        text = open(f"{folder}/_manifest").read()
        open(f"{folder}/_manifest", "w").write(text.replace('"rows": 1', '"rows": 7'))
    for crc in (f"{folder}/.{name}.crc", f"{folder}/._manifest.crc"):
        if os.path.exists(crc):
            os.remove(crc)
    with pytest.warns(UserWarning, match="v=2 is skipped"):
        assert table.read(spark).first()["last_date"] == "1"
    assert 2 in table.skipped and table.skipped[2]
    with pytest.warns(UserWarning):
        assert table.read(spark, before=3).first()["last_date"] == "1"


def test_all_versions_torn_is_empty(spark, scratch):
    table = W.StateTable(f"{scratch}/s", schemas.WATERMARKS)
    table.write(spark.createDataFrame([("p", "a", "1")], schemas.WATERMARKS), 1)
    open(f"{scratch}/s/v=1/_manifest", "w").write("")
    os.remove(f"{scratch}/s/v=1/._manifest.crc")
    with pytest.warns(UserWarning):
        assert table.read(spark).collect() == []


# --- metrics and layout ----------------------------------------------------


def test_metrics_of_several_actions(spark, scratch):
    metrics = JobMetrics()
    rows = metrics.count(spark.range(100), "loaded", even=F.col("id") % 2 == 0)
    kept = metrics.count(rows.filter("id < 30"), "kept")
    kept.write.parquet(f"{scratch}/a")
    metrics.count(spark.range(7), "kept").write.parquet(f"{scratch}/b")
    metrics.put("files", 2)
    assert metrics.values() == {"files": 2, "loaded": 100, "even": 50, "kept": 37}


def test_transcripts_make_few_files(spark, scratch):
    """At most one file for a channel and target size, also from many tasks; a
    hot channel is split."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        body = F.concat_ws(" ", *(F.sha2(F.concat("id", F.lit(str(i))), 256) for i in range(8)))
        rows = spark.range(0, 4_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("channel_id"),
            F.col("id").cast("string").alias("video_id"), F.lit(0).cast("bigint").alias("block"), body.alias("text"),
        )
        W.write_transcripts(rows.repartition(16), f"{scratch}/t")
        files = [f.path.split("/")[-2] for f in data_files(spark, f"{scratch}/t")]
        assert files.count("channel_id=hot") > 1
        assert len(files) - files.count("channel_id=hot") <= 8  # without the rebalance: 16 tasks x 5 channels
        assert spark.read.parquet(f"{scratch}/t").count() == 4_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
