"""Attempt state (FIXTURES §6): F14, D5-D10, A8."""

import datetime as dt

from pyspark.sql import functions as F

from wordmill.operators import attempts as T

NOW = "2025-02-01 12:00:00"


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_eligibility_table(spark):
    rows = [
        ("a", None, None, True),
        ("b", 1, ts("2025-02-01 11:59:30"), False),
        ("c", 1, ts("2025-02-01 11:59:00"), True),
        ("d", 2, ts("2025-02-01 11:30:00"), False),
        ("e", 2, ts("2025-02-01 10:59:59"), True),
        ("f", 5, ts("2025-01-31 12:00:00"), True),
        ("g", 6, ts("2020-01-01 00:00:00"), False),
    ]
    state = spark.createDataFrame([(v, a, l) for v, a, l, _ in rows if a is not None], "video_id string, attempts bigint, last_attempt timestamp_ntz")
    vids = spark.createDataFrame([(r[0],) for r in rows], "video_id string")
    got = {r["video_id"]: r["eligible"] for r in T.retry_status(vids, state, NOW).collect()}
    assert got == {r[0]: r[3] for r in rows}


def log_df(spark, entries):
    return spark.createDataFrame(
        [(v, ts(t), ok, i) for i, (v, t, ok) in enumerate(entries)],
        "video_id string, at timestamp_ntz, ok boolean, seq int",
    )


def test_fold(spark):
    entries = [
        ("x", "2025-01-01 00:00:01", False), ("x", "2025-01-01 00:00:02", False),
        ("x", "2025-01-01 00:00:03", True), ("x", "2025-01-01 00:00:04", False),
        ("y", "2025-01-01 00:00:01", False), ("y", "2025-01-01 00:00:02", True),
        ("z", "2025-01-01 00:00:05", False), ("z", "2025-01-01 00:00:05", True),
    ]
    out = {r["video_id"]: (r["attempts"], r["last_attempt"]) for r in T.fold_attempts(log_df(spark, entries), "seq").collect()}
    assert out == {"x": (1, ts("2025-01-01 00:00:04"))}


def replay(entries):
    state = {}
    for v, t, ok in entries:
        if ok:
            state.pop(v, None)
        else:
            a, _ = state.get(v, (0, None))
            state[v] = (a + 1, ts(t))
    return state


def test_fold_equals_sequential_replay_and_merge(spark):
    import random

    rng = random.Random(3)
    entries = []
    for i in range(300):
        entries.append((f"v{rng.randint(0, 12)}", f"2025-01-01 00:{i // 60:02d}:{i % 60:02d}", rng.random() < 0.3))
    full = {r["video_id"]: (r["attempts"], r["last_attempt"]) for r in T.fold_attempts(log_df(spark, entries), "seq").collect()}
    assert full == replay(entries)
    first, second = entries[:170], entries[170:]
    state = T.fold_attempts(log_df(spark, first), "seq")
    second_df = log_df(spark, second).withColumn("seq", F.col("seq") + 170)
    merged = {r["video_id"]: (r["attempts"], r["last_attempt"]) for r in T.merge_attempts(state, second_df, "seq").collect()}
    assert merged == full


def test_outcomes_and_counts(spark):
    vids = spark.createDataFrame(
        [("a", "R1"), ("b", "R1"), ("c", "R2"), ("d", "R2"), ("e", "R2")], "video_id string, channel_name string"
    )
    state = spark.createDataFrame([("a", 6, ts("2025-01-01 00:00:00"))], "video_id string, attempts bigint, last_attempt timestamp_ntz")
    landed = spark.createDataFrame([("a",), ("b",)], "video_id string")  # a is blocked even though landed
    fetched = spark.createDataFrame([("c", 3, True), ("d", 2, False), ("e", 0, True)], "video_id string, n_segments bigint, saved boolean")
    out = T.classify_outcomes(vids, state, landed, fetched, NOW)
    got = {r["video_id"]: r["outcome"] for r in out.collect()}
    assert got == {"a": "backoff_skip", "b": "already_landed", "c": "downloaded", "d": "save_failed", "e": "unavailable"}
    counts = {r["channel_name"]: (r["downloaded"], r["missing"]) for r in T.outcome_counts(out).collect()}
    assert counts == {"R1": (1, 1), "R2": (1, 2)}
    log = {r["video_id"]: r["ok"] for r in T.attempt_entries(out, NOW).collect()}
    assert log == {"c": True, "e": False}


def test_work_list(spark):
    vids = spark.createDataFrame([("a",), ("b",), ("c",)], "video_id string")
    state = spark.createDataFrame([("a", 6, ts("2025-01-01 00:00:00"))], "video_id string, attempts bigint, last_attempt timestamp_ntz")
    landed = spark.createDataFrame([("b",)], "video_id string")
    assert [r["video_id"] for r in T.work_list(vids, state, landed, NOW).collect()] == ["c"]


def test_language_preference(spark):
    rows = [("v1", "en", 1, "x"), ("v1", "pl", 2, "y"), ("v1", "pl", 0, "z"), ("v2", "de", 3, "w"), ("v3", "en", 4, "u")]
    df = spark.createDataFrame(rows, "video_id string, lang string, seq int, text string")
    got = {r["video_id"]: r["text"] for r in T.language_preference(df, ["pl", "en"], tie_col="seq").collect()}
    assert got == {"v1": "z", "v3": "u"}
