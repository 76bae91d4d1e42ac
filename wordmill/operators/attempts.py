"""Transcript landing bookkeeping.

State is an append-only *attempt log* ``(video_id, at, ok[, seq])``; the
per-video retry state ``(video_id, attempts, last_attempt)`` is a fold of
that log: the failures after the last success. Every function is a pure
function of its inputs and an explicit ``now``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.constants import MAX_ATTEMPTS, WAIT_SECONDS
from wordmill.functions.time import elapsed_micros, timestamp_param, trunc_second
from wordmill.plans.physical import may_have_hot_key, salted_join


# What can become of a listed video in a landing round.
OUTCOMES = ("backoff_skip", "already_landed", "downloaded", "save_failed", "unavailable")


def fold_attempts(log: DataFrame, seq_col: str | None = None) -> DataFrame:
    """``video_id, attempts, last_attempt`` from the attempt log.

    Order is ``(at, seq)``. A video whose last entry is a success, or with
    no failure after its last success, has no row. Two grouped aggregates
    (partial aggregation both times) and one join on ``video_id``; no
    window, and a video with a huge log is split over many tasks by the
    salted join.
    """
    after = _fails_after_last_ok(log, seq_col)
    return after.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max("at").alias("last_attempt"),
    )


def _fails_after_last_ok(log: DataFrame, seq_col: str | None) -> DataFrame:
    """Failure entries ordered after their video's last success.

    The last success per video comes from a grouped aggregate that also
    counts the video's entries; the count marks hot videos for the salted
    join back to the failures.
    """
    order = F.struct(F.col("at"), F.col(seq_col) if seq_col else F.lit(0))
    entries = log.select("video_id", "at", "ok", order.alias("_o"))
    last_ok = entries.groupBy("video_id").agg(
        F.max(F.when(F.col("ok"), F.col("_o"))).alias("_last_ok"),
        F.count(F.lit(1)).alias("_n"),
    )
    fails = entries.filter(~F.col("ok"))
    if may_have_hot_key(fails):
        joined = salted_join(fails, last_ok, ["video_id"], "inner", "_n", ["_o"])
    else:
        joined = fails.join(last_ok, "video_id")
    return joined.filter(F.col("_last_ok").isNull() | (F.col("_o") > F.col("_last_ok")))


def wait_seconds(attempts: Column) -> Column:
    """Minimal wait after ``attempts`` failures: WAIT_SECONDS[min(attempts, 5)]."""
    table = F.array(*[F.lit(w) for w in WAIT_SECONDS])
    idx = (F.least(attempts, F.lit(len(WAIT_SECONDS) - 1)) + 1).cast("int")
    return F.element_at(table, idx).cast("bigint")


def retry_eligible(attempts: Column, last_attempt: Column, now: Column) -> Column:
    """F14 + X14: unknown video -> true; ``attempts >= 6`` -> false; else the
    time since the last attempt is at least the wait for that count."""
    waited = elapsed_micros(now, last_attempt) >= wait_seconds(attempts) * F.lit(1_000_000)
    return (
        F.when(attempts.isNull(), F.lit(True))
        .when(attempts >= MAX_ATTEMPTS, F.lit(False))
        .otherwise(F.coalesce(waited, F.lit(False)))
    )


def retry_status(videos: DataFrame, state: DataFrame, now, key: str = "video_id") -> DataFrame:
    """J7 + F14: every listed video with its state and ``eligible`` flag.

    Where the list is long enough for a hot video, its keys are folded together
    with the state, so the counts that find often-listed videos come from the
    same aggregate; a shorter list is joined as it is.
    """
    now_col = timestamp_param(now) if not isinstance(now, Column) else now
    known = state.select(key, "attempts", "last_attempt", F.lit(0).alias("_n"))
    joined = _join_facts(videos, known, key, {c: F.max(c) for c in ("attempts", "last_attempt")})
    return joined.withColumn("eligible", retry_eligible(F.col("attempts"), F.col("last_attempt"), now_col))


def _join_facts(videos: DataFrame, stacked: DataFrame, key: str, facts: dict[str, Column]) -> DataFrame:
    """``videos`` with ``facts``, aggregates over the rows of ``stacked`` (which
    carry ``_n = 0``) that have the same key."""
    named = [c.alias(name) for name, c in facts.items()]
    if not may_have_hot_key(videos):
        return videos.join(stacked.groupBy(key).agg(*named), key, "left")
    listed = videos.select(F.col(key), F.lit(1).alias("_n"))
    folded = stacked.unionByName(listed, allowMissingColumns=True).groupBy(key).agg(F.sum("_n").alias("_n"), *named)
    return salted_join(videos, folded, [key], "left", "_n", videos.columns).drop("_n")


def work_list(videos: DataFrame, state: DataFrame, transcripts: DataFrame, now, key: str = "video_id") -> DataFrame:
    """Eligible videos that have no transcript yet (F13 via anti join)."""
    status = retry_status(videos, state, now, key).filter(F.col("eligible"))
    return status.join(transcripts.select(key), key, "left_anti")


def classify_outcomes(
    videos: DataFrame,
    state: DataFrame,
    landed: DataFrame,
    fetched: DataFrame,
    now,
    key: str = "video_id",
) -> DataFrame:
    """Outcome per listed video, checked in this order:

    1. ``backoff_skip`` - not eligible for retry (failure, not recorded);
    2. ``already_landed`` - a transcript exists (success);
    3. ``downloaded`` - segments fetched now, non-empty (F15), saved (success, recorded);
    4. ``save_failed`` - fetched but not saved (failure, not recorded);
    5. ``unavailable`` - nothing fetched or empty (failure, recorded).

    ``fetched`` holds ``key, n_segments, saved``. The per-video facts (retry
    state, landed, fetched, saved, times listed where the list is long) are stacked
    with a union and folded by one grouped aggregate (partial aggregation, one row
    per video), then joined to the list once; a video listed very many times is
    split by the salted join.
    """
    now_col = timestamp_param(now) if not isinstance(now, Column) else now
    null_ts = F.lit(None).cast("timestamp_ntz")
    null_n = F.lit(None).cast("bigint")
    null_b = F.lit(None).cast("boolean")
    parts = [
        state.select(F.col(key), F.col("attempts").cast("bigint").alias("_a"), F.col("last_attempt").alias("_t"), null_b.alias("_landed"), null_b.alias("_got"), null_b.alias("_saved")),
        landed.select(F.col(key), null_n.alias("_a"), null_ts.alias("_t"), F.lit(True).alias("_landed"), null_b.alias("_got"), null_b.alias("_saved")),
        fetched.select(
            F.col(key), null_n.alias("_a"), null_ts.alias("_t"), null_b.alias("_landed"),
            (F.col("n_segments") > 0).alias("_got"),
            ((F.col("n_segments") > 0) & F.col("saved")).alias("_saved"),
        ),
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("_n", F.lit(0))
    columns = {"attempts": "_a", "last_attempt": "_t", "_landed": "_landed", "_got": "_got", "_saved": "_saved"}
    out = _join_facts(videos, stacked, key, {name: F.max(c) for name, c in columns.items()})
    eligible = retry_eligible(F.col("attempts"), F.col("last_attempt"), now_col)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    outcome = (
        F.when(~eligible, F.lit("backoff_skip"))
        .when(flag("_landed"), F.lit("already_landed"))
        .when(flag("_saved"), F.lit("downloaded"))
        .when(flag("_got"), F.lit("save_failed"))
        .otherwise(F.lit("unavailable"))
    )
    return (
        out.withColumn("eligible", eligible)
        .withColumn("outcome", outcome)
        .withColumn("success", F.col("outcome").isin("already_landed", "downloaded"))
        .drop("_landed", "_got", "_saved")
    )


def attempt_entries(outcomes: DataFrame, now, key: str = "video_id") -> DataFrame:
    """D5 + D6: log rows to append for this run. A download success is an
    ``ok`` entry (resets the fold); an unavailable transcript is a failure
    entry. Back-off skips, already-landed and save failures write nothing."""
    now_col = timestamp_param(now) if not isinstance(now, Column) else now
    recorded = outcomes.filter(F.col("outcome").isin("downloaded", "unavailable"))
    return recorded.select(
        F.col(key).alias("video_id"),
        trunc_second(now_col).alias("at"),
        (F.col("outcome") == "downloaded").alias("ok"),
    )


def outcome_counts(outcomes: DataFrame, group_col: str = "channel_name") -> DataFrame:
    """Landed vs missing per channel."""
    return outcomes.groupBy(group_col).agg(
        F.count_if(F.col("success")).alias("downloaded"),
        F.count_if(~F.col("success")).alias("missing"),
    )


def language_preference(
    landed: DataFrame,
    languages: Sequence[str],
    keys: Sequence[str] = ("video_id",),
    lang_col: str = "lang",
    tie_col: str | None = None,
) -> DataFrame:
    """Among the transcripts landed for a video in several languages,
    keep the one whose language comes first in ``languages`` (ties by
    ``tie_col``). Languages outside the list are ignored. A grouped
    ``min_by``: one candidate row kept per video per task."""
    prefs = F.array(*[F.lit(l) for l in languages])
    pos = F.array_position(prefs, F.col(lang_col))
    cand = landed.filter(F.col(lang_col).isin(list(languages)))
    payload = [c for c in landed.columns if c not in keys]
    rank = F.struct(pos, F.col(tie_col) if tie_col else F.lit(0))
    best = cand.groupBy(*keys).agg(F.min_by(F.struct(*payload), rank).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload])


def merge_attempts(state: DataFrame, new_log: DataFrame, seq_col: str | None = None) -> DataFrame:
    """Incremental D9: fold new log entries into an existing state.

    ``new_log`` holds entries later than everything already folded (the log
    is append-only in time order). A video with a success among the new
    entries restarts from the failures after that success; otherwise its new
    failures add to the old count and move ``last_attempt`` forward. Equal to
    ``fold_attempts`` over the whole log, at the cost of the new entries
    plus one join with the state.
    """
    seen = new_log.groupBy("video_id").agg(F.max("ok").alias("_reset"))
    fails = _fails_after_last_ok(new_log, seq_col)
    new_fails = fails.groupBy("video_id").agg(F.count(F.lit(1)).alias("_n"), F.max("at").alias("_at"))
    delta = seen.join(new_fails, "video_id", "left")
    old = state.select("video_id", F.col("attempts").alias("_old_n"), F.col("last_attempt").alias("_old_at"))
    merged = old.join(delta, "video_id", "full_outer")
    reset = F.coalesce(F.col("_reset"), F.lit(False))
    attempts_col = F.when(reset, F.col("_n")).otherwise(F.coalesce(F.col("_old_n"), F.lit(0)) + F.coalesce(F.col("_n"), F.lit(0)))
    last_col = F.when(reset, F.col("_at")).otherwise(F.greatest(F.col("_old_at"), F.col("_at")))
    out = merged.select("video_id", attempts_col.cast("bigint").alias("attempts"), last_col.alias("last_attempt"))
    return out.filter(F.col("attempts").isNotNull() & (F.col("attempts") > 0))
