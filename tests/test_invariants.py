"""Cross-query invariants of the catalog over the driver tables:
results of different operator families must agree with each other."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from wordmill.plans import catalog as C

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
Q = E.QUERIES


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_trend_summed_over_days_is_frequency(spark):
    # Every document has a publish time in this mapping, so summing the
    # per-day counts gives the global counts (A2 -> A1).
    trend = Q["word_trend"](spark, SF)
    summed = trend.groupBy("word").agg(F.sum("count").alias("count"))
    assert rows(summed, "word", "count") == rows(Q["word_frequency"](spark, SF), "word", "count")


def test_matrix_total_is_word_total(spark):
    matrix = Q["trend_matrix"](spark, SF)
    totals = C.analytics.word_totals(Q["word_trend"](spark, SF))
    assert rows(matrix, "word", "total") == rows(totals, "word", "total")
    days = [c for c in matrix.columns if c not in ("word", "total")]
    assert days == sorted(days)
    row_sum = sum((F.col(f"`{d}`") for d in days), F.lit(0))
    assert matrix.filter(row_sum != F.col("total")).count() == 0


def test_top_words_are_the_head_of_sorted_counts(spark):
    head = C.analytics.sorted_counts(Q["word_frequency"](spark, SF)).limit(C.TOP_N)
    assert [tuple(r) for r in Q["top_words"](spark, SF).collect()] == [tuple(r) for r in head.collect()]


def test_top_series_rows_belong_to_the_top_words(spark):
    series = Q["top_word_series"](spark, SF)
    totals = series.groupBy("rank", "word").agg(F.sum("count").alias("total")).orderBy("rank").collect()
    assert [r["rank"] for r in totals] == list(range(1, C.TREND_TOP_N + 1))
    assert [r["total"] for r in totals] == sorted((r["total"] for r in totals), reverse=True)


def test_histogram_and_channel_counts_cover_every_document(spark):
    docs = C.table(spark, SF, "documents").count()
    assert Q["size_histogram"](spark, SF).agg(F.sum("files")).first()[0] == docs
    assert Q["files_per_channel"](spark, SF).agg(F.sum("files")).first()[0] == docs


def test_outcomes_cover_the_list(spark):
    counts = Q["outcome_counts"](spark, SF).agg(F.sum("downloaded"), F.sum("missing")).first()
    classes = Q["outcome_classes"](spark, SF)
    assert counts[0] + counts[1] == classes.count() == C.table(spark, SF, "documents").count()
    assert counts[0] == classes.filter("success").count()


def test_work_list_is_eligible_and_not_landed(spark):
    work = Q["retry_work_list"](spark, SF)
    eligible = Q["retry_eligibility"](spark, SF).filter("eligible").select("video_id")
    landed = C.table(spark, SF, "labels").select(F.col("doc_id").alias("video_id"))
    assert work.join(eligible, "video_id", "left_anti").count() == 0
    assert work.join(landed, "video_id", "left_semi").count() == 0
    assert work.count() == eligible.join(landed, "video_id", "left_anti").count()


def test_row_counts_agree_with_other_queries(spark):
    r = Q["row_counts"](spark, SF).first()
    assert r["loaded"] == C.table(spark, SF, "documents").count()
    assert r["landed"] == Q["corpus_join"](spark, SF).count()
    assert r["tokens"] == Q["word_frequency"](spark, SF).agg(F.sum("count")).first()[0]


def test_corpus_join_plus_missing_is_the_list(spark):
    docs = C.table(spark, SF, "documents").count()
    assert Q["corpus_join"](spark, SF).count() + Q["missing_transcripts"](spark, SF).count() == docs


def test_new_watermarks_are_the_max_of_kept_items(spark):
    kept = Q["incremental_items"](spark, SF).groupBy("source_id").agg(F.max("published_at").alias("m"))
    marks = {r["source_id"]: r["last_date"] for r in Q["new_watermarks"](spark, SF).collect()}
    for r in kept.collect():
        assert marks[r["source_id"]] >= r["m"]
    old = {sid: v for _, sid, v in C.OLD_WATERMARKS}
    for sid, v in marks.items():
        assert sid not in old or v >= old[sid]


@pytest.mark.parametrize("name", ["select_date_range", "word_trend", "attempt_state", "retry_eligibility", "outcome_counts", "new_watermarks", "api_items"])
def test_results_do_not_depend_on_session_zone(spark, name):
    utc = sorted(map(repr, Q[name](spark, SF).collect()))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = sorted(map(repr, Q[name](spark, SF).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == utc
