"""Properties from the test strategy: coverage adds up, chunking and strip
agree with Python's own rules on generated text."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_functions import greedy_chunks
from wordmill.functions import split_chunks, strip_ws
from wordmill.operators import analytics as A


def test_corpus_plus_missing_covers_the_list(spark):
    lst = spark.range(0, 200).select(F.col("id").cast("string").alias("video_id"), F.lit("c").alias("channel_id"), F.lit("2025-01-01").alias("published_at"))
    lst = lst.unionByName(lst.filter("video_id < 20"))  # some listed twice
    texts = spark.range(0, 300, 3).select(F.lit("c").alias("channel_id"), F.col("id").cast("string").alias("video_id"), F.lit("x").alias("text"))
    joined = A.corpus(lst, texts).count()
    missing = A.missing_transcripts(lst, texts).count()
    assert joined + missing == lst.count()


TEXT = st.text(alphabet=st.sampled_from(list("ab ż\t\n  é.")), max_size=60)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(TEXT, min_size=1, max_size=20), n=st.integers(min_value=1, max_value=9))
def test_chunking_matches_rule(spark, texts, n):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["c"] for r in df.select("i", split_chunks("t", n).alias("c")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == greedy_chunks(t, n)
        assert all(len(c) <= n for c in got[i])


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(TEXT, min_size=1, max_size=20))
def test_strip_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["s"] for r in df.select("i", strip_ws("t").alias("s")).collect()}
    assert got == {i: t.strip() for i, t in enumerate(texts)}
