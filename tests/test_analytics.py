"""Frequency, trend and matrix (FIXTURES §3): J1, J2, A1-A6, T1-T5, T7."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CHANNEL_LIST, PLAYLIST_LIST, assemble, transcripts, videos
from wordmill.operators import analytics as A
from wordmill.operators.tokens import lemma_table, model_normalizer
from wordmill.operators.transcripts import clean_blocks, segments_to_text

STOP = ["i", "oraz"]


@pytest.fixture
def listed(spark):
    rows = [r for r in CHANNEL_LIST if r[0] in ("v1", "v2", "v3")] + [PLAYLIST_LIST[0]]
    return videos(spark, rows)


@pytest.fixture
def corpus(spark, listed):
    return A.cleaned(A.corpus(listed, transcripts(spark)))


def as_dict(df, k="word", v="count"):
    return {r[k]: r[v] for r in df.collect()}


def test_missing(spark, listed):
    assert [r["video_id"] for r in A.missing_transcripts(listed, transcripts(spark)).collect()] == ["v3"]


def test_clean_text(corpus):
    texts = {r["video_id"]: r["text"] for r in corpus.collect()}
    assert texts["v2"] == "pies i kot"


def test_frequency(corpus):
    freq = A.word_frequency(corpus, stopwords=STOP)
    assert as_dict(freq) == {"kot": 4, "pies": 2, "widzi": 2, "dom": 1, "kota": 1, "psa": 1}
    ordered = [(r["word"], r["count"]) for r in A.sorted_counts(freq).collect()]
    assert ordered[:3] == [("kot", 4), ("pies", 2), ("widzi", 2)]
    assert A.token_total(freq).first()["tokens"] == 11
    assert A.token_count(corpus, stopwords=STOP).first()["tokens"] == 11
    assert [r["word"] for r in A.top_words(freq, 2).collect()] == ["kot", "pies"]


def test_frequency_bag_semantics(spark, listed):
    twice = listed.unionByName(listed.filter("video_id = 'v1'"))
    freq = A.word_frequency(A.cleaned(A.corpus(twice, transcripts(spark))), stopwords=STOP)
    assert as_dict(freq) == {"kot": 6, "widzi": 4, "pies": 3, "kota": 2, "psa": 2, "dom": 1}


def test_stopwords_as_table(spark, corpus):
    table = spark.createDataFrame([("i",), ("oraz",)], "word string")
    assert as_dict(A.word_frequency(corpus, stopwords=table)) == as_dict(A.word_frequency(corpus, stopwords=STOP))


def test_lemma_table(spark, corpus):
    lemmas = spark.createDataFrame([("psa", "pies"), ("kota", "kot"), ("widzi", "widzieć")], "token string, lemma string")
    freq = A.word_frequency(corpus, normalizer=lemma_table(lemmas), stopwords=STOP)
    assert as_dict(freq) == {"kot": 5, "pies": 3, "widzieć": 2, "dom": 1}


def test_model_normalizer(spark, corpus):
    def load():
        table = {"psa": "pies", "kota": "kot", "widzi": "widzieć"}
        return lambda text: [table.get(w, w) for w in text.replace(",", " ").replace(".", " ").replace("!", " ").split()]

    freq = A.word_frequency(corpus, normalizer=model_normalizer(load), stopwords=STOP)
    assert as_dict(freq) == {"kot": 5, "pies": 3, "widzieć": 2, "dom": 1}


def test_word_cloud_weights(corpus):
    w = {r["word"]: r["weight"] for r in A.word_cloud_weights(A.word_frequency(corpus, stopwords=STOP)).collect()}
    assert w["kot"] == 1.0 and w["pies"] == 0.5 and w["dom"] == 0.25


def test_trend_matrix_and_top(corpus):
    trend = A.word_trend(corpus, stopwords=STOP)
    got = {(r["date"].isoformat(), r["word"]): r["count"] for r in trend.collect()}
    assert got == {
        ("2025-01-29", "kot"): 2, ("2025-01-29", "kota"): 1, ("2025-01-29", "pies"): 1,
        ("2025-01-29", "psa"): 1, ("2025-01-29", "widzi"): 2,
        ("2025-01-30", "dom"): 1, ("2025-01-30", "kot"): 2, ("2025-01-30", "pies"): 1,
    }
    top = [(r["rank"], r["word"]) for r in A.top_trend_words(trend, 2).collect()]
    assert top == [(1, "kot"), (2, "pies")]
    series = [(r["rank"], r["word"], r["date"], r["count"]) for r in A.top_series(trend, 2).collect()]
    assert series[0] == (1, "kot", dt.date(2025, 1, 29), 2) and len(series) == 4
    m = A.trend_matrix(trend).orderBy("word")
    assert m.columns == ["word", "2025-01-29", "2025-01-30", "total"]
    assert [tuple(r) for r in m.collect()] == [
        ("dom", 0, 1, 1), ("kot", 2, 2, 4), ("kota", 1, 0, 1), ("pies", 1, 1, 2), ("psa", 1, 0, 1), ("widzi", 2, 0, 2),
    ]
    # Properties: matrix total = per-word totals; trend sums = frequency.
    totals = as_dict(A.word_totals(trend), v="total")
    assert totals == {r["word"]: r["total"] for r in m.collect()}
    assert totals == as_dict(A.word_frequency(corpus, stopwords=STOP))


def test_trend_drops_undated(spark):
    rows = [("a", None, "alpha beta"), ("b", "", "gamma"), ("c", "2025-02-01T00:00:00Z", "delta")]
    df = spark.createDataFrame(rows, "video_id string, published_at string, text string")
    assert [r["word"] for r in A.word_trend(df).collect()] == ["delta"]


def test_empty_trend_keeps_schema(spark):
    df = spark.createDataFrame([], "video_id string, published_at string, text string")
    t = A.word_trend(df)
    assert t.columns == ["word", "date", "count"] and t.count() == 0
    assert A.trend_matrix(t).columns == ["word", "total"]


def test_min_length(corpus):
    assert set(as_dict(A.word_frequency(corpus, stopwords=STOP, min_len=5))) == {"widzi"}


def test_segments_blocks_roundtrip(spark):
    segs = [("v", i, float(i * 37), f"line {i}") for i in range(10)]
    df = spark.createDataFrame(segs, "video_id string, ord int, start double, text string")
    whole = segments_to_text(df, block_rows=1000).collect()
    assert len(whole) == 1
    expected = "\n".join(f"[{(i * 37) // 60}:{(i * 37) % 60:02d}] line {i}" for i in range(10))
    assert whole[0]["text"] == expected
    blocks = segments_to_text(df, block_rows=3)
    assert blocks.count() == 4
    assert assemble(blocks).first()["text"] == expected


def test_clean_blocks_equals_whole_text_strip(spark):
    segs = [("v", 0, 0.0, "  "), ("v", 1, 1.0, " Ala "), ("v", 2, 2.0, "ma"), ("v", 3, 3.0, " "), ("v", 4, 4.0, "\t"),
            ("w", 0, 0.0, " "), ("w", 1, 1.0, "")]
    df = spark.createDataFrame(segs, "video_id string, ord int, start double, text string")
    for rows in (1, 2, 3, 100):
        blocks = segments_to_text(df, block_rows=rows)
        whole = {r["video_id"]: r["text"] for r in assemble(segments_to_text(df, block_rows=1000)).collect()}
        cleaned = {r["video_id"]: r["text"] for r in assemble(clean_blocks(blocks)).collect()}
        import re
        expected = {k: re.sub(r"\[\d+:\d+\]", "", v.lower()).strip() for k, v in whole.items()}
        assert cleaned == expected, rows


def test_frequency_plan_is_jvm_only(spark, corpus):
    plan = A.word_frequency(corpus, stopwords=STOP)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_segment_arrays(spark):
    from wordmill.operators.transcripts import has_segments, segments_from_arrays

    rows = [("v1", [(0.0, "a"), (61.5, "b")]), ("v2", []), ("v3", None)]
    df = spark.createDataFrame(rows, "video_id string, segments array<struct<start:double,text:string>>")
    assert [r["video_id"] for r in df.filter(has_segments()).collect()] == ["v1"]
    text = segments_to_text(segments_from_arrays(df)).collect()
    assert [(r["video_id"], r["text"]) for r in text] == [("v1", "[0:00] a\n[1:01] b")]


def test_wide_matrix_uses_pivot_and_agrees(spark):
    import datetime as dt

    rows = [(f"w{i % 7}", dt.date(2024, 1, 1) + dt.timedelta(days=i % 90), 1 + i % 3) for i in range(600)]
    trend = spark.createDataFrame(rows, "word string, date date, count long").groupBy("word", "date").agg(F.sum("count").alias("count"))
    m = A.trend_matrix(trend)
    assert len(m.columns) == 2 + 90
    expect = {}
    for w, d, c in rows:
        expect.setdefault(w, {}).setdefault(d.isoformat(), 0)
        expect[w][d.isoformat()] += c
    for r in m.collect():
        assert r["total"] == sum(expect[r["word"]].values())
        for d, c in expect[r["word"]].items():
            assert r[d] == c
    narrow = A.trend_matrix(trend, days=[c for c in m.columns[1:-1]][:10])
    assert len(narrow.columns) == 12
