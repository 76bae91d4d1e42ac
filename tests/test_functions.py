"""Scalar functions (FIXTURES §4) and properties of the text expressions."""

import random

from pyspark.sql import functions as F

from wordmill.functions import (
    WHITESPACE,
    clean_transcript,
    cut_comment,
    day_of,
    parse_timestamp,
    sanitize_path_part,
    segment_line,
    split_chunks,
    strip_ws,
)


def greedy_chunks(text, n):
    """Independent statement of the chunking rule, used as a test oracle."""
    out, pos = [], 0
    while pos < len(text):
        if pos + n >= len(text):
            cut = len(text)
        elif text[pos + n] == " ":
            cut = pos + n
        else:
            j = text.rfind(" ", pos, pos + n)
            cut = j if j > pos else pos + n
        out.append(text[pos:cut].strip())
        pos = cut
    return out


def test_segment_line(spark):
    df = spark.createDataFrame([(0.0,), (59.9,), (60.0,), (4503.9,)], "s double")
    got = [r[0] for r in df.select(segment_line("s", F.lit("x"))).collect()]
    assert got == ["[0:00] x", "[0:59] x", "[1:00] x", "[75:03] x"]


def test_sanitize(spark):
    df = spark.createDataFrame([("Voice: OAK/1",), ("a" * 60,), ('a<b>c:d"e/f\\g|h?i*j k',)], "s string")
    got = [r[0] for r in df.select(sanitize_path_part("s")).collect()]
    assert got == ["Voice_OAK1", "a" * 50, "abcdefghij_k"]


def test_chunk_fixtures(spark):
    rows = [("aaa bbb ccc", 5), ("abcdefgh", 3), (" abcdef", 3), ("", 5)]
    for text, n in rows:
        got = spark.createDataFrame([(text,)], "t string").select(split_chunks("t", n)).first()[0]
        assert got == greedy_chunks(text, n), (text, n, got)
    assert greedy_chunks("aaa bbb ccc", 5) == ["aaa", "bbb", "ccc"]
    assert greedy_chunks("abcdefgh", 3) == ["abc", "def", "gh"]
    assert greedy_chunks(" abcdef", 3) == ["ab", "cde", "f"]
    assert greedy_chunks("", 5) == []


def test_chunk_property_random(spark):
    rng = random.Random(7)
    alphabet = ["a", "b", " ", " ", "ż", "\n", "\t", "é"]
    cases = []
    for i in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        cases.append((i, text, rng.choice([1, 2, 3, 5, 7])))
    df = spark.createDataFrame(cases, "i int, t string, n int")
    for n in (1, 2, 3, 5, 7):
        got = {r["i"]: r["c"] for r in df.filter(F.col("n") == n).select("i", split_chunks("t", n).alias("c")).collect()}
        for i, text, m in cases:
            if m == n:
                assert got[i] == greedy_chunks(text, n), (text, n)
                # No non-whitespace character is lost.
                assert "".join("".join(c.split()) for c in got[i]) == "".join(text.split())


def test_strip_matches_python(spark):
    samples = ["  a b  ", " x ", "\x1cy\x1f", "\n\tz\r\n", "", "   "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(strip_ws("s")).collect()]
    assert got == [s.strip() for s in samples]
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_clean_transcript(spark):
    df = spark.createDataFrame([("[75:03] pies i kot",), ("[0:00] Kot widzi psa.\n[0:07] Pies",)], "t string")
    got = [r[0] for r in df.select(clean_transcript("t")).collect()]
    assert got == ["pies i kot", "kot widzi psa.\n pies"]


def test_cut_comment(spark):
    lines = ["UCx  # note", "# only", "", "a#b", " c "]
    df = spark.createDataFrame([(s,) for s in lines], "v string")
    got = [r[0] for r in df.select(cut_comment("v").alias("x")).filter(F.col("x") != "").collect()]
    assert got == ["UCx", "a", "c"]


def test_time_parsing(spark):
    df = spark.createDataFrame([("2025-01-29T10:00:00Z",), ("not-a-date",), (None,), ("2025-01-30T12:30:00+02:00",)], "p string")
    rows = df.select(parse_timestamp("p").alias("ts"), day_of("p").alias("d")).collect()
    assert str(rows[0]["ts"]) == "2025-01-29 10:00:00"
    assert rows[1]["ts"] is None and rows[1]["d"] is None
    assert rows[2]["ts"] is None
    assert str(rows[3]["ts"]) == "2025-01-30 10:30:00"


def test_time_parsing_independent_of_session_zone(spark):
    df = spark.createDataFrame([("2025-01-29T10:00:00Z",), ("2025-01-30T12:30:00+02:00",)], "p string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [str(r["ts"]) for r in df.select(parse_timestamp("p").alias("ts")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2025-01-29 10:00:00", "2025-01-30 10:30:00"]


def test_iso_and_trunc_independent_of_zone(spark):
    import datetime as dt

    from wordmill.functions import iso_utc, trunc_second

    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 5, 123456),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 falls in a DST gap there
    try:
        row = df.select(iso_utc("ts").alias("iso"), trunc_second("ts").alias("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["iso"] == "2024-03-10T02:30:05Z"
    assert row["t"] == dt.datetime(2024, 3, 10, 2, 30, 5)


def test_timestamp_param_independent_of_session_zone(spark):
    import datetime as dt

    from wordmill.functions.time import timestamp_param

    got = []
    for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            got.append(spark.range(1).select(
                timestamp_param("2024-01-30 12:00:00").alias("a"),
                timestamp_param(dt.datetime(2024, 1, 30, 13, 0, tzinfo=dt.timezone(dt.timedelta(hours=1)))).alias("b"),
            ).first())
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(r["a"] == dt.datetime(2024, 1, 30, 12, 0) and r["b"] == dt.datetime(2024, 1, 30, 12, 0) for r in got)
