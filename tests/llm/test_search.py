"""Ranked search against scores computed for every document."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wordmill.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ranked(docs, items, k=10):
    """{item: [(rank, doc, score)]} of all documents, in order."""
    counted = [(d, Counter(TERM.findall(brute.lower(t)))) for d, t in docs]
    counted = [(d, c, c.total()) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall(brute.lower(text)))
    out = {}
    for item, terms in asked.items():
        scored = []
        for place, (d, c, n) in enumerate(counted):
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms
                if c[t]
            )
            if score:
                scored.append((-score, d is None, d or 0, place))
        best = sorted(scored)[:k]
        if best:
            out[item] = [(i + 1, None if none else d, -s) for i, (s, none, d, _) in enumerate(best)]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return out


def sample_rows():
    rng = random.Random(11)
    common, rare = ["the", "of", "and", "to"], [f"word{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(common if rng.random() < 0.5 else rare) for _ in range(n))
    docs = [(i, text(rng.choice([2, 5, 30, 80, 300]))) for i in range(400)]
    docs += [(400 + i, docs[i % 7][1].upper()) for i in range(120)]  # copies: ties
    docs += [(600, None), (601, ""), (602, " .,!\n"), (603, "É é9 日本 x_y"), (604, text(40_000)), (605, "the " * 60_000)]
    docs += [(None, docs[0][1]), (None, "word1 word2"), (5, "word1 word7"), (5, "word1 word7")]
    items = [(i, text(rng.randint(1, 25))) for i in range(25)]
    items += [(30, "the"), (31, "THE of, and; to"), (32, ""), (33, None), (34, "absent words"), (35, "é 日本 É"), (36, "word1-word1 word2")]
    items += [(None, "word5 word6 the"), (40, "word8"), (40, "word9 the")]
    items += [(50 + i, docs[i][1]) for i in range(5)]
    return docs, items


@pytest.fixture(scope="module")
def tables(spark):
    docs, items = sample_rows()
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string").repartition(2),
    )


@pytest.mark.parametrize("vocabulary", [search.VOCABULARY, 3])
def test_ranks_with_ties_nulls_long_texts_and_clashing_columns(tables, monkeypatch, vocabulary):
    monkeypatch.setattr(search, "VOCABULARY", vocabulary)
    clash = {c: F.lit("x") for c in ("id", "n", "terms", "term", "row", "item", "score", "rank", "band", "df")}
    docs, items = (t.withColumns(clash) for t in tables)
    assert result(search.rank(docs, items)) == ranked(*sample_rows())


@pytest.mark.parametrize("k", [1, 3, 2_000])
def test_other_lengths(tables, k):
    assert result(search.rank(*tables, k=k)) == ranked(*sample_rows(), k=k)


def test_empty_tables(tables):
    docs, items = tables
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0)), (docs.filter("doc_id = 601"), items)):
        found = search.rank(a, b)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_common_terms_make_no_accumulators(tables, monkeypatch):
    """Items with enough rare matches are closed before their common terms."""
    seen = []
    survivors = search._survivors

    def watched(postings, asked, k):
        found = survivors(postings, asked, k)
        seen.append({r.item: (r.n, r.closed) for r in found.groupBy("item").agg(F.count("*").alias("n"), F.max("closed").alias("closed")).collect()})
        return found

    monkeypatch.setattr(search, "_survivors", watched)
    docs, items = tables
    search.rank(docs, items.filter("item_id in (30, 36)"), k=1).collect()
    assert seen[0]["=30"][1] == search.BANDS - 1
    assert seen[0]["=36"][1] < search.BANDS - 1 and seen[0]["=36"][0] < 20
