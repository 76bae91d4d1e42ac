"""Large groups of near-copies with strays: pairs formed, and the prior of the
quality classifier beyond its sample."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wordmill.llm import near_dedup, quality


@pytest.mark.parametrize("limit", [5_000, 40])
def test_pairs_are_strays_times_members(spark, monkeypatch, limit):
    monkeypatch.setattr(near_dedup, "GROUP_SLICE", limit)
    rows = [("hot", "main", i) for i in range(600)] + [("hot", f"s{i % 2}", 1000 + i) for i in range(3)]
    rows += [("one", "x", 2000), ("one", "x", 2001), ("two", "p", 3000), ("two", "q", 3001)]
    frame = spark.createDataFrame(rows, "hub string, component string, class long")
    pairs = [(r.class_a, r.class_b) for r in near_dedup._stray_pairs(frame, ["hub"], ["class", "component"]).collect()]
    want = {
        frozenset((x[2], y[2])) for x, y in itertools.combinations(rows, 2) if x[0] == y[0] and x[1] != y[1]
    }
    assert len(pairs) == len(want) == 3 * 600 + 2 + 1
    assert {frozenset(p) for p in pairs} == want


def test_hub_of_many_copies_and_strays(spark, monkeypatch):
    """The large component's classes are never compared with each other."""
    formed = []
    stray_pairs = near_dedup._stray_pairs

    def counted(rows, on, columns):
        pairs = stray_pairs(rows, on, columns)
        formed.append((pairs.count(), rows.count()))
        return pairs

    monkeypatch.setattr(near_dedup, "_stray_pairs", counted)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(300):  # one word of its own each: similar to the text, less to each other
        text = list(base)
        text[i % 80] = f"own{i}"
        rows.append((i, " ".join(text)))
    for i in range(3):
        rows.append((1000 + i, " ".join(base[:52] + [f"stray{i}x{j}" for j in range(28)])))
    done = near_dedup.mark_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85)
    component, _ = brute.near_components(rows, 3, 85)
    assert {r.doc_id: r.component_id for r in done.collect()} == component
    assert all(n <= 3 * members for n, members in formed)


@pytest.mark.parametrize("bad, good", [(100, 100), (20, 90), (100, 5_000), (4_000, 400)])
def test_prior_beyond_the_sample(spark, bad, good):
    rows = [(i, int(i >= bad)) for i in range(bad + good)]
    labels = spark.createDataFrame([*rows, *rows[:9], (None, 1), (1, None)], "doc_id long, quality int")
    known = quality.known_labels(labels, "doc_id", "quality")
    want = np.log(min(bad, 100) / bad) - np.log(min(good, 100) / good)
    assert quality.prior_shift(known, 200) == pytest.approx(want)
    assert quality.labelled_sample(known, 200).count() == min(bad, 100) + min(good, 100)


def test_probability_does_not_depend_on_the_sample_share(spark):
    """Noisy labels with 10 % bad rows of one kind of text: the probability of
    that text is near 0.9, whether the sample is balanced or not."""
    rows = [(i, f"plain text number {i % 3} of one kind only", int(i % 10 > 0)) for i in range(3_000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    for max_rows in (10_000, 600):
        model = quality.fit_quality(docs, labels, max_rows=max_rows)
        p = [r.probability for r in quality.score_quality(docs.limit(30), model).collect()]
        assert 0.82 < np.mean(p) < 0.95, max_rows
