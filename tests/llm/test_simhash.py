"""SimHash near-duplicates against fingerprints and links by brute force."""

import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import brute
from wordmill.llm import simhash
from wordmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    words = brute.split_words(brute.lower(text))
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def components(prints, same=()):
    """{doc: (hex, smallest doc reachable)} of (doc, fingerprint) rows."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(d, f) for d, f in prints if d is not None]
    for (_, a), (_, b) in itertools.combinations({f: (d, f) for d, f in known}.values(), 2):
        if (a ^ b).bit_count() <= 4:
            parent[find(a)] = find(b)
    for (d, a), (e, b) in itertools.combinations(known, 2):
        if d == e:
            parent[find(a)] = find(b)
    low = {}
    for d, f in known:
        low[find(f)] = min(low.get(find(f), d), d)
    return sorted((str(d), f"{f:016x}", low[find(f)] if d is not None else None) for d, f in prints)


def result(df):
    return sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in df.collect())


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = components([(d, fingerprint(t)) for d, t in rows])
    assert result(QUERIES["op11_simhash_near_dedup"](spark, SF)) == want


def sample_rows():
    rng = random.Random(2)
    word = lambda: rng.choice("red green blue gold grey".split()) + str(rng.randint(0, 30))
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE"), (5, "one two three"), (6, "É é\x0bx"), (7, "y" * 300_000)]
    rows += [(8, " ".join(word() for _ in range(70_000))), (None, "one"), (None, None)]
    base = [word() for _ in range(400)]
    for i in range(10, 130):
        text = list(base)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(400)] = word()
        rows.append((i, " ".join(text)))
    rows += [(20, "another text of the same id"), (21, rows[15][1]), (130, rows[40][1].upper())]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample_rows(), "doc_id long, text string").repartition(4)


def test_nulls_copies_long_texts_and_clashing_columns(docs):
    clashing = docs.withColumns({c: F.lit(1) for c in ("doc", "fp", "n", "component", "component_id", "fingerprint", "value", "place")})
    want = components([(d, fingerprint(t)) for d, t in sample_rows()])
    assert result(simhash.mark_similar(clashing)) == want


def test_empty_table(docs):
    assert simhash.mark_similar(docs.limit(0)).collect() == []


@pytest.mark.parametrize("entry, limit", [(2, 128), (3, 3), (4, 3), (4, 128)])
def test_links_of_a_crowd(spark, monkeypatch, entry, limit):
    """Fingerprints around some centres: few bits apart, chains, strays. Lists
    above ``limit`` are compared by the values around their members."""
    monkeypatch.setattr(simhash, "LIST", limit)
    rng = random.Random(entry * 100 + limit)
    values = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            near = centre
            for _ in range(rng.randint(0, 9)):
                near ^= 1 << rng.randrange(64)
            values.add(near)
    prints = sorted(values)
    frame = spark.createDataFrame([(simhash._signed(v), rng.randint(1, 3)) for v in prints], "fp long, n long")
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.similar_fingerprints(frame, entry=entry).collect()]
    parent = {v: v for v in prints}
    want = {v: v for v in prints}

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in links:
        parent[find(parent, a)] = find(parent, b)
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 4:
            want[find(want, a)] = find(want, b)
    groups = lambda p: {frozenset(x for x in prints if find(p, x) == r) for r in {find(p, x) for x in prints}}
    assert groups(parent) == groups(want)


def test_masks():
    assert len(simhash.entry_masks(4, 4)) == 70
    assert len(set(simhash.ball_masks(2))) == 1 + 64 + 64 * 63 // 2
    for bits, entry in ((3, 4), (4, 5), (8, 1)):
        with pytest.raises(ValueError):
            simhash.entry_masks(bits, entry)
