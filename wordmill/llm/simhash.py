"""Near-duplicate detection: SimHash with a byte-position inverted index.

A document's fingerprint has 64 bits: bit ``i`` is 1 if it is set in more than
half of the XXH64 hashes (seed 42) of its ``words``-word shingles, repeats
included (A-Z lower-cased, shingles joined by a space, a shorter text is one
shingle, a text without words has fingerprint zero). Fingerprints that differ
in ``bits`` bits at most are linked.

1. *Classes.* Equal fingerprints fold to one row, map side first, so a group of
   copies is one row from here on.
2. *Index.* The tokens of a fingerprint are its eight positional bytes. Two
   fingerprints within ``bits`` bits share at least ``8 - bits`` of them
   (``bits`` is even, up to 6). A posting list is kept for every combination of ``entry``
   positional bytes (``entry <= 8 - bits``), over the first ``bits + entry``
   positions: a pair that shares ``8 - bits`` of all eight bytes shares
   ``entry`` of those, so it meets in some list. With four bytes an entry a
   list holds ``N / 2**32`` random fingerprints, so lists of unrelated
   fingerprints stay short up to some 10**10 distinct ones.
3. *Count filter and verification.* For pairs of a list the shared positional
   bytes are tallied; pairs that reach ``8 - bits`` are verified by the bits
   that differ. Every member is paired with its list's pivot first (the
   fingerprint of most documents); components of these links follow.
4. *Lists that still hold several components.* Up to ``LIST`` members, all
   pairs across components are tallied and verified inside the row. Members
   of longer lists are compared without pairs: two fingerprints differ in
   ``bits`` bits or fewer (an even number) exactly if some value lies within
   ``bits / 2`` of both. So every member emits the values around it,
   2,081 for four bits, and components that meet in a value are one. The rows
   grow with the members, never with their square.
5. *Components* by tables (``near_dedup.components``); nothing is collected.

Defined cases: null text is empty, empty texts are linked like any other (their
fingerprints are equal); rows that share an id are one document, their links
add up; a null id has a fingerprint, no component and links nothing; an empty
table gives an empty result. Only the id and the text are read, so other
columns may have any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import long_rows, quoted, utf8
from wordmill.llm.near_dedup import components
from wordmill.plans.physical import bounded_broadcast, materialize

WORDS = 4
BITS = 4
ENTRY = 4  # positional bytes in an entry of the index
LIST = 128  # members up to which pairs of a posting list are formed in its row
SEED = 42
HASHES = 1 << 16  # hashes whose bits are counted at a time


def fingerprint(body: bytes, words: int = WORDS) -> int:
    """Fingerprint of a text, as a signed 64-bit number."""
    tokens = body.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(words, len(tokens))
    places = zip(starts[: len(tokens) - size + 1].tolist(), ends[size - 1 :].tolist())
    n = len(tokens) - size + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in places), np.dtype("<u8"), n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, HASHES):
        part = hashes[i : i + HASHES].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(body, words) for body in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc", "fp"])

    return run


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def entry_masks(bits: int, entry: int) -> list[int]:
    """One mask a posting-list place: the bytes of ``entry`` of the first
    ``bits + entry`` positions."""
    if bits % 2 or not 0 <= bits <= 6:
        raise ValueError("bits is an even number up to 6: the halves of a difference meet in one value")
    if not 0 < entry <= 8 - bits:
        raise ValueError(f"an entry has 1 to {8 - bits} positional bytes")
    places = itertools.combinations(range(bits + entry), entry)
    return [_signed(sum(0xFF << 8 * p for p in place)) for place in places]


def ball_masks(radius: int) -> list[int]:
    """All changes of at most ``radius`` of 64 bits."""
    flips = (c for r in range(radius + 1) for c in itertools.combinations(range(64), r))
    return [_signed(sum(1 << i for i in c)) for c in flips]


def _longs(values: list[int]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<bigint>")


def shared_bytes(a: Column, b: Column) -> Column:
    """The tally: positional bytes that two fingerprints share."""
    x = a.bitwiseXOR(b)
    same = [F.when(x.bitwiseAND(F.lit(_signed(0xFF << 8 * i))) == 0, 1).otherwise(0) for i in range(8)]
    return sum(same[1:], same[0])


def _linked(a: Column, b: Column, bits: int) -> Column:
    return (shared_bytes(a, b) >= 8 - bits) & (F.bit_count(a.bitwiseXOR(b)) <= bits)


KEY = ["place", "value"]


def similar_fingerprints(prints: DataFrame, bits: int = BITS, entry: int = ENTRY) -> DataFrame:
    """``a, b``: links whose components are those of all pairs of ``prints(fp, n)``
    (distinct fingerprints, ``n`` documents each) within ``bits`` bits."""
    masks = entry_masks(bits, entry)
    entries = prints.select("fp", "n", F.posexplode(_longs(masks)).alias("place", "mask")).select(
        "place", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp", "n"
    )
    lists = entries.groupBy(*KEY).agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    lists = materialize(lists, "simhash-lists")
    postings = materialize(entries.join(bounded_broadcast(lists), KEY), "simhash-postings")

    # Every member against the pivot of its list.
    pivots = postings.groupBy(*KEY).agg(F.max(F.struct("n", "fp")).alias("pivot"))
    pivots = materialize(pivots.select(*KEY, F.col("pivot.fp").alias("pivot")), "simhash-pivots")
    starred = postings.join(bounded_broadcast(pivots), KEY).filter("fp <> pivot")
    starred = starred.filter(_linked(F.col("fp"), F.col("pivot"), bits))
    links = materialize(starred.select(F.col("fp").alias("a"), F.col("pivot").alias("b")).distinct(), "simhash-links")
    more = _across(postings, components(links), bits)
    return materialize(links.unionByName(more).distinct(), "simhash-all-links")


def _across(postings: DataFrame, labels: DataFrame, bits: int) -> DataFrame:
    """Links across components in lists that hold several."""
    labels = labels.withColumnRenamed("node", "fp")
    named = postings.join(bounded_broadcast(labels), "fp", "left")
    named = materialize(named.select(*KEY, "fp", "m", F.coalesce("component", "fp").alias("component")), "simhash-named")
    mixed = named.groupBy(*KEY).agg(F.min("component").alias("x"), F.max("component").alias("y"))
    # A list of two was settled by its pivot.
    opened = materialize(mixed.filter("x <> y").select(*KEY), "simhash-mixed")
    opened = named.filter("m > 2").join(bounded_broadcast(opened), KEY, "left_semi")

    members = opened.filter(F.col("m") <= LIST).groupBy(*KEY).agg(F.collect_list(F.struct("fp", "component")).alias("all"))
    pair = lambda a, b: F.struct(a["fp"].alias("a"), b["fp"].alias("b"))
    apart = lambda a, b: (a["fp"] < b["fp"]) & (a["component"] != b["component"]) & _linked(a["fp"], b["fp"], bits)
    pairs = F.transform(
        "all", lambda a: F.transform(F.filter("all", lambda b: apart(a, b)), lambda b: pair(a, b))
    )
    short = members.select(F.explode(F.flatten(pairs)).alias("p")).select("p.a", "p.b").distinct()

    # Values within half the bits of a member: two members share one exactly
    # if they are linked, so components that meet there are one.
    crowd = materialize(opened.filter(F.col("m") > LIST).select("fp", "component").distinct(), "simhash-crowd")
    around = crowd.withColumn("flip", F.explode(_longs(ball_masks(bits // 2))))
    around = around.select("component", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    meet = around.groupBy("value").agg(F.min("component").alias("a"), F.max("component").alias("z")).filter("a <> z")
    meet = materialize(meet.select("value", "a"), "simhash-meet")
    long = around.join(bounded_broadcast(meet), "value").select("a", F.col("component").alias("b"))
    return short.unionByName(long.filter("a <> b").distinct())


def near_fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    bits: int = BITS,
    entry: int = ENTRY,
) -> DataFrame:
    """``doc, fp, component`` per row of ``docs``."""
    long_rows(docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(quoted(id_col).alias("doc"), utf8(quoted(text_col)).alias("text"))
    signed = materialize(texts.mapInArrow(_fingerprints(words), f"doc {id_type}, fp bigint"), "simhash-signed")
    known = signed.filter(F.col("doc").isNotNull())
    prints = known.groupBy("fp").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
    prints = materialize(prints, "simhash-prints")
    links = similar_fingerprints(prints.select("fp", "n"), bits, entry)
    # Rows that share an id are one document.
    held = known.groupBy("doc").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a <> z")
    own = held.join(known.select("doc", F.col("fp").alias("b")), "doc").filter("a <> b").select("a", "b").distinct()
    labels = components(links.unionByName(own)).withColumnRenamed("node", "fp")
    named = prints.select("fp", "first").join(bounded_broadcast(labels), "fp", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "fp")), "simhash-ids")
    lowest = materialize(named.groupBy("component").agg(F.min("first").alias("lowest")), "simhash-lowest")
    found = named.join(bounded_broadcast(lowest), "component").select("fp", "lowest")
    found = materialize(found, "simhash-found")
    return signed.join(bounded_broadcast(found), "fp", "left").select(
        "doc", "fp", F.when(F.col("doc").isNotNull(), F.col("lowest")).alias("component")
    )


def mark_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hexadecimal
    digits) and ``component_id``; other columns are not carried along."""
    found = near_fingerprints(docs, id_col, text_col, **options)
    return found.select(
        F.col("doc").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
