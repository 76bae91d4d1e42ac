"""Near-duplicate detection: MinHash with tensored banding, verified.

A document's set is its distinct shingles of ``words`` words (A-Z lower-cased;
a shorter text is one shingle; a text without words has none and is linked
with nothing). Documents are linked when their sets overlap by at least
``percent`` (100 * intersection >= percent * union).

1. *Classes.* Documents with the same set are one class (128-bit digest of the
   sorted set and its size), folded before the shuffle, so a group of exact
   copies is one row from here on.
2. *Tensored banding.* Two small collections of ``s`` band hashes of ``k``
   minhashes each replace ``s * s`` independent bands: every pair of a band of
   the one and a band of the other collection is a table key. The
   ``2 * s * k`` minhashes serve ``s * s`` tables. Two sets with similarity
   ``p`` share a key with probability ``(1 - (1 - p**k)**s)**2``; ``s`` follows
   from the threshold and ``miss``, the chance to lose a pair right at the
   threshold. Bands that no other class shares are dropped before keys are
   formed.
3. *Verification.* In each bucket every class is compared on full sets with the
   bucket's pivot, the member with most neighbours, such as the text that the
   others are copies of. Components of the links follow. Where a bucket still
   holds several components, links across them are searched too, in exact steps.
   Classes around the same hub (the pivot with the highest score that a class
   has met) are compared by their differences from the hub: with ``added`` and
   ``removed`` shingles, the overlap of two classes is the hub's size less the
   union of what they removed, plus the common part of what they added. Classes
   of different hubs meet by bands; shingles that no other class of such buckets
   has bound their overlap from above, and pairs that the bound allows are
   compared on full sets. Pairs inside a component need no comparison: they
   cannot change it. So in each group the largest component is left out of one
   side, and pairs formed are at most its strays times its members.
4. *Components* by repeated minimum over neighbours with pointer jumping, all
   in tables; nothing is collected.

Defined cases: null text is empty; a document without words is its own
component; rows that share an id are one document, their links add up; a null
id has a null component and is kept; an empty table gives an empty result. The
result columns replace columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from wordmill.llm.common import long_rows, quoted, unused_name, utf8
from wordmill.plans.physical import bounded_broadcast, delete_path, materialize, materialized, scratch_path

WORDS = 5
PERCENT = 80
BAND = 3  # minhashes in a band
MISS = 2e-5
SEED = 17
CACHED_WORDS = 150_000
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def n_bands(percent: float, k: int = BAND, miss: float = MISS) -> int:
    """Bands in each collection, so that two sets right at the threshold share
    no key with probability ``miss`` at most."""
    p = min(percent / 100, 0.999)
    return max(1, math.ceil(math.log(miss / 2) / math.log(1 - p**k)))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(body: bytes, words: int, hashed: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    tokens = body.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashed.__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ h[i : i + n]) * MIX[i % 3]
        out ^= out >> np.uint64(31)
    return np.unique(out)


def minhash_parameters(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 2**63, (2, n), dtype=np.uint64)
    return a << np.uint64(1) | np.uint64(1), b


def minhashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set, some functions at a time so
    that long texts stay within memory."""
    step = max(1, (1 << 21) // max(1, len(shingles)))
    parts = [
        (shingles[None, :] * a[i : i + step, None] + b[i : i + step, None]).min(axis=1) for i in range(0, len(a), step)
    ]
    return np.concatenate(parts)


def _signatures(words: int, s: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        a, b = minhash_parameters(2 * s * k)
        for batch in batches:
            sets, bands, sizes = [], [], []
            for body in batch.column(1).to_pylist():
                shingles = shingle_set(body, words, hashed)
                sizes.append(len(shingles))
                if not len(shingles):
                    sets.append(None)
                    bands.append(None)
                    continue
                sets.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                mins = minhashes(shingles, a, b).reshape(2 * s, k)
                bands.append([xxhash.xxh3_64_intdigest(m.tobytes(), i) >> 1 for i, m in enumerate(mins)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc", "n_shingles", "class", "bands"],
            )

    return run


def _sets(words: int):
    """Classes and full sets (as bytes) of documents asked for by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            classes, sets = [], []
            for body, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                shingles = shingle_set(body, words, hashed).tobytes()
                if xxhash.xxh3_128_digest(shingles) == wanted:
                    classes.append(wanted)
                    sets.append(shingles)
            yield pa.RecordBatch.from_pydict({"class": pa.array(classes, pa.binary()), "set": pa.array(sets, pa.binary())})

    return run


OVERLAP = StructType([StructField("common", LongType()), StructField("union", LongType())])


@F.arrow_udf(OVERLAP)
def _overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    """Sizes of the intersection and of the union of two sets."""
    common, union = [], []
    for x, y in zip(left.to_pylist(), right.to_pylist()):
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        common.append(len(np.intersect1d(a, b, assume_unique=True)))
        union.append(len(a) + len(b) - common[-1])
    return pa.StructArray.from_arrays([pa.array(common, pa.int64()), pa.array(union, pa.int64())], OVERLAP.names)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``: the smallest node
    that can be reached. Every round takes the minimum over the neighbours and
    then follows the label once more; rounds end when no label moves."""
    spark = links.sparkSession
    edges = materialize(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "cc-edges"
    )
    path = scratch_path(spark, "cc-labels")
    schema = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).schema
    start = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    start.write.parquet(f"{path}/0")
    labels, turn = spark.read.schema(schema).parquet(f"{path}/0"), 0
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("low")
        )
        up = labels.select(F.col("node").alias("low"), F.col("component").alias("up"))
        moved = lower.join(up, "low").select("node", F.least("low", "up").alias("component"), "old")
        turn += 1
        moved.write.parquet(f"{path}/{turn}")
        done = spark.read.schema(moved.schema).parquet(f"{path}/{turn}")
        still = done.filter(F.col("component") != F.col("old")).isEmpty()
        delete_path(spark, f"{path}/{turn - 1}")
        labels = done.select("node", "component")
        if still:
            return labels


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    band: int = BAND,
    miss: float = MISS,
) -> DataFrame:
    """``doc, n_shingles, component, class`` per row of ``docs``; ``component``
    is the smallest id reachable over links."""
    long_rows(docs)
    s = n_bands(percent, band, miss)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(quoted(id_col).alias("doc"), utf8(quoted(text_col)).alias("text"))
    schema = f"doc {id_type}, n_shingles bigint, class binary, bands array<bigint>"
    signed = materialize(texts.mapInArrow(_signatures(words, s, band), schema), "near-signatures")

    # Copies fold inside each task; equal classes have equal bands.
    classes = materialize(
        signed.filter(F.col("class").isNotNull() & F.col("doc").isNotNull())
        .groupBy("class")
        .agg(F.min("doc").alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "near-classes",
    )
    buckets = _buckets(classes, s)
    sets = _full_sets(texts, classes, buckets, words)

    # Every member against the pivot of its bucket.
    pivots = materialize(buckets.groupBy("key").agg(F.max(F.struct("score", "class", "n")).alias("pivot")), "near-pivots")
    starred = buckets.join(pivots, "key").select(
        F.col("pivot.class").alias("a"), F.col("pivot.n").alias("n_a"), F.col("class").alias("b"), F.col("n").alias("n_b")
    )
    links = _links(starred.filter("a <> b"), sets, percent).unionByName(_same_id(classes, signed))
    links = materialize(links, "near-links")
    labels = components(links)

    able = _unsettled(classes, buckets, pivots, sets, labels, s, percent)
    apart = _links(_across_hubs(able, percent), sets, percent)
    more = materialize(_around_hubs(able, percent).unionByName(apart), "near-more")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    labels = labels.withColumnRenamed("node", "class")
    ids = classes.select("class", "first").join(labels, "class", "left")
    ids = materialize(ids.withColumn("component", F.coalesce("component", "class")), "near-ids")
    lowest = materialize(ids.groupBy("component").agg(F.min("first").alias("lowest")), "near-lowest")
    named = materialize(ids.join(lowest, "component").select("class", "lowest"), "near-components")
    return signed.drop("bands").join(bounded_broadcast(named), "class", "left").select(
        "doc", "n_shingles", F.coalesce("lowest", "doc").alias("component"), "class"
    )


def _same_id(classes: DataFrame, signed: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id."""
    named = signed.filter(F.col("class").isNotNull() & F.col("doc").isNotNull())
    held = named.groupBy("doc").agg(F.min("class").alias("a"), F.max("class").alias("z")).filter("a <> z")
    return held.join(named.select("doc", F.col("class").alias("b")), "doc").filter("a <> b").select("a", "b").distinct()


def _buckets(classes: DataFrame, s: int) -> DataFrame:
    """``key, class, n, score`` of every table key that two classes or more
    share; the score adds up the classes that share a class's bands."""
    bands = classes.select("class", "n", F.posexplode("bands").alias("place", "band"))
    shared = bands.groupBy("place", "band").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    shared = materialize(shared, "near-bands")
    live = bands.join(shared, ["place", "band"]).groupBy("class").agg(
        F.first("n").alias("n"),
        F.sum("m").alias("score"),
        F.collect_list(F.struct("place", "band")).alias("bands"),  # 2 * s at most
    )
    sides = live.select(
        "class",
        "n",
        "score",
        F.filter("bands", lambda b: b["place"] < s).alias("left"),
        F.filter("bands", lambda b: b["place"] >= s).alias("right"),
    )
    keys = (
        sides.withColumn("left", F.explode("left"))
        .withColumn("right", F.explode("right"))
        .select("class", "n", "score", F.xxhash64("left.place", "left.band", "right.place", "right.band").alias("key"))
    )
    with materialized(keys, "near-keys") as keys:
        full = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key"), "near-full")
        return materialize(keys.join(full, "key"), "near-buckets")


def _full_sets(texts: DataFrame, classes: DataFrame, buckets: DataFrame, words: int) -> DataFrame:
    """``class, set`` for the classes in any bucket, read from the text of one
    document of each."""
    wanted = classes.join(buckets.select("class").distinct(), "class", "left_semi").select("class", "first")
    wanted = bounded_broadcast(materialize(wanted, "near-wanted"))
    found = texts.join(wanted, F.col("doc") == F.col("first")).select("text", "class")
    sets = found.mapInArrow(_sets(words), "class binary, set binary")
    return materialize(sets, "near-sets")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the distinct pairs that are linked on full sets. Sizes that
    rule a link out save the comparison."""
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    pairs = materialize(pairs.filter(sizes).select("a", "b").distinct(), "near-pairs")
    left = sets.select(F.col("class").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("set").alias("set_b"))
    common = pairs.join(left, "a").join(right, "b").select("a", "b", _overlap("set_a", "set_b").alias("o"))
    linked = common.filter(100 * F.col("o.common") >= percent * F.col("o.union"))
    return materialize(linked.select("a", "b"), "near-links")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, blob in zip(*(c.to_pylist() for c in batch.columns)):
            elements = np.frombuffer(blob, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(elements), pa.DictionaryArray.from_arrays(np.zeros(len(elements), np.int32), [name]).cast(pa.binary())],
                ["element", "class"],
            )


DIFFERENCE = StructType(
    [StructField("added", ArrayType(LongType())), StructField("removed", ArrayType(LongType())), StructField("size", LongType())]
)


@F.arrow_udf(DIFFERENCE)
def _difference(own: pa.Array, hub: pa.Array) -> pa.Array:
    """What a set has beyond its hub's, what it lacks, and the hub's size. Null
    for a set that shares less than half with its hub."""
    rows = []
    for x, y in zip(own.to_pylist(), hub.to_pylist()):
        if x is None or y is None:
            rows.append(None)
            continue
        a, b = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
        added, removed = np.setdiff1d(a, b, assume_unique=True), np.setdiff1d(b, a, assume_unique=True)
        near = 2 * (len(added) + len(removed)) <= len(a) + len(b)
        rows.append({"added": added, "removed": removed, "size": len(b)} if near else None)
    longs = pa.list_(pa.int64())
    return pa.array(rows, pa.struct([("added", longs), ("removed", longs), ("size", pa.int64())]))


def _unsettled(
    classes: DataFrame, buckets: DataFrame, pivots: DataFrame, sets: DataFrame, labels: DataFrame, s: int, percent: int
) -> DataFrame:
    """The classes that may have links across components: those in a bucket
    with several components, unless too many of their shingles are theirs alone.

    A shingle that one class alone has, of all classes in such buckets, is
    common to no pair. So a class can share ``most = n - alone`` shingles at
    most; where that is below the threshold against every size of partner, the
    class has no link there.
    """
    labels = labels.withColumnRenamed("node", "class")
    named = buckets.select("key", "class").join(pivots, "key").join(labels, "class", "left")
    named = named.select("key", "class", "pivot", F.coalesce("component", "class").alias("component"))
    named = materialize(named, "near-named")
    mixed = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    mixed = materialize(mixed.select("key"), "near-mixed")
    opened = named.join(mixed, "key", "left_semi").groupBy("class", "component").agg(F.max("pivot").alias("pivot"))
    opened = materialize(opened.select("class", "component", F.col("pivot.class").alias("hub")), "near-open")
    elements = sets.join(opened.select("class"), "class", "left_semi").mapInArrow(_elements, "element bigint, class binary")
    single = elements.groupBy("element").agg(F.count(F.lit(1)).alias("m"), F.min("class").alias("class")).filter("m = 1")
    alone = materialize(single.groupBy("class").agg(F.count(F.lit(1)).alias("alone")), "near-alone")
    able = (
        opened.join(alone, "class", "left")
        .join(classes.select("class", "n", F.slice("bands", 1, s).alias("bands")), "class")
        .withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0)))
        .filter(100 * F.col("most") >= percent * F.col("n"))
        .select("class", "component", "hub", "n", "most", "bands")
    )
    able = materialize(able, "near-able")
    own = sets.select("class", F.col("set").alias("own"))
    hubs = sets.select(F.col("class").alias("hub"), F.col("set").alias("of_hub"))
    compared = able.join(own, "class").join(hubs, "hub").withColumn("diff", _difference("own", "of_hub"))
    return materialize(compared.drop("own", "of_hub").dropDuplicates(["class"]), "near-differences")


def _side(able: DataFrame, mark: str, on: list[str], columns: list[str]) -> DataFrame:
    return able.select(*on, *(F.col(c).alias(f"{c}_{mark}") for c in columns))


GROUP_SLICE = 5_000  # members of a group that one task compares


def _stray_pairs(rows: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Pairs of classes of the same group (equal ``on``) and different
    components, each once, as ``<column>_a, <column>_b``.

    The largest component of a group is left out of one side: only its strays,
    the classes of other components, meet all members. So the pairs formed are
    at most strays times members; a settled component costs nothing. The members
    of a large group are dealt over several tasks, its strays go to each."""
    sizes = rows.groupBy(*on, "component").agg(F.count(F.lit(1)).alias("m"))
    groups = sizes.groupBy(*on).agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("m"), F.count(F.lit(1)).alias("parts"))
    slots = F.ceil(F.col("m") / GROUP_SLICE).cast("int")
    groups = groups.filter("parts > 1").select(*on, F.col("top.component").alias("main"), slots.alias("slots"))
    groups = bounded_broadcast(materialize(groups, "near-groups"))
    held = rows.join(groups, on)
    slot = F.pmod(F.xxhash64("class"), F.col("slots")).cast("int")
    members = _side(held.withColumn("slot", slot), "b", [*on, "slot", "main"], columns)
    strays = held.filter("component <> main").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    pairs = _side(strays, "a", [*on, "slot"], columns).join(members, [*on, "slot"])
    # Two strays meet in both orders.
    once = (F.col("component_b") == F.col("main")) | (F.col("class_a") < F.col("class_b"))
    return pairs.filter((F.col("component_a") != F.col("component_b")) & once)


def _may_link(percent: int):
    """Pairs that ``most`` allows."""
    return F.least("most_a", "most_b") * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))


def _around_hubs(able: DataFrame, percent: int) -> DataFrame:
    """Links across components between classes of the same hub."""
    near = able.filter(F.col("diff").isNotNull())
    a, b = (F.col(f"diff_{m}") for m in "ab")
    need = percent * (F.col("n_a") + F.col("n_b"))
    # First by sizes alone, then exactly.
    at_most = a["size"] - F.greatest(F.size(a["removed"]), F.size(b["removed"])) + F.least(F.size(a["added"]), F.size(b["added"]))
    common = (
        a["size"]
        - F.size(a["removed"])
        - F.size(b["removed"])
        + F.size(F.array_intersect(a["removed"], b["removed"]))
        + F.size(F.array_intersect(a["added"], b["added"]))
    )
    pairs = _stray_pairs(near, ["hub"], ["class", "component", "n", "most", "diff"])
    linked = _may_link(percent) & (at_most * (100 + percent) >= need) & (common * (100 + percent) >= need)
    return pairs.filter(linked).select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))


def _across_hubs(able: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that are not compared around one hub. They meet
    by the bands of one collection, which is enough to find every pair of a
    bucket; each pair is formed at the first band that it shares."""
    placed = able.select("*", F.posexplode("bands").alias("place", "band"), F.col("diff").isNotNull().alias("near"))
    pairs = _stray_pairs(placed, ["place", "band"], ["class", "component", "n", "most", "hub", "near", "bands"])
    done = (F.col("hub_a") == F.col("hub_b")) & F.col("near_a") & F.col("near_b")
    same = F.transform(F.arrays_zip("bands_a", "bands_b"), lambda z: z["bands_a"] == z["bands_b"])
    first = F.array_position(same, True) == F.col("place") + 1
    return pairs.filter(_may_link(percent) & ~done & first).select(
        F.col("class_a").alias("a"), F.col("class_b").alias("b"), "n_a", "n_b"
    )


def mark_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept`` (the document
    with the smallest id of each component stays)."""
    found = near_duplicates(docs, id_col, text_col, **options)
    names = {c: unused_name(docs, f"near_{c}") for c in ("doc", "component")}
    by_doc = found.filter(F.col("doc").isNotNull()).groupBy(F.col("doc").alias(names["doc"])).agg(
        F.max("n_shingles").alias("near_n"), F.min("component").alias(names["component"])
    )
    by_doc = by_doc.withColumnRenamed("near_n", unused_name(docs, "near_n"))
    n = by_doc.columns[1]
    joined = docs.join(bounded_broadcast(materialize(by_doc, "near-documents")), quoted(id_col) == F.col(names["doc"]), "left")
    component = F.col(names["component"])
    return joined.withColumns(
        {
            "n_shingles": F.coalesce(F.col(n), F.lit(0)),
            "component_id": component,
            "kept": F.coalesce(quoted(id_col) == component, F.lit(True)),
        }
    ).drop(n, *names.values())
