"""Ranked lexical search: accumulator-limited, term at a time.

Every item is a query; its terms are the maximal runs of letters, digits and
non-ASCII characters, A-Z lower-cased, once each. With ``N`` documents that hold
a term, ``L`` terms in all, ``n`` terms of a document and ``df`` documents of a
term, a term weighs ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and adds
``w * ((10**9 tf) div (1000 tf + 8 m))`` with ``m = 10 + (90 n N) div L``.

1. *Index.* One pass counts each document's terms and keeps the counts of those
   that some item asks for. Postings (term, row, impact) are written in bands of
   document frequency: a band holds the terms of at least a quarter of the
   frequency of the next, up to ``N``.
2. *Rarest first.* Bands are processed from the rarest on, all items at a time:
   postings of the band joined with the items' terms add to accumulators (item,
   row), summed in each task before they are shuffled. No key is hot, as the
   postings of a frequent term lie over all rows.
3. *Limit.* An item's remaining bound is the sum of ``w`` times the largest
   impact of its terms in the bands to come. Once it is below the kth partial
   score of the item, a row that no accumulator has seen cannot be among the
   best, so the item creates no more; its common terms are never read for rows
   without an accumulator. Accumulators whose partial score and remaining bound
   are below the kth partial score go.
4. *Survivors* of closed items get the exact rest of their score from the term
   counts of their own row, joined by row number. The best ``k`` of each item
   are taken per task before they meet.

Defined cases: null text has no terms; an item without terms, or whose terms no
document holds, has no result; a null item id is an item, items that share an
id are one item with all their terms; rows that share a document id are
documents of their own, ranked in the order of their number; a null document id
comes last in a tie; empty tables give an empty result. Texts may be of any
length. Only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import long_rows, quoted, utf8
from wordmill.plans.physical import bounded_broadcast, fits_broadcast, materialize, scratch_path

K = 10
BANDS = 6
BAND_STEP = 4
VOCABULARY = 1_000_000  # terms of all items that every task may hold

# Bytes of a term; all others end it. UTF-8 beyond ASCII has bytes from 128 on.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(body: bytes) -> list[bytes]:
    return body.translate(FOLD).split(b" ")


def _counted(wanted: frozenset[bytes] | None):
    """``id, n, terms`` of each text; of the terms only the wanted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, names, counts = [], [0], [], []
            for body in batch.column(1).to_pylist():
                found = Counter(terms_of(body))
                found.pop(b"", None)
                sizes.append(found.total())
                for term in found.keys() if wanted is None else wanted.intersection(found):
                    names.append(term)
                    counts.append(found[term])
                ends.append(len(names))
            held = pa.StructArray.from_arrays(
                [pa.array(names, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["term", "tf"]
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), lists], ["id", "n", "terms"])

    return run


def _count_terms(df: DataFrame, id_col: str, text_col: str, wanted: frozenset[bytes] | None) -> DataFrame:
    long_rows(df)
    kind = df.schema[id_col].dataType.simpleString()
    texts = df.select(quoted(id_col).alias("id"), utf8(quoted(text_col)).alias("text"))
    return texts.mapInArrow(_counted(wanted), f"id {kind}, n bigint, terms array<struct<term:string,tf:bigint>>")


def _vocabulary(terms: DataFrame) -> frozenset[bytes] | None:
    """The distinct terms of all items, if they are proven to fit a task."""
    if not fits_broadcast(terms, VOCABULARY):
        return None
    return frozenset(r["term"].encode() for r in terms.collect())


def _impact(n: Column, tf: Column, n_docs: int, n_terms: int) -> Column:
    whole = lambda a, b: F.call_function("div", a, b)
    long = lambda x: F.lit(x).cast("bigint")
    m = whole(long(90) * n * long(n_docs), long(n_terms)) + 10
    return whole(long(10**9) * tf, 1000 * tf + 8 * m)


def _best(scored: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each item. Spark keeps ``k`` rows of an item in
    each task before the shuffle (a window group limit)."""
    window = Window.partitionBy("item").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score`` (under the names of the id columns): the
    ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    key = F.when(F.col("id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("id").cast("string")))
    asked = _count_terms(items, item_col, text_col, None)
    asked = asked.select(key.alias("item"), "id", F.explode("terms.term").alias("term")).distinct()
    asked = materialize(asked, "search-asked")
    empty = spark.createDataFrame(
        [], f"{item_col} {items.schema[item_col].dataType.simpleString()}, rank int, {id_col} {docs.schema[id_col].dataType.simpleString()}, score bigint"
    )

    # The counts of each row; its number is fixed by the written table.
    terms = materialize(asked.select("term").distinct(), "search-terms")
    counted = _count_terms(docs, id_col, text_col, _vocabulary(terms)).filter("n > 0")
    counted = materialize(counted.withColumn("row", F.monotonically_increasing_id()), "search-counted")
    total = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"]
    if not n_docs:
        return empty
    impact = _impact(F.col("n"), F.col("t.tf"), n_docs, n_terms)
    places = counted.select("row", "n", F.explode("terms").alias("t"))
    places = places.select(F.col("t.term").alias("term"), "row", impact.alias("impact"))
    places = places.join(bounded_broadcast(terms), "term", "left_semi")

    # Band 0 is the rarest; the last holds the terms of over a quarter of the rows.
    rarer = [(F.col("df") * BAND_STEP**i <= n_docs).cast("int") for i in range(1, BANDS)]
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weights = places.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("impact").alias("top"))
    weights = weights.select("term", (F.lit(BANDS - 1) - sum(rarer[1:], rarer[0])).alias("band"), weight.alias("w"), "top")
    weights = materialize(weights.filter("w > 0"), "search-weights")
    asked = materialize(asked.join(bounded_broadcast(weights), "term").withColumn("bound", F.expr("w * top")), "search-weighted")

    path = scratch_path(spark, "search-postings")
    postings = places.join(bounded_broadcast(weights.select("term", "band")), "term")
    postings.write.partitionBy("band").parquet(path)
    postings = spark.read.schema(postings.schema).parquet(path)

    found = materialize(_survivors(postings, asked, k), "search-survivors")
    rest = found.join(counted.select("row", "n", "terms"), "row").select("item", "row", "closed", "n", F.explode("terms").alias("t"))
    rest = rest.withColumn("term", F.col("t.term")).join(bounded_broadcast(asked.select("item", "term", "band", "w")), ["item", "term"])
    rest = rest.filter("band > closed").select("item", "row", (F.col("w") * impact).alias("score"))
    scored = found.select("item", "row", "score").unionByName(rest).groupBy("item", "row").agg(F.sum("score").alias("score"))
    scored = scored.filter("score > 0").join(counted.select("row", F.col("id").alias("doc")), "row")
    best = _best(scored, k, F.desc("score"), F.asc_nulls_last("doc"), F.asc("row"))
    named = asked.groupBy("item").agg(F.first("id").alias("id"))
    return best.join(bounded_broadcast(named), "item").select(
        F.col("id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score"
    )


def _survivors(postings: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``item, row, score, closed``: accumulators that may be among the best,
    with their partial score over the bands up to ``closed``."""
    # What the bands after each one can still add to an item.
    rests = [F.sum(F.when(F.col("band") > b, F.col("bound")).otherwise(0)).alias(f"rest{b}") for b in range(BANDS)]
    waiting = materialize(asked.groupBy("item").agg(*rests), "search-items")
    held, done = None, []
    for band in range(BANDS):
        terms = asked.filter(F.col("band") == band).select("item", "term", "w")
        terms = terms.join(bounded_broadcast(waiting.select("item")), "item", "left_semi")
        gains = postings.filter(F.col("band") == band).join(bounded_broadcast(terms), "term")
        gains = gains.groupBy("item", "row").agg(F.sum(F.expr("w * impact")).alias("score"))
        if held is not None:
            gains = held.unionByName(gains).groupBy("item", "row").agg(F.sum("score").alias("score"))
        gains = materialize(gains, f"search-scores-{band}")
        kth = _best(gains, k, F.desc("score")).groupBy("item").agg(F.count(F.lit(1)).alias("m"), F.min("score").alias("kth"))
        rest = F.col(f"rest{band}")
        judged = waiting.join(kth.filter(F.col("m") == k), "item", "left").drop("m")
        # Without k accumulators every row may still be among the best.
        over = F.coalesce(rest < F.col("kth"), F.lit(False)) | F.lit(band == BANDS - 1)
        judged = materialize(judged.withColumn("over", over), f"search-judged-{band}")
        able = gains.join(bounded_broadcast(judged.select("item", "kth", "over", rest.alias("rest"))), "item")
        able = able.filter(F.col("kth").isNull() | (F.col("score") + F.col("rest") >= F.col("kth")))
        done.append(able.filter("over").select("item", "row", "score", F.lit(band).alias("closed")))
        held = able.filter("not over").select("item", "row", "score")
        waiting = judged.filter("not over").drop("kth", "over")
        if waiting.isEmpty():
            break
    return functools.reduce(DataFrame.unionByName, done)
