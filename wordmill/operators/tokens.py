"""Text -> word stream (X8, E2) with stop-word and length filters.

A *normalizer* turns rows with a text column into rows with a ``word``
column (one row per word, other requested columns kept). Three adapters:

* :func:`regex_tokens` - surface tokens, pure Spark expressions (default);
* :func:`lemma_table` - surface tokens mapped through a lemma table by a join;
* :func:`model_normalizer` - any Python tokenizer/lemmatizer, run as an
  iterator ``pandas_udf`` that loads its model once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from wordmill.constants import BROADCAST_MAX_ROWS, DEFAULT_MIN_LENGTH
from wordmill.functions.text import strip_ws, token_array
from wordmill.plans.physical import bounded_broadcast

Normalizer = Callable[[DataFrame, str, Sequence[str]], DataFrame]

# Literal stop-word lists up to this size become an in-code hash set (InSet);
# larger ones, and any DataFrame, go through a (size-checked) anti join.
INLINE_STOPWORDS_MAX = 2_000


def regex_tokens(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Lower-case word tokens, one row each."""
    return df.select(*keep, F.explode(token_array(text_col)).alias("word"))


class LemmaTable:
    """Normalizer mapping each token through ``lemmas(token, lemma)``.

    Tokens without an entry keep their surface form; the lemma is
    lower-cased (the stop-word and length filters run on lemmas). The table
    is broadcast only when its size check passes; a full dictionary falls
    back to a shuffle join chosen by Catalyst/AQE.

    Because the mapping is per token, counting analyses first count surface
    tokens (partial aggregation) and join the *distinct* tokens to the
    table (see :func:`counted_words`), never every token occurrence.
    """

    def __init__(self, lemmas: DataFrame, max_broadcast_rows: int = BROADCAST_MAX_ROWS, cache_key: str | None = None):
        self.cache_key = cache_key
        table = lemmas.select(F.col("token").alias("_token"), F.col("lemma").alias("_lemma"))
        self.table = bounded_broadcast(table, max_broadcast_rows)

    def map_words(self, words: DataFrame, cols: Sequence[str]) -> DataFrame:
        joined = words.join(self.table, words["word"] == self.table["_token"], "left")
        return joined.select(*cols, F.lower(F.coalesce("_lemma", "word")).alias("word"), *[c for c in words.columns if c not in (*cols, "word")])

    def __call__(self, df: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
        return self.map_words(regex_tokens(df, text_col, keep), keep)


def lemma_table(lemmas: DataFrame, max_broadcast_rows: int = BROADCAST_MAX_ROWS, cache_key: str | None = None) -> LemmaTable:
    return LemmaTable(lemmas, max_broadcast_rows, cache_key)


def model_normalizer(load_model: Callable[[], Callable[[str], list[str]]], cache_key: str | None = None) -> Normalizer:
    """Normalizer backed by a Python model (tokenizer + lemmatizer).

    ``load_model()`` runs once per task (not per row); the returned callable
    maps one text to its list of lemmas. Arrow moves texts in batches. This
    is the slow path: use it only when the words must come from a model.
    ``cache_key`` names the model and its version; cached results need it.
    """

    @F.pandas_udf(ArrayType(StringType()))
    def _lemmas(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            yield texts.map(lambda t: [] if t is None else [w.lower() for w in model(t)])

    def normalize(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*keep, F.explode(_lemmas(F.col(text_col))).alias("word"))

    normalize.cache_key = cache_key
    return normalize


def drop_stopwords(words: DataFrame, stopwords: Iterable[str] | DataFrame | None) -> DataFrame:
    """Remove stop words. Entries of a list or of a frame's first
    column are stripped and lower-cased and then match exactly."""
    if stopwords is None:
        return words
    if isinstance(stopwords, DataFrame):
        word = F.lower(strip_ws(stopwords.columns[0]))
        table = bounded_broadcast(stopwords.select(word.alias("word")).filter("word <> ''").distinct())
        return words.join(table, "word", "left_anti")
    values = sorted({w.strip().lower() for w in stopwords if w and w.strip()})
    if not values:
        return words
    if len(values) <= INLINE_STOPWORDS_MAX:
        return words.filter(~F.col("word").isin(values))
    spark = words.sparkSession
    table = bounded_broadcast(spark.createDataFrame([(v,) for v in values], "word string"))
    return words.join(table, "word", "left_anti")


def min_length(words: DataFrame, n: int) -> DataFrame:
    """Keep words of at least ``n`` characters (code points)."""
    return words.filter(F.length("word") >= n)


def tokens(
    df: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] = (),
    normalizer: Normalizer = regex_tokens,
    stopwords: Iterable[str] | DataFrame | None = None,
    min_len: int = DEFAULT_MIN_LENGTH,
) -> DataFrame:
    """The cleaned word stream: normalize, drop stop words, drop short words.

    ``min_len`` defaults to 3, i.e. the "longer than two characters" rule.
    """
    words = normalizer(df, text_col, keep)
    return min_length(drop_stopwords(words, stopwords), min_len)


def counted_words(
    df: DataFrame,
    text_col: str = "text",
    keys: Sequence[str] = (),
    normalizer: Normalizer = regex_tokens,
    stopwords: Iterable[str] | DataFrame | None = None,
    min_len: int = DEFAULT_MIN_LENGTH,
) -> DataFrame:
    """``keys..., word, count`` of the cleaned word stream.

    Counting is partial (map-side) + final hash aggregation, so a word that
    holds a large share of all tokens is combined inside every task before
    the shuffle. With a lemma table, surface tokens are counted first and
    only the distinct ``(keys, token)`` rows meet the table; the counts are
    then re-aggregated per lemma.
    """
    if isinstance(normalizer, LemmaTable):
        surface = regex_tokens(df, text_col, keys).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("count"))
        mapped = min_length(drop_stopwords(normalizer.map_words(surface, keys), stopwords), min_len)
        return mapped.groupBy(*keys, "word").agg(F.sum("count").cast("bigint").alias("count"))
    words = tokens(df, text_col, keys, normalizer, stopwords, min_len)
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("count"))


regex_tokens.cache_key = "regex"
