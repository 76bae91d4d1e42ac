"""Quality rules: counted rules, and a logistic regression on hashed word and
character n-grams.

*Counted rules* of a text (words are ``[^\\x20\\x09-\\x0D]+``): number of
words, code points in words, symbols ``#*$%&|<>``, lines with a word that equal
an earlier line, and words inside 8-word windows that occur twice or more. A
text fails with fewer than 20 words or with more than 30 % repeated words.

*Classifier.* Features are hashed word uni- and bigrams and hashed character
3- and 4-grams, each block as relative frequencies. A logistic regression is
fitted with Spark ML on labelled rows and calibrated (Platt scaling) on labelled
rows held out from the fit. Training takes at most ``max_rows`` labelled rows,
half of each class, those with the smallest hash of their id: a documented
bound for the fit alone. Every document is scored, in Arrow batches, over its
whole text, against the fixed threshold ``min_probability``.

Defined cases: null and empty texts have no words and fail; with no labelled
rows, or labels of one class only, there is no classifier and the counted rules
decide alone; a document with several labels takes the lowest; label rows with
nulls or without a document are not used. The result columns replace columns
of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from wordmill.llm.common import SPACE_BYTES, long_rows, quoted, unused_name, utf8
from wordmill.plans.physical import materialize

# Fixed values of the counted rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MAX_ROWS = 4_000
MIN_PROBABILITY = 0.3
BLOCK_BITS = 15  # of each of the two feature blocks
N_FEATURES = 2 << BLOCK_BITS
SCALE = 100.0
CALIBRATION_SHARE = 4  # every fourth labelled row

MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
SHIFT = np.uint64(64 - BLOCK_BITS)
CACHED_WORDS = 150_000


class WordHashes(dict):
    """64-bit hashes of words; each distinct word is hashed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside windows of ``WINDOW`` words that occur at least twice."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    window = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        window = (window ^ hashes[i : i + n]) * MIX[i % 4]
        window ^= window >> np.uint64(29)
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def duplicate_lines(body: bytes) -> int:
    seen, n = set(), 0
    for line in body.split(b"\n"):
        if line in seen:
            n += bool(line.strip(SPACE_BYTES))
        else:
            seen.add(line)
    return n


def n_code_points(words: list[bytes]) -> int:
    joined = b"".join(words)
    if joined.isascii():
        return len(joined)
    return int(((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80).sum())


def features(body: bytes, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices of all word and of all character n-grams of a text."""
    pairs = (hashes[:-1] * MIX[0] ^ hashes[1:]) * MIX[1]
    words = np.concatenate([hashes * MIX[2], pairs]) >> SHIFT
    c = np.frombuffer(body.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    three = (c[:-2] * MIX[0] ^ c[1:-1] * MIX[1] ^ c[2:] * MIX[2]) if len(c) > 2 else c[:0]
    four = three[:-1] ^ c[3:] * MIX[3] if len(c) > 3 else c[:0]
    chars = np.concatenate([three * MIX[3], four * MIX[0]]) >> SHIFT
    return words.astype(np.int64), chars.astype(np.int64) + (1 << BLOCK_BITS)


@dataclass
class QualityModel:
    """Weights of the features, and the two parameters of the calibration."""

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def parts(self) -> tuple:
        """Plain values for a broadcast variable, in the order of the fields."""
        return self.weights, self.intercept, self.slope, self.offset

    def margin(self, blocks: tuple[np.ndarray, np.ndarray]) -> float:
        return self.intercept + SCALE * sum(float(self.weights[b].mean()) for b in blocks if len(b))

    def probability(self, blocks: tuple[np.ndarray, np.ndarray]) -> float:
        z = self.slope * self.margin(blocks) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def known_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One row per labelled document: ``sample_id, label, rank``."""
    return (
        labels.filter(quoted(id_col).isNotNull() & quoted(label_col).isNotNull())
        .groupBy(quoted(id_col).alias("sample_id"))
        .agg(F.min(quoted(label_col)).cast("int").alias("label"))
        .withColumn("rank", F.xxhash64("sample_id"))
    )


def prior_shift(known: DataFrame, max_rows: int) -> float:
    """What the logarithm of the odds of good quality loses by the sample: it
    takes a smaller share of the class that is larger than ``max_rows // 2``."""
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter("label IN (0, 1)").collect()}
    if len(n) < 2:
        return 0.0
    kept = {label: min(count, max_rows // 2) / count for label, count in n.items()}
    return float(np.log(kept[0] / kept[1]))


def labelled_sample(known: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows // 2`` labelled ids of each class: those with the
    smallest hash. One row per document: label, and whether it calibrates."""
    halves = [known.filter(F.col("label") == v).orderBy("rank", "sample_id").limit(max_rows // 2) for v in (0, 1)]
    sample = halves[0].unionByName(halves[1])
    held_out = F.pmod(F.xxhash64("sample_id", F.lit("fold")), F.lit(CALIBRATION_SHARE)) == 0
    return sample.select("sample_id", "label", held_out.alias("held_out"))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = WordHashes()
    for batch in batches:
        rows = {"label": [], "held_out": [], "index": [], "value": []}
        for body, label, held_out in zip(*(c.to_pylist() for c in batch.columns)):
            index, value = [], []
            for block in features(body, hashed.of(body.split())):
                if len(block):
                    i, n = np.unique(block, return_counts=True)
                    index.append(i)
                    value.append(n * (SCALE / len(block)))
            rows["label"].append(float(label))
            rows["held_out"].append(held_out)
            rows["index"].append(np.concatenate(index) if index else np.zeros(0, np.int64))
            rows["value"].append(np.concatenate(value) if value else np.zeros(0))
        yield pa.RecordBatch.from_pydict(
            {
                "label": pa.array(rows["label"], pa.float64()),
                "held_out": pa.array(rows["held_out"], pa.bool_()),
                "index": pa.array(rows["index"], pa.list_(pa.int64())),
                "value": pa.array(rows["value"], pa.list_(pa.float64())),
            }
        )


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
) -> QualityModel | None:
    """Fit and calibrate the classifier on labelled rows of ``docs``. The
    probability is that under the shares of the classes in all labels, whatever
    part of each the sample holds."""
    long_rows(docs)
    known = known_labels(labels, id_col, label_col)
    # Bounded by max_rows, so the broadcast is too; the texts are not shuffled.
    sample = F.broadcast(labelled_sample(known, max_rows))
    texts = docs.join(sample, quoted(id_col) == F.col("sample_id")).select(
        utf8(quoted(text_col)).alias("text"), "label", "held_out"
    )
    schema = "label double, held_out boolean, index array<bigint>, value array<double>"
    rows = materialize(texts.mapInArrow(_sparse, schema), "quality-sample")
    vector = F.udf(lambda i, v: SparseVector(N_FEATURES, i, v), VectorUDT())  # max_rows rows
    counts = dict(rows.groupBy("held_out").agg(F.count_distinct("label")).collect())
    if counts.get(False) != 2:
        return None
    train = rows.filter(~F.col("held_out")).select("label", vector("index", "value").alias("features")).cache()
    fitted = LogisticRegression(maxIter=25, regParam=1e-3, standardization=False).fit(train)
    train.unpersist()
    model = QualityModel(fitted.coefficients.toArray(), fitted.intercept, 1.0, 0.0)
    if counts.get(True) == 2:
        shared = rows.sparkSession.sparkContext.broadcast(model.parts())

        def margin(index, value):
            weights, intercept = shared.value[:2]
            return DenseVector([intercept + float(np.dot(weights[np.array(index, np.int64)], value))])

        held = rows.filter("held_out").select("label", F.udf(margin, VectorUDT())("index", "value").alias("features"))
        platt = LogisticRegression(maxIter=50, regParam=1e-3, standardization=False).fit(held)
        model.slope, model.offset = float(platt.coefficients[0]), platt.intercept
    model.offset += prior_shift(known, max_rows)
    return model


SCORES = StructType(
    [
        StructField("n_words", LongType()),
        StructField("word_chars", LongType()),
        StructField("n_symbols", LongType()),
        StructField("n_dup_lines", LongType()),
        StructField("n_repeat_words", LongType()),
        StructField("probability", DoubleType()),
    ]
)


def score_text(body: bytes, hashed: WordHashes, model: QualityModel | None) -> tuple:
    words = body.split()
    hashes = hashed.of(words)
    probability = model.probability(features(body, hashes)) if model is not None and words else None
    n_symbols = sum(map(body.count, (bytes([s]) for s in SYMBOLS)))
    return len(words), n_code_points(words), n_symbols, duplicate_lines(body), repeated_words(hashes), probability


def score_quality(
    docs: DataFrame,
    model: QualityModel | None,
    text_col: str = "text",
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """``docs`` with the counted rules, ``probability`` (of good quality),
    ``base_failed`` and ``kept``."""
    long_rows(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model and model.parts())

    @F.arrow_udf(SCORES)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashed = WordHashes()
        model = shared.value and QualityModel(*shared.value)
        types = [pa.int64()] * 5 + [pa.float64()]
        for batch in batches:
            rows = [score_text(body, hashed, model) for body in batch.to_pylist()]
            columns = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], SCORES.names)

    out = unused_name(docs, "quality_scores")
    scored = docs.withColumn(out, score(utf8(quoted(text_col))))
    s = F.col(out)
    few = s["n_words"] < MIN_WORDS
    failed = few | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
    good = F.coalesce(s["probability"] >= min_probability, F.lit(True))
    return scored.withColumns(
        {f.name: s[f.name] for f in SCORES.fields} | {"base_failed": failed, "kept": ~failed & good}
    ).drop(out)

