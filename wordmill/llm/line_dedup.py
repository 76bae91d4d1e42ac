"""Line deduplication with two Bloom filters.

A line's key is the line without white space (U+0020, U+0009-U+000D) at both
ends and with A-Z lower-cased. Keys of at least ``min_chars`` code points
found in at least ``min_docs`` documents lose all their lines except in the
largest document id that holds them.

1. Every task adds the hashes of its documents' keys to two Bloom filters,
   *once* and *twice*: a hash that *once* holds already goes to *twice*. A
   task hands on the segments of its filters that have bits. Segments are
   joined by bits (``once | once'``; ``twice | twice' | once & once'``), so a
   key that two tasks met is in *twice* as well: no repeat is missed.
2. The *twice* filter goes to the tasks. Its size is bounded
   (``max_filter_bytes``); a larger corpus fills it more, which sends more
   lines to step 3 but changes no result.
3. Only lines whose hash is in *twice* are shuffled, as full keys. Counting
   the documents of each key confirms or rejects the suspicion exactly, and
   the largest id keeps the key. From there on a key is its 128-bit digest:
   documents are told which digests they lose, not which lines.

Defined cases: null text is one empty line, as is empty text; rows with a
null id keep all lines and do not count as holders; rows that share an id are
one document (same lines dropped in each); an empty table gives an empty
result. The columns ``n_lines`` and ``n_dropped`` replace columns of the same
name; all others pass unchanged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from wordmill.llm.common import SPACE_BYTES, long_rows, quoted, unused_name, utf8
from wordmill.plans.physical import bounded_broadcast, materialize

MIN_CHARS = 20
MIN_DOCS = 3
BITS_PER_LINE = 16
N_HASHES = 3
MAX_FILTER_BYTES = 64 << 20
MIN_FILTER_BYTES = 1 << 13
SEGMENT_BYTES = 1 << 13

FRAGMENT = "segment int, once binary, twice binary"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE_BYTES).lower()


def is_long(key: bytes, min_chars: int) -> bool:
    if len(key) < min_chars:
        return False
    return key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars


def long_keys(text: bytes, min_chars: int) -> set[bytes]:
    """The distinct keys of a text that are long enough."""
    return {k for k in map(line_key, text.split(b"\n")) if is_long(k, min_chars)}


class BloomPair:
    """The filters *once* and *twice* over the same ``n_bytes`` bytes."""

    def __init__(self, n_bytes: int):
        self.once = np.zeros(n_bytes, np.uint8)
        self.twice = np.zeros(n_bytes, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        hashes, counts = np.unique(hashes, return_counts=True)
        byte, bit = bit_places(hashes, len(self.once))
        again = (counts > 1) | holds(self.once, byte, bit)
        np.bitwise_or.at(self.twice, byte[:, again].ravel(), bit[:, again].ravel())
        np.bitwise_or.at(self.once, byte.ravel(), bit.ravel())


def bit_places(hashes: np.ndarray, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte index and bit mask of each of the ``N_HASHES`` bits of every hash
    (double hashing; ``n_bytes`` is a power of two)."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    place = np.stack([low + np.uint64(i) * high for i in range(N_HASHES)]) & np.uint64(n_bytes * 8 - 1)
    return (place >> np.uint64(3)).astype(np.int64), np.left_shift(1, place & np.uint64(7)).astype(np.uint8)


def holds(bits: np.ndarray, byte: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return ((bits[byte] & bit) != 0).all(axis=0)


def hash_keys(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def filter_bytes(n_lines: int, max_bytes: int = MAX_FILTER_BYTES) -> int:
    """A power of two with about ``BITS_PER_LINE`` bits a line, within bounds."""
    wanted = max(MIN_FILTER_BYTES, n_lines * BITS_PER_LINE // 8)
    return min(1 << (wanted - 1).bit_length(), 1 << (max_bytes.bit_length() - 1))


def _fragments(n_bytes: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = BloomPair(n_bytes)
        for batch in batches:
            pair.add(hash_keys([k for text in batch.column(0).to_pylist() for k in long_keys(text, min_chars)]))
        for start in range(0, n_bytes, SEGMENT_BYTES):
            once = pair.once[start : start + SEGMENT_BYTES]
            if once.any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array([start // SEGMENT_BYTES], pa.int32()),
                        "once": [zlib.compress(once.tobytes(), 1)],
                        "twice": [zlib.compress(pair.twice[start : start + SEGMENT_BYTES].tobytes(), 1)],
                    }
                )

    return run


def _join_fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by segment; one segment is held at a time."""

    def bits(blob: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(blob), np.uint8)

    def done(segment, once, twice):
        return pa.RecordBatch.from_pydict(
            {
                "segment": pa.array([segment], pa.int32()),
                "once": [zlib.compress(once.tobytes(), 1)],
                "twice": [zlib.compress(twice.tobytes(), 1)],
            }
        )

    current, once, twice = None, None, None
    for batch in batches:
        for segment, o, t in zip(*(c.to_pylist() for c in batch.columns)):
            if segment != current:
                if current is not None:
                    yield done(current, once, twice)
                current, once, twice = segment, bits(o), bits(t)
            else:
                o = bits(o)
                once, twice = once | o, twice | bits(t) | (once & o)
    if current is not None:
        yield done(current, once, twice)


def twice_filter(texts: DataFrame, min_chars: int, max_bytes: int) -> np.ndarray:
    """The *twice* filter over all texts (one ``binary`` column); at most
    ``max_bytes`` bytes."""
    newlines = F.char_length(texts[0]) - F.char_length(F.replace(texts[0], F.lit("\n"), F.lit("")))
    n_lines = texts.select((newlines + 1).alias("n")).agg(F.sum("n")).first()[0] or 0
    n_bytes = filter_bytes(n_lines, max_bytes)
    fragments = texts.select(texts[0].cast("binary").alias("text")).mapInArrow(_fragments(n_bytes, min_chars), FRAGMENT)
    joined = fragments.repartition("segment").sortWithinPartitions("segment").mapInArrow(_join_fragments, FRAGMENT)
    out = np.zeros(n_bytes, np.uint8)
    for row in joined.select("segment", "twice").collect():  # n_bytes in all, whatever the corpus
        start = row["segment"] * SEGMENT_BYTES
        out[start : start + SEGMENT_BYTES] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return out


def _suspects(twice: Broadcast, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []  # distinct keys of each document
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = long_keys(text, min_chars)
                keys += found
                ids += [doc_id] * len(found)
            known = holds(twice.value, *bit_places(hash_keys(keys), len(twice.value))) if keys else []
            lines = [k for k, y in zip(keys, known) if y]
            yield pa.RecordBatch.from_pydict(
                {
                    "holder": pa.array([i for i, y in zip(ids, known) if y], batch.column(0).type),
                    "digest": pa.array(map(xxhash.xxh3_128_digest, lines), pa.binary()),
                    "line": pa.array(lines, pa.binary()),
                }
            )

    return run


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``(holder, digest)``: the digests of the keys that document ``holder`` loses."""
    long_rows(docs)
    spark = docs.sparkSession
    known = docs.filter(quoted(id_col).isNotNull())
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    twice = spark.sparkContext.broadcast(twice_filter(known.select(text.alias("text")), min_chars, max_filter_bytes))
    id_type = docs.schema[id_col].dataType.simpleString()
    suspects = known.select(quoted(id_col).alias("holder"), text.cast("binary").alias("text")).mapInArrow(
        _suspects(twice, min_chars), f"holder {id_type}, digest binary, line binary"
    )
    # Written once: read for the count and for the join. Read back, both join
    # sides are plain shuffles, so AQE can split a line that a third of all
    # documents hold.
    suspects = materialize(suspects, "line-suspects")
    confirmed = (
        suspects.groupBy("digest", "line")
        .agg(F.count_distinct("holder").alias("n"), F.max("holder").alias("keeper"))
        .filter(F.col("n") >= min_docs)
        .select("digest", "keeper")
    )
    confirmed = materialize(confirmed, "line-repeats")
    held = suspects.select("holder", "digest").join(confirmed, "digest")
    return held.filter(F.col("holder") < F.col("keeper")).select("holder", "digest")


KEPT = StructType(
    [StructField("text", BinaryType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
)


@F.arrow_udf(KEPT)
def _without(text: pa.Array, lost: pa.Array) -> pa.Array:
    texts, n_lines, n_dropped = [], [], []
    for body, drop in zip(text.to_pylist(), lost.to_pylist()):
        lines = body.split(b"\n")
        kept = lines
        if drop:
            drop = set(drop)
            kept = [line for line in lines if xxhash.xxh3_128_digest(line_key(line)) not in drop]
        texts.append(body if kept is lines else b"\n".join(kept))
        n_lines.append(len(lines))
        n_dropped.append(len(lines) - len(kept))
    return pa.StructArray.from_arrays(
        [pa.array(texts, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
        ["text", "n_lines", "n_dropped"],
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``docs`` with the kept lines as text, ``n_lines`` (before) and
    ``n_dropped``.

    The digests to drop are collected per document (no more than the document
    has lines) and written; if they are small enough they are broadcast and the
    texts are not shuffled, else both sides are joined by document id.
    """
    lost = repeated_lines(docs, id_col, text_col, min_chars, min_docs, max_filter_bytes)
    lost = materialize(lost.groupBy("holder").agg(F.collect_set("digest").alias("lost")), "line-drops")
    lost_col, out = unused_name(docs, "lost_lines"), unused_name(docs, "kept_lines")
    holder = unused_name(docs, "lost_holder")
    lost = bounded_broadcast(lost.select(F.col("holder").alias(holder), F.col("lost").alias(lost_col)))
    joined = docs.join(lost, quoted(id_col) == F.col(holder), "left")
    done = joined.withColumn(out, _without(utf8(quoted(text_col)), F.col(lost_col)))
    return done.withColumns(
        {
            text_col: F.col(f"{out}.text").cast("string"),
            "n_lines": F.col(f"{out}.n_lines"),
            "n_dropped": F.col(f"{out}.n_dropped"),
        }
    ).drop(out, lost_col, holder)
