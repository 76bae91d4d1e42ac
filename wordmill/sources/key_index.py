"""A Bloom filter per data file and key range, so that an append looks only into
the files that may hold its keys (D3).

The index lies beside the target's files, in a folder that readers of the target
skip. Keys fall into ``SEGMENTS`` ranges of their hash; a row of the index has
the filter of one file's keys of one range. The keys of a batch meet the filters
of their own range (an equi-join on the range), each filter is asked for all
keys of the range at once, and the files with any hit are read. Filters have no
false negatives, so no known key is missed; a file that the index does not know
is always read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType

from wordmill.plans.physical import fits_broadcast
from wordmill.sources.files import data_files
from wordmill.sources.readers import path_exists

FOLDER = "_keys"
SEGMENTS = 64
# Bits of a filter per key and hashes of a key: one strange key in a million
# hits, since a file is read if any key of a batch does.
BITS = 32
HASHES = 12
LEAST_BITS = 1024
SCHEMA = "file string, segment int, n bigint, bits binary"
# Beyond so many keys nearly every file has one of them: all are read.
BATCH_KEYS = 1_000_000


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """Bits of each hash in a filter of ``size`` bits, by two halves. The hashes
    of a segment are equal in their low bits, so they are mixed first."""
    hashes = hashes * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    step = (hashes >> np.uint64(33)) | np.uint64(1)
    return (hashes[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(size)


def bloom(hashes: np.ndarray) -> bytes:
    size = max(LEAST_BITS, BITS * len(hashes))
    bits = np.zeros(size, bool)
    bits[_places(hashes, size).ravel()] = True
    return np.packbits(bits).tobytes()


def any_in(body: bytes, hashes: np.ndarray) -> bool:
    bits = np.unpackbits(np.frombuffer(body, np.uint8)).view(bool)
    return bool(bits[_places(hashes, len(bits))].all(axis=1).any())


def _unsigned(values: pa.Scalar) -> np.ndarray:
    return values.values.to_numpy(zero_copy_only=False).view(np.uint64)


@F.arrow_udf(BinaryType())
def _filters(lists: pa.Array) -> pa.Array:
    return pa.array([bloom(_unsigned(x)) for x in lists], pa.binary())


@F.arrow_udf(BooleanType())
def _hit(bits: pa.Array, keys: pa.Array) -> pa.Array:
    return pa.array([any_in(b.as_py(), _unsigned(k)) for b, k in zip(bits, keys)], pa.bool_())


class KeyIndex:
    def __init__(self, target: str, key: str = "video_id"):
        self.target, self.key = target.rstrip("/"), key
        self.path = f"{self.target}/{FOLDER}"

    def _hashed(self, df: DataFrame, *columns) -> DataFrame:
        rows = df.filter(F.col(self.key).isNotNull())
        rows = rows.select(*columns, F.xxhash64(F.col(self.key).cast("string")).alias("hash"))
        return rows.withColumn("segment", F.pmod("hash", F.lit(SEGMENTS)).cast("int"))

    def _rows(self, spark: SparkSession) -> DataFrame | None:
        return spark.read.schema(SCHEMA).parquet(self.path) if path_exists(spark, self.path) else None

    def _unknown(self, spark: SparkSession) -> list[str]:
        """The target's files that the index has no row of."""
        files = [f.path for f in data_files(spark, self.target)]
        rows = self._rows(spark)
        if rows is None or not files:
            return files
        names = spark.createDataFrame([(f, f.rsplit("/", 1)[-1]) for f in files], "path string, file string")
        return [r["path"] for r in names.join(rows.select("file"), "file", "left_anti").collect()]

    def update(self, spark: SparkSession) -> None:
        """Index the files that are new since the last call. Spark gives every
        file a name of its own, so names identify files. A file without keys
        has one row without bits."""
        files = self._unknown(spark)
        if not files:
            return
        rows = spark.read.parquet(*files)
        file = F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")
        keys = self._hashed(rows, file).groupBy("file", "segment").agg(F.collect_set("hash").alias("hashes"))
        filters = keys.select("file", "segment", F.size("hashes").cast("bigint").alias("n"), _filters("hashes").alias("bits"))
        seen = spark.createDataFrame([(f.rsplit("/", 1)[-1],) for f in files], "file string")
        seen = seen.select("file", F.lit(-1).alias("segment"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("binary").alias("bits"))
        filters.unionByName(seen).write.mode("append").parquet(self.path)

    def files_for(self, batch: DataFrame) -> list[str]:
        """Files of the target that may hold a key of ``batch``."""
        spark = batch.sparkSession
        files = {f.path.rsplit("/", 1)[-1]: f.path for f in data_files(spark, self.target)}
        if not files:
            return []
        rows = self._rows(spark)
        keys = self._hashed(batch).distinct()
        if rows is None or not fits_broadcast(keys, BATCH_KEYS, 1 << 62):
            return sorted(files.values())
        asked = keys.groupBy("segment").agg(F.collect_list("hash").alias("keys"))
        hits = rows.join(asked, "segment").filter(_hit("bits", "keys")).select("file").distinct()
        found = {r["file"] for r in hits.collect()} & files.keys()
        return sorted({*(files[f] for f in found), *self._unknown(spark)})

    def known(self, batch: DataFrame) -> tuple[DataFrame | None, list[str]]:
        """The key column of the files that may hold a key of ``batch`` (None
        if there are none), and these files."""
        files = self.files_for(batch)
        if not files:
            return None, []
        return batch.sparkSession.read.parquet(*files).select(self.key), files
