"""Physical-plan helpers: size-checked broadcast, scan spreading, lineage cuts.

These are the only places where the library makes a physical decision;
everything else is left to Catalyst and AQE.
"""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from wordmill.constants import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, HOT_KEY_ROWS, HOT_KEYS_MAX, SALT_BUCKETS
from wordmill.session import checkpoint_dir


def small_table(
    spark: SparkSession,
    rows: Sequence[tuple] | Iterable[tuple],
    schema: StructType | str,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """A driver-side parameter table, marked for broadcast.

    Its size is known before the job starts; a list above ``max_rows`` is
    returned without the hint, and Catalyst picks the join.
    """
    rows = list(rows)
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= max_rows else df


# Fixed in-memory width of atomic columns; strings, binaries and nested
# values are measured per row instead.
_FIXED_WIDTH = {
    BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, FloatType: 4, DateType: 4,
    LongType: 8, DoubleType: 8, TimestampType: 8, TimestampNTZType: 8, DecimalType: 16,
}
_ROW_OVERHEAD_BYTES = 16


def row_bytes(schema: StructType) -> Column:
    """Estimated size of one row: byte length of string and binary values,
    JSON length of nested values, fixed width of the other types."""
    parts = [F.lit(_ROW_OVERHEAD_BYTES)]
    for field in schema.fields:
        c = F.col(f"`{field.name}`")
        t = field.dataType
        if isinstance(t, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(t, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(_FIXED_WIDTH.get(type(t), 16)))
    return functools.reduce(lambda a, b: a + b, parts).cast("bigint")


def broadcast_size(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """``(rows, bytes)`` of ``df``, reading at most ``max_rows + 1`` rows
    (one job, one result row to the driver)."""
    # Rows are reduced to their size before the limit gathers them.
    sizes = df.select(row_bytes(df.schema).alias("b")).limit(max_rows + 1)
    r = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def bounded_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int | None = None
) -> DataFrame:
    """Broadcast ``df`` only if it provably holds at most ``max_rows`` rows
    and at most ``max_bytes`` bytes (default ``wordmill.broadcast.maxBytes``,
    else ``BROADCAST_MAX_BYTES``).

    The check reads at most ``max_rows + 1`` rows. Above either bound the
    frame is returned unchanged and Catalyst/AQE pick a shuffle join.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int | None = None) -> bool:
    """The size check of :func:`bounded_broadcast` on its own: true when
    ``df`` holds at most ``max_rows`` rows and ``max_bytes`` estimated bytes.
    A frame derived from ``df`` with no more rows and no wider rows (a
    projection, a grouping of it) is bounded by the same check."""
    if max_bytes is None:
        max_bytes = _conf_int(df.sparkSession, "wordmill.broadcast.maxBytes", BROADCAST_MAX_BYTES)
    n, nbytes = broadcast_size(df, max_rows)
    return n <= max_rows and nbytes <= max_bytes


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Give a scan at least ``min_partitions`` partitions (default: the
    cluster's parallelism) before CPU-heavy per-row work such as regex
    tokenization.

    Large inputs already arrive in many splits and are returned untouched, so
    no shuffle is added at scale; a few big unsplittable files are
    hash-partitioned on ``keys`` (deterministic under task retry).
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - e.g. Spark Connect has no .rdd
        return df
    if current >= target:
        return df
    if keys:
        return df.repartition(target, *keys)
    return df.repartition(target)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder (``spark.checkpoint.dir``),
    one folder per application; it is deleted when the application ends."""
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_dir(spark).rstrip('/')}/wordmill/{app}/{name}-{uuid.uuid4().hex}"
    jpath, fs = _hadoop(spark, path)
    fs.deleteOnExit(jpath)
    return path


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it exists."""
    jpath, fs = _hadoop(spark, path)
    fs.delete(jpath, True)


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back.

    Used where one intermediate feeds several outputs: a lost executor then
    re-reads the written files instead of recomputing the whole chain. The
    copy lives until the application ends; :func:`materialized` drops it
    after use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name or "frame")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def materialized(df: DataFrame, name: str | None = None) -> Iterator[DataFrame]:
    """:func:`materialize` for the length of a ``with`` block; the copy is
    deleted at its end, so nothing lazy may leave the block."""
    spark = df.sparkSession
    path = scratch_path(spark, name or "frame")
    try:
        df.write.mode("overwrite").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


# Salt range for rows whose join key is null (they match nothing and are
# only spread, never replicated).
NULL_KEY_SALTS = 1 << 16


def _conf_int(spark: SparkSession, key: str, default: int) -> int:
    value = spark.conf.get(key, None)
    return int(value) if value else default


def may_have_hot_key(big: DataFrame) -> bool:
    """Whether ``big`` holds enough rows for a hot key (see :func:`salted_join`).

    One count that reads no more columns than the filters of ``big`` need.
    Below the bound a plain join does, without key counts, hot-key list and
    salt. Ask it of scans; on a join or a fold the count would repeat the work.
    """
    return big.count() >= _conf_int(big.sparkSession, "wordmill.skew.hotKeyRows", HOT_KEY_ROWS)


def salted_join(
    big: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    how: str,
    count_col: str | None,
    spread_cols: Sequence[str],
) -> DataFrame:
    """Join ``big`` to ``keyed`` (one row per key) without letting a hot key
    of ``big`` land in a single task.

    ``keyed[count_col]`` must hold the number of ``big`` rows of each key
    (ideally computed in the same aggregation that builds ``keyed``, so
    finding hot keys costs no extra pass); with ``count_col=None`` the counts
    come from one extra partial aggregation over ``big``'s keys. Keys with at least
    ``wordmill.skew.hotKeyRows`` rows are hot: their ``big`` rows are spread
    over ``wordmill.skew.saltBuckets`` buckets by a hash of ``spread_cols``
    and their ``keyed`` row is replicated once per bucket; every other key
    joins in bucket 0. The hot-key list is broadcast: it holds the
    ``HOT_KEYS_MAX`` hottest keys at most, so a key beyond it has less than
    one ``HOT_KEYS_MAX``-th of the rows and needs no salt. Rows of ``big`` with a null key
    match nothing; they are spread over ``NULL_KEY_SALTS`` salts without any
    replication. When ``keyed`` turns out small, AQE still turns the final
    join into a broadcast join at run time.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    spark = big.sparkSession
    hot_rows = _conf_int(spark, "wordmill.skew.hotKeyRows", HOT_KEY_ROWS)
    buckets = _conf_int(spark, "wordmill.skew.saltBuckets", SALT_BUCKETS)
    if count_col is None:
        counts, n = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), F.col("_n")
    else:
        counts, n = keyed, F.col(count_col)
    # Keys are unique here, so the order is total and both sides salt alike.
    hottest = counts.filter(n >= hot_rows).orderBy(n.desc(), *keys).limit(HOT_KEYS_MAX)
    hot = F.broadcast(hottest.select(*keys, F.lit(True).alias("_hot")))
    row_hash = F.xxhash64(*[F.col(c) for c in spread_cols])
    has_key = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # A null key matches nothing, so its rows need no partner copies: they get
    # a salt from a range wider than any reducer count and spread over every
    # task instead of meeting in one (same single join, no second pass).
    salt = (
        F.when(~has_key, F.pmod(row_hash, F.lit(NULL_KEY_SALTS)))
        .when(F.col("_hot"), F.pmod(row_hash, F.lit(buckets)))
        .otherwise(F.lit(0))
        .cast("int")
    )
    big_s = big.join(hot, list(keys), "left").withColumn("_salt", salt).drop("_hot")
    fan = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    keyed_s = keyed.join(hot, list(keys), "left").withColumn("_salt", F.explode(fan)).drop("_hot")
    return big_s.join(keyed_s, [*keys, "_salt"], how).drop("_salt")
