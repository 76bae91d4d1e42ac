"""Writers (K1-K9) and the small versioned state tables.

All outputs are directory datasets written by Spark's commit protocol, so a
failed task or job leaves no partial rows visible.
"""

from __future__ import annotations

import hashlib
import json
import os
import warnings
import zlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wordmill.metrics import JobMetrics
from wordmill.operators.analytics import sorted_counts, sorted_trend
from wordmill.operators.ingest import new_rows
from wordmill.plans.physical import delete_path, materialized
from wordmill.sources.files import DataFile, data_files, read_bytes, write_bytes
from wordmill.sources.key_index import KeyIndex
from wordmill.sources.readers import empty, path_exists


def _writer(df: DataFrame, fmt: str, mode: str):
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
        w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    return w.format(fmt)


def append_new(batch: DataFrame, target: str, key: str = "video_id", fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """K1: append the rows of ``batch`` whose ``key`` is not yet in
    ``target`` (created if absent). Duplicates inside the batch are kept.
    Returns the appended rows (a lazily evaluated frame). Without new rows
    an existing target is not written.

    The target's ids are read before the write starts (file listing at plan
    time), so re-running the same batch appends nothing.
    """
    spark = batch.sparkSession
    existing = None
    if path_exists(spark, target):
        if fmt == "csv":
            # As the lists are read: by header, with multi-line fields.
            reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            existing = reader.csv(target)
        else:
            existing = spark.read.schema(schema or batch.schema).format(fmt).load(target)
    rows = new_rows(batch, existing, key)
    if existing is None or not rows.isEmpty():
        _writer(rows, fmt, "append").save(target)
    return rows


def append_indexed(batch: DataFrame, target: str, key: str = "video_id") -> list[str]:
    """K1 / D3 for large Parquet targets: append the rows of ``batch`` whose
    ``key`` is not yet in ``target``, asking the target's key index which files
    may hold one (see :class:`wordmill.sources.key_index.KeyIndex`). Without a
    known key no row of the target is read; without a new row nothing is
    written. Returns the files that were read."""
    spark, index = batch.sparkSession, KeyIndex(target, key)
    there = path_exists(spark, target)
    with materialized(batch, "append-batch") as rows:
        existing, files = index.known(rows) if there else (None, [])
        new = new_rows(rows, existing, key)
        if not there or not new.isEmpty():
            new.write.mode("append").parquet(target)
            index.update(spark)
    return files


def write_list(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """K2: overwrite a selected video list."""
    _writer(df, fmt, "overwrite").save(path)


def write_counts(freq: DataFrame, path: str, fmt: str = "csv") -> None:
    """K3: all words, count descending (ties by word)."""
    _writer(sorted_counts(freq), fmt, "overwrite").save(path)


def write_trend(trend: DataFrame, path: str, fmt: str = "csv") -> None:
    """K4: trend rows by date ascending."""
    _writer(sorted_trend(trend), fmt, "overwrite").save(path)


def write_matrix(matrix: DataFrame, path: str, fmt: str = "csv") -> None:
    """K5: the word x day matrix, word first, words ascending."""
    _writer(matrix.orderBy("word"), fmt, "overwrite").save(path)


def write_transcripts(transcripts: DataFrame, path: str, mode: str = "append") -> None:
    """K6: transcripts as Parquet partitioned by channel (the partition
    folder plays the role of the channel directory).

    Rows are rebalanced by channel first: a channel's rows meet in one task and
    make one file, small channels share a task, and a channel beyond the
    advisory partition size is split over several tasks and files."""
    rows = transcripts.hint("rebalance", "channel_id")
    rows.write.mode(mode).partitionBy("channel_id").parquet(path)


class StateTable:
    """A small state table kept as numbered versions.

    Each version is a folder ``v=<n>`` of its own, also when it has no rows.
    ``write(df, version)`` replaces exactly that folder, so a replayed
    micro-batch rewrites its own version, and then writes a manifest of the
    version's files and its row count. ``read()`` returns the highest version
    that agrees with its manifest, or an empty frame; versions that do not
    (a file is missing, cut or unreadable) are skipped, with the reason in
    ``skipped`` and a warning. The newest ``KEEP`` versions stay, older ones are
    deleted after a write.
    """

    KEEP = 5
    MANIFEST = "_manifest"

    def __init__(self, path: str, schema: StructType):
        self.path = path.rstrip("/")
        self.schema = schema
        self.skipped: dict[int, str] = {}

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={int(version)}"

    def versions(self, spark: SparkSession) -> list[int]:
        """Committed versions, ascending."""
        if not path_exists(spark, self.path):
            return []
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        found = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].lstrip("-").isdigit()]
        return sorted(v for v in found if path_exists(spark, f"{self._folder(v)}/_SUCCESS"))

    def fault(self, spark: SparkSession, version: int) -> str | None:
        """Why a version cannot be used, or None. A version from before there
        were manifests has none, and only has to be readable."""
        folder = self._folder(version)
        body = read_bytes(spark, f"{folder}/{self.MANIFEST}")
        try:
            manifest = json.loads(body) if body is not None else None
        except ValueError:
            return "its manifest is damaged"
        if manifest is not None:
            have = {os.path.basename(f.path): f.size for f in data_files(spark, folder)}
            if have != manifest["files"]:
                odd = sorted(n for n in have.keys() | manifest["files"].keys() if have.get(n) != manifest["files"].get(n))
                return f"its files are not those of the manifest: {', '.join(odd)}"
        try:
            rows = spark.read.schema(self.schema).parquet(folder).count()
        except Exception as error:  # a damaged Parquet file has many faces
            return f"it cannot be read: {str(error).splitlines()[0]}"
        if manifest is not None and rows != manifest["rows"]:
            return f"it has {rows} rows, its manifest {manifest['rows']}"
        return None

    def latest_version(self, spark: SparkSession, before: int | None = None) -> int | None:
        """Highest sound version (below ``before`` when given)."""
        for v in reversed(self.versions(spark)):
            if before is not None and v >= int(before):
                continue
            reason = self.fault(spark, v)
            if reason is None:
                return v
            self.skipped[v] = reason
            warnings.warn(f"state {self._folder(v)} is skipped: {reason}", stacklevel=3)
        return None

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The latest version, or with ``before`` the latest version older
        than ``before``. A micro-batch reads ``before=batch_id``: a replay of
        the batch then starts from the same state as its first attempt, even
        if that attempt already wrote its own version."""
        v = self.latest_version(spark, before)
        if v is None:
            return empty(spark, self.schema)
        return spark.read.schema(self.schema).parquet(self._folder(v))

    def write(self, df: DataFrame, version: int) -> None:
        spark, folder = df.sparkSession, self._folder(version)
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        metrics = JobMetrics()
        metrics.count(out, "rows").write.mode("overwrite").parquet(folder)
        files = {os.path.basename(f.path): f.size for f in data_files(spark, folder)}
        body = {"files": files, "rows": metrics.values()["rows"]}
        write_bytes(spark, f"{folder}/{self.MANIFEST}", json.dumps(body).encode())
        for old in self.versions(spark)[: -self.KEEP]:
            delete_path(spark, self._folder(old))


class DeltaTable:
    """State as changed rows per batch: ``write(df, batch)`` stores the rows
    that a batch changed and nothing else; the state is the last row of each
    key. :meth:`compact` folds the batches so far into one snapshot."""

    def __init__(self, path: str, schema: StructType, key: str):
        self.path, self.schema, self.key = path.rstrip("/"), schema, key

    def _list(self, spark: SparkSession, kind: str) -> list[int]:
        found = StateTable(f"{self.path}/{kind}", self.schema)
        return found.versions(spark)

    def write(self, df: DataFrame, batch: int) -> None:
        """A replayed batch replaces its own rows."""
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        out.write.mode("overwrite").parquet(f"{self.path}/deltas/v={int(batch)}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The last row of each key; map-side folding, one row a key moves."""
        snapshot = max(self._list(spark, "snapshots"), default=None)
        deltas = [v for v in self._list(spark, "deltas") if snapshot is None or v > snapshot]
        parts = [f"{self.path}/deltas/v={v}" for v in deltas]
        if snapshot is not None:
            parts.append(f"{self.path}/snapshots/v={snapshot}")
        if not parts:
            return empty(spark, self.schema)
        columns = [f.name for f in self.schema.fields]
        version = F.regexp_extract("_metadata.file_path", r"/v=(\d+)/", 1).cast("bigint")
        rows = spark.read.schema(self.schema).parquet(*parts).select(*columns, version.alias("_v"))
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*columns), "_v").alias("_row"))
        return last.select("_row.*")

    def compact(self, spark: SparkSession, keep: Column | None = None) -> None:
        """One snapshot of the state (only rows that meet ``keep``), then the
        older batches are deleted. A crash in between loses nothing: batches up
        to the snapshot are not read again."""
        deltas = self._list(spark, "deltas")
        if not deltas:
            return
        state = self.read(spark) if keep is None else self.read(spark).filter(keep)
        older = self._list(spark, "snapshots")
        state.write.mode("overwrite").parquet(f"{self.path}/snapshots/v={deltas[-1]}")
        for v in older:
            if v != deltas[-1]:
                delete_path(spark, f"{self.path}/snapshots/v={v}")
        for v in deltas:
            delete_path(spark, f"{self.path}/deltas/v={v}")


def append_log(entries: DataFrame, path: str) -> None:
    """Append attempt entries to the attempt log."""
    entries.write.mode("append").parquet(path)


def fingerprint(spark: SparkSession, paths: Iterable[str], params: dict | None = None) -> str:
    """Q3: a key that changes when any input file or parameter changes.

    File names, sizes and modification times are hashed by a Spark job over
    file metadata only (the ``binaryFile`` scan prunes the content column).
    """
    parts = []
    for p in sorted(paths):
        if path_exists(spark, p):
            meta = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p)
            row = meta.agg(
                F.count(F.lit(1)).alias("n"),
                F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("h"),
            ).first()
            parts.append(f"{p}:{row['n']}:{row['h']}")
        else:
            parts.append(f"{p}:missing")
    parts.append(json.dumps(params or {}, sort_keys=True, default=str))
    return hashlib.sha256("|".join(parts).encode()).hexdigest()[:24]


class PartialCounts:
    """S9 + K9: counts of a growing folder, kept as mergeable partial counts.

    Every run counts only the files that no earlier run has counted and stores
    their counts as one *generation* with the list of its files (path, size and
    modification time). The result is the sum over the generations. A file that
    changed or went voids its generation: the files of it that are still there
    are counted anew. Beyond ``MERGE`` generations the counts are merged.

    A generation counts from the moment its list is written, which is last; lists
    of void generations are deleted first. So a crash at any point costs work,
    never a wrong sum.
    """

    MERGE = 16

    def __init__(self, cache_dir: str, key: str, schema: StructType):
        self.path, self.schema = f"{cache_dir.rstrip('/')}/{key}", schema
        self.counted: list[str] = []  # files that the last call has read

    def _list(self, generation: int) -> str:
        return f"{self.path}/files-{generation:08d}"

    def _generations(self, spark: SparkSession) -> dict[int, set[DataFile]]:
        out = {}
        for f in data_files(spark, self.path):
            name = os.path.basename(f.path)
            if name.startswith("files-"):
                body = read_bytes(spark, f.path)
                out[int(name[6:])] = {DataFile(*x) for x in json.loads(zlib.decompress(body))}
        return out

    def _store(self, counts: DataFrame, files: Iterable[DataFile], generation: int, void: Iterable[int] = ()) -> None:
        spark = counts.sparkSession
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/v={generation}")
        for old in void:
            delete_path(spark, self._list(old))
        listed = json.dumps([[f.path, f.size, f.modified] for f in sorted(files, key=lambda f: f.path)])
        write_bytes(spark, self._list(generation), zlib.compress(listed.encode()))

    def update(self, spark: SparkSession, root: str, count: Callable[[list[str]], DataFrame]) -> DataFrame:
        """The counts of all data files under ``root``. ``count`` gives the
        counts of the files it is called with; all its columns but the last,
        the number, are the key."""
        there = set(data_files(spark, root))
        known = self._generations(spark)
        for generation in [g for g, files in known.items() if not files <= there]:
            delete_path(spark, self._list(generation))
            del known[generation]
        fresh = there.difference(*known.values())
        self.counted = sorted(f.path for f in fresh)
        last = max(known, default=-1)
        if fresh:
            last += 1
            self._store(count(self.counted), fresh, last)
            known[last] = fresh
        if len(known) > self.MERGE:
            last += 1
            self._store(self._sum(spark, known), set().union(*known.values()), last, void=known)
            for old in known:
                delete_path(spark, f"{self.path}/counts/v={old}")
            known = {last: there}
        return self._sum(spark, known)

    def _sum(self, spark: SparkSession, generations: Iterable[int]) -> DataFrame:
        paths = [f"{self.path}/counts/v={g}" for g in generations]
        if not paths:
            return empty(spark, self.schema)
        *keys, number = self.schema.names
        parts = spark.read.schema(self.schema).parquet(*paths)
        return parts.groupBy(*keys).agg(F.sum(number).cast("bigint").alias(number))


def cached(spark: SparkSession, cache_dir: str, key: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Reuse a result written under ``cache_dir/key``; otherwise compute, write
    (unsorted Parquet, strings stay strings) and read back."""
    path = f"{cache_dir.rstrip('/')}/{key}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return spark.read.parquet(path)
    compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
