"""Small files and folder listings on any store that Spark can reach."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, without a slash at the end."""
    jpath, fs = _store(spark, path.rstrip("/"))
    return fs.makeQualified(jpath).toString()


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """A small file's content, or None if there is none."""
    jpath, fs = _store(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, body: bytes) -> None:
    """Write or replace a small file."""
    jpath, fs = _store(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(body))
    finally:
        stream.close()


@dataclass(frozen=True)
class DataFile:
    path: str
    size: int
    modified: int


def data_files(spark: SparkSession, root: str) -> list[DataFile]:
    """The data files under a folder, by path: names and folders that begin
    with ``_`` or ``.`` are none. Empty if there is no such folder."""
    jpath, fs = _store(spark, root.rstrip("/"))
    if not fs.exists(jpath):
        return []
    base = fs.makeQualified(jpath).toString()
    found, listing = [], fs.listFiles(jpath, True)
    while listing.hasNext():
        status = listing.next()
        path = status.getPath().toString()
        if not any(part[:1] in ("_", ".") for part in path[len(base) :].split("/") if part):
            found.append(DataFile(path, status.getLen(), status.getModificationTime()))
    return sorted(found, key=lambda f: f.path)
