"""D9 as keyed streaming state: the retry state of each video lives in a state
store, and every micro-batch writes the rows that it changed.

The fold counts the failures after a video's last success, in order of time.
The state of a video is the time of its last success and its failures after that
one (time -> number). Entries may therefore arrive in any order and in any
batches; the result is that of folding the whole log. Each batch costs its own
entries and their videos, whatever the size of the state.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wordmill import schemas
from wordmill.sources.writers import DeltaTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# Batches of changed rows are folded into a snapshot after so many.
COMPACT_BATCHES = 50
EPOCH = "1970-01-01 00:00:00"


class AttemptProcessor(StatefulProcessor):
    """Failures after the last success of one video; times in microseconds."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.success = handle.getValueState("success", "at long")
        self.failures = handle.getMapState("failures", "at long", "n long")

    def handleInputRows(self, key, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.success.get()[0] if self.success.exists() else None
        new: dict[int, int] = {}
        newest = last
        for part in rows:
            good = part.loc[part["ok"], "at"]
            if len(good):
                newest = max(int(good.max()), newest if newest is not None else int(good.max()))
            for at, n in part.loc[~part["ok"], "at"].value_counts().items():
                new[int(at)] = new.get(int(at), 0) + int(n)
        if newest != last:
            self.success.update((newest,))
            for (at,) in [k for k in self.failures.keys()]:
                if at <= newest:
                    self.failures.removeKey((at,))
        for at, n in new.items():
            if newest is None or at > newest:
                old = self.failures.getValue((at,))
                self.failures.updateValue((at,), (n + (old[0] if old else 0),))
        held = {at: n for (at,), (n,) in self.failures.iterator()}
        yield pd.DataFrame({"video_id": [key[0]], "attempts": [sum(held.values())], "last": [max(held, default=None)]}, dtype=object)

    def close(self) -> None:
        pass


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the start of a query; the old ones come back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def attempt_changes(log: DataFrame) -> DataFrame:
    """``video_id, attempts, last_attempt`` of the videos of each micro-batch of
    ``log``; 0 attempts when a success has cleared a video."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col("at"))
    entries = log.select("video_id", micros.alias("at"), "ok")
    changed = entries.groupBy("video_id").transformWithStateInPandas(
        AttemptProcessor(), "video_id string, attempts bigint, last bigint", outputMode="Update", timeMode="None"
    )
    at = F.timestamp_add("MICROSECOND", F.col("last"), F.lit(EPOCH).cast("timestamp_ntz"))
    return changed.select("video_id", "attempts", at.alias("last_attempt"))


def start_attempt_state(
    spark: SparkSession,
    log_dir: str,
    state_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Follow the attempt log; :func:`read_attempt_state` gives the state."""
    reader = spark.readStream.schema(schemas.ATTEMPT_LOG)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    table = _table(state_path)

    def store(batch: DataFrame, batch_id: int) -> None:
        table.write(batch, batch_id)
        if batch_id and batch_id % COMPACT_BATCHES == 0:
            table.compact(batch.sparkSession)

    with settings(spark, STATE_CONF):
        changes = attempt_changes(reader.parquet(log_dir))
        writer = changes.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint_location)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()


def _table(path: str) -> DeltaTable:
    return DeltaTable(path, schemas.ATTEMPTS, "video_id")


def read_attempt_state(spark: SparkSession, state_path: str) -> DataFrame:
    """``video_id, attempts, last_attempt`` of the videos with open failures."""
    return _table(state_path).read(spark).filter("attempts > 0")
