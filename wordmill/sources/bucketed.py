"""Transcripts in buckets, joined with a video list without moving the text.

A bucketed table is a folder of Parquet files written with Spark's
``bucketBy`` and a layout file beside them. Rows of one video lie in the same
few buckets: the bucket columns are the video's keys and a slot, a number below
``slots`` that follows from the block, so a video with a large share of all
blocks still lies over several buckets. The list, which is narrow, is repeated
once per slot and is the only side that is shuffled; new files are appended to
the same buckets.

Spark reads buckets through its catalog: the folder is registered there under a
name made from its path, in any session that opens it. The folder itself holds
all that is needed (``layout``).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wordmill.plans.physical import delete_path
from wordmill.sources.files import qualified, read_bytes, write_bytes

SLOT = "slot"
SLOTS = 16
SLOT_BLOCKS = 16  # consecutive blocks of a video in the same slot
BUCKETS = 200
LAYOUT = "_layout"  # hidden from readers of the folder


@dataclass(frozen=True)
class BucketedTable:
    path: str
    schema: StructType  # without the slot
    keys: tuple[str, ...]
    buckets: int
    slots: int

    @property
    def name(self) -> str:
        return "bucketed_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]

    def _columns(self) -> list[str]:
        return [*self.keys, SLOT]

    def register(self, spark: SparkSession) -> None:
        """Make the folder known to the session's catalog."""
        if spark.catalog.tableExists(self.name):
            spark.catalog.refreshTable(self.name)
            return
        quote = lambda names: ", ".join(f"`{n}`" for n in names)
        columns = StructType([*self.schema.fields, StructField(SLOT, IntegerType())])
        typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        location = self.path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.name} ({typed}) USING parquet "
            f"CLUSTERED BY ({quote(self._columns())}) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )

    def forget(self, spark: SparkSession, delete: bool = False) -> None:
        """Drop the catalog entry, and with ``delete`` the files too."""
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if delete:
            delete_path(spark, self.path)

    def append(self, df: DataFrame, block_col: str | None = "block") -> None:
        """Add rows; the rows of a bucket come from one task, so a write adds
        one file to a bucket at most."""
        spark = df.sparkSession
        self.register(spark)
        order = F.floor(F.col(block_col) / SLOT_BLOCKS) if block_col else F.lit(0)
        rows = df.select(*(f.name for f in self.schema.fields)).withColumn(SLOT, F.pmod(order, F.lit(self.slots)).cast("int"))
        rows = rows.repartition(self.buckets, *self._columns())
        writer = rows.write.mode("append").bucketBy(self.buckets, self._columns()[0], *self._columns()[1:])
        writer.format("parquet").option("path", self.path).saveAsTable(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows, the slot included."""
        self.register(spark)
        return spark.table(self.name)

    def join(self, listed: DataFrame) -> DataFrame:
        """Rows of the listed videos with the list's other columns. The list's
        share of a bucket is hashed, the texts are neither moved nor sorted."""
        slots = F.explode(F.sequence(F.lit(0), F.lit(self.slots - 1)))
        spread = listed.withColumn(SLOT, slots).hint("shuffle_hash")
        return self.read(listed.sparkSession).join(spread, self._columns(), "inner").drop(SLOT)


def create_bucketed(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    buckets: int = BUCKETS,
    slots: int = SLOTS,
) -> BucketedTable:
    """A new table; its layout is written to the folder first."""
    found = open_bucketed(spark, path)
    if found is not None:
        raise ValueError(f"{path} holds a bucketed table already")
    table = BucketedTable(qualified(spark, path), schema, tuple(keys), buckets, slots)
    layout = {"schema": json.loads(schema.json()), "keys": list(keys), "buckets": buckets, "slots": slots}
    write_bytes(spark, f"{table.path}/{LAYOUT}", json.dumps(layout).encode())
    return table


def open_bucketed(spark: SparkSession, path: str) -> BucketedTable | None:
    """The table in a folder, or None if the folder has no layout."""
    body = read_bytes(spark, f"{path.rstrip('/')}/{LAYOUT}")
    if body is None:
        return None
    layout = json.loads(body)
    schema = StructType.fromJson(layout["schema"])
    return BucketedTable(qualified(spark, path), schema, tuple(layout["keys"]), layout["buckets"], layout["slots"])
