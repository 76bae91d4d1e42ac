"""Greedy text chunking, of whole texts and of landed blocks.

A chunk is cut at the last space before the limit, and the next one starts at
that cut, so where a chunk starts depends on all text before it. Whole texts are
cut by one regular expression per row (:func:`chunk_text`). A landed transcript
is several block rows; :func:`chunk_blocks` cuts it exactly as the joined text
without ever joining it:

1. Every block gets its offset in the text by running sums of lengths, in two
   levels so that no window holds a long video.
2. The text is dealt anew into cells of ``cell_chars`` characters and the
   ``max_chars + 1`` characters that follow, which decide the last cuts.
3. In a cell the chunk that crosses into it may start at any of the first
   ``max_chars`` characters. For each of these entries the cell gives the exit
   (where the first chunk behind the cell starts) and the number of chunks.
   Later entries never leave earlier, so this is a step function of few steps.
4. Steps are composed in order, a group of cells at a time and then groups,
   which gives the true entry and first chunk number of each cell.
5. Cells are cut from their entries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wordmill.constants import DEFAULT_CHUNK_SIZE
from wordmill.functions.text import split_chunks, strip_ws
from wordmill.plans.physical import materialize

CELL_CHARS = 1 << 16
SUPER_BLOCKS = 1024  # blocks of one window
CELL_GROUP = 256  # cells composed at a time


def chunk_text(df: DataFrame, keys: Sequence[str], text_col: str = "text", max_chars: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """``keys..., chunk_no, chunk``: chunks of at most ``max_chars`` characters,
    cut at the last space before the limit (hard cut if none), stripped.
    Empty text yields no chunks. Purely per row: no shuffle."""
    return df.select(*keys, F.posexplode(split_chunks(text_col, max_chars)).alias("chunk_no", "chunk"))


def next_cuts(text: str, starts: int, max_chars: int) -> np.ndarray:
    """Where the chunk that starts at each of the first ``starts`` characters
    ends. Whatever follows the text is out of reach, or the text ends here."""
    n = len(text)
    spaces = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 32
    last = np.maximum.accumulate(np.where(spaces, np.arange(n), -1))
    start = np.arange(starts)
    limit = start + max_chars
    cut = last[np.minimum(limit, n - 1)]
    return np.where(limit >= n, n, np.where(cut > start, cut, limit))


def cell_steps(text: str, cell_chars: int, max_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The step function of a cell: first entries, exits and chunk counts."""
    end = min(cell_chars, len(text))
    cuts = next_cuts(text, end, max_chars) if end else np.zeros(0, np.int64)
    at, count = np.arange(max_chars), np.zeros(max_chars, np.int64)
    while (inside := at < end).any():
        at[inside] = cuts[at[inside]]
        count += inside
    exits = np.maximum(at - cell_chars, 0)
    first = np.flatnonzero(np.concatenate(([True], (np.diff(exits) != 0) | (np.diff(count) != 0))))
    return first, exits[first], count[first]


def follow(steps: Sequence[dict], entry: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Entry and number of chunks before each cell of a list, then behind it."""
    count = np.zeros(len(entry), np.int64)
    for step in steps:
        yield entry, count
        place = np.searchsorted(step["first"], entry, side="right") - 1
        count = count + np.asarray(step["chunks"], np.int64)[place]
        entry = np.asarray(step["exits"], np.int64)[place]
    yield entry, count


_INTS = ArrayType(IntegerType())
_STEPS = StructType([StructField("first", _INTS), StructField("exits", _INTS), StructField("chunks", ArrayType(LongType()))])
_STEPS_ARROW = pa.struct([("first", pa.list_(pa.int32())), ("exits", pa.list_(pa.int32())), ("chunks", pa.list_(pa.int64()))])
_ENTRY = StructType([StructField("cell", LongType()), StructField("entry", IntegerType()), StructField("base", LongType())])
_ENTRY_ARROW = pa.list_(pa.struct([("cell", pa.int64()), ("entry", pa.int32()), ("base", pa.int64())]))
_CHUNKS = ArrayType(StructType([StructField("chunk_no", LongType()), StructField("chunk", StringType())]))
_CHUNKS_ARROW = pa.list_(pa.struct([("chunk_no", pa.int64()), ("chunk", pa.string())]))


def _steps_of(cell_chars: int, max_chars: int):
    @F.arrow_udf(_STEPS)
    def steps(texts: pa.Array) -> pa.Array:
        rows = [cell_steps(t, cell_chars, max_chars) for t in texts.to_pylist()]
        return pa.array([dict(zip(_STEPS.names, r)) for r in rows], _STEPS_ARROW)

    return steps


@F.arrow_udf(_STEPS)
def _composed(groups: pa.Array) -> pa.Array:
    """One step function for the cells of a group: its steps begin where those
    of the first cell begin."""
    rows = []
    for cells in groups.to_pylist():
        steps = [c["steps"] for c in cells]
        *_, (exits, chunks) = follow(steps, np.asarray(steps[0]["first"], np.int64))
        rows.append({"first": steps[0]["first"], "exits": exits, "chunks": chunks})
    return pa.array(rows, _STEPS_ARROW)


@F.arrow_udf(ArrayType(_ENTRY))
def _entries(groups: pa.Array, entry: pa.Array, base: pa.Array) -> pa.Array:
    """Entry and first chunk number of each cell (or group) of a list."""
    rows = []
    for cells, e, b in zip(groups.to_pylist(), entry.to_pylist(), base.to_pylist()):
        found = follow([c["steps"] for c in cells], np.array([e]))
        rows.append([{"cell": c["cell"], "entry": int(at[0]), "base": b + int(n[0])} for c, (at, n) in zip(cells, found)])
    return pa.array(rows, _ENTRY_ARROW)


def _cut_at(cell_chars: int, max_chars: int):
    @F.arrow_udf(_CHUNKS)
    def cut(texts: pa.Array, entries: pa.Array, bases: pa.Array) -> pa.Array:
        rows = []
        for text, at, no in zip(texts.to_pylist(), entries.to_pylist(), bases.to_pylist()):
            end = min(cell_chars, len(text))
            cuts = next_cuts(text, end, max_chars) if end else ()
            chunks = []
            while at < end:
                to = int(cuts[at])
                chunks.append({"chunk_no": no + len(chunks), "chunk": text[at:to]})
                at = to
            rows.append(chunks)
        return pa.array(rows, _CHUNKS_ARROW)

    return cut


def _placed(blocks: DataFrame, text: Column) -> DataFrame:
    """``_key, _at, _piece``: each block's share of the joined text, with the
    newline in front of it, and its offset."""
    rows = blocks.withColumns({"_text": F.coalesce(text, F.lit("")), "_super": F.floor(F.col("block") / SUPER_BLOCKS)})
    wide = F.length("_text") + 1
    sums = rows.groupBy("_key", "_super").agg(F.sum(wide).alias("_wide"))
    before = Window.partitionBy("_key").orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_key", "_super", F.coalesce(F.sum("_wide").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_key", "_super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(wide).over(inside), F.lit(0)))
    at = F.col("_before") + F.col("_inside")
    rows = rows.join(sums, ["_key", "_super"]).withColumn("_first", at == 0)
    return rows.withColumn("_at", F.when(F.col("_first"), at).otherwise(at - 1)).withColumn(
        "_piece", F.when(F.col("_first"), F.col("_text")).otherwise(F.concat(F.lit("\n"), F.col("_text")))
    )


def chunk_blocks(
    blocks: DataFrame,
    keys: Sequence[str] = ("video_id",),
    text_col: str = "text",
    max_chars: int = DEFAULT_CHUNK_SIZE,
    cell_chars: int = CELL_CHARS,
) -> DataFrame:
    """``keys..., chunk_no, chunk`` of block-form transcripts (``block`` orders
    a video's rows, joined by newlines): the chunks of :func:`chunk_text` over
    the joined text. A null text is an empty block; a video of empty text has no
    chunks."""
    if max_chars < 1:
        raise ValueError("max_chars must be >= 1")
    cell_chars = max(cell_chars, max_chars + 1)
    named = blocks.select(
        F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_key"), *keys, "block", F.col(text_col).alias("_own")
    )
    rows = _placed(named, F.col("_own")).filter(F.length("_piece") > 0)
    size, at, reach = F.length("_piece"), F.col("_at"), cell_chars + max_chars + 1
    # A piece goes to every cell whose own or following characters it holds.
    low = F.greatest(F.floor((at - max_chars - 1) / cell_chars), F.lit(0))
    dealt = rows.select("_key", *keys, "_piece", "_at", F.explode(F.sequence(low, F.floor((at + size - 1) / cell_chars))).alias("_cell"))
    start = F.col("_cell") * cell_chars
    a, b = F.greatest(at, start), F.least(at + size, start + reach)
    part = F.substring(F.col("_piece"), (a - at + 1).cast("int"), (b - a).cast("int"))
    dealt = dealt.select("_key", *keys, "_cell", F.struct(a.alias("at"), part.alias("part")).alias("_part")).filter("length(_part.part) > 0")
    parts = F.transform(F.array_sort(F.collect_list("_part")), lambda p: p["part"])
    cells = dealt.groupBy("_key", *keys, "_cell").agg(F.array_join(parts, "").alias("_text"))
    # The characters that follow may be all there is of a cell beyond the last.
    cells = materialize(cells, "chunk-cells")

    def listed(df: DataFrame, *by: str) -> DataFrame:
        cell = F.struct(F.col("_cell").alias("cell"), F.col("_steps").alias("steps"))
        return df.groupBy(*by).agg(F.array_sort(F.collect_list(cell)).alias("_cells"))

    steps = cells.select("_key", "_cell", _steps_of(cell_chars, max_chars)("_text").alias("_steps"))
    steps = steps.withColumn("_group", F.floor(F.col("_cell") / CELL_GROUP))
    groups = materialize(listed(steps, "_key", "_group"), "chunk-groups")
    whole = listed(groups.select("_key", F.col("_group").alias("_cell"), _composed("_cells").alias("_steps")), "_key")
    into = whole.select("_key", F.explode(_entries("_cells", F.lit(0), F.lit(0).cast("bigint"))).alias("_e"))
    into = into.select("_key", F.col("_e.cell").alias("_group"), F.col("_e.entry").alias("_entry"), F.col("_e.base").alias("_base"))
    entries = groups.join(into, ["_key", "_group"]).select("_key", F.explode(_entries("_cells", "_entry", "_base")).alias("_e"))
    entries = entries.select("_key", F.col("_e.cell").alias("_cell"), F.col("_e.entry").alias("_entry"), F.col("_e.base").alias("_base"))
    chunks = cells.join(entries, ["_key", "_cell"]).select(
        *keys, F.explode(_cut_at(cell_chars, max_chars)("_text", "_entry", "_base")).alias("_c")
    )
    return chunks.select(*keys, F.col("_c.chunk_no").cast("int").alias("chunk_no"), strip_ws(F.col("_c.chunk")).alias("chunk"))
