"""Packing token ids into fixed-length rows by best fit.

Every document's ids, followed by ``end_id`` if given, are one run. A run
longer than the row length is split into whole rows and a rest, without loss.
Rests are packed best-fit-decreasing: longest first, each into the open row
with the least room that still holds it, found by a segment tree over the
possible amounts of room. Rows are written as matrices of little-endian ids
with, per row, the cumulative segment lengths, the positions (which restart at
0 with each segment), and for each segment its document and the place of its
first id in the document's run, from which documents are restored exactly.

Packing works inside each task, on windows of at most ``WINDOW_IDS`` ids, so
memory does not depend on the partition size, nothing is shuffled, and a task
that is run again gives the same matrices. Only the last rows of a window have
room left.

Ids are stored in two bytes each if the vocabulary has at most 65,536 ids, else
in four. An id outside ``0 .. vocabulary - 1`` is an error, never cut.

Defined cases: null ids count as empty; a null among the ids is an error; an empty run is not stored (with
``end_id`` there is none); rows that share an id are packed separately; an
empty table gives no matrices; columns other than the id and the ids (or the
text) are not carried along, so they may have any name. Room at the end of a row holds ``pad_id`` and
belongs to no segment; its positions are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import pieces
from wordmill.llm.common import long_rows, quoted, utf8

ROW_LENGTH = 2048
ROWS_PER_MATRIX = 64
WINDOW_IDS = 4_000_000

SCHEMA = (
    "matrix bigint, n_rows int, n_ids bigint, ids binary, positions binary, cu_seqlens array<array<int>>,"
    " doc_ids array<array<bigint>>, starts array<array<bigint>>"
)


class RoomTree:
    """Open rows by their room: a segment tree over the amounts 0 to ``most``
    that tells whether any row has an amount in a range, and so finds the
    smallest amount of at least ``n`` in logarithmic time."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.open = [False] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def put(self, room: int, row: int) -> None:
        rows = self.rows.setdefault(room, [])
        rows.append(row)
        node = self.leaves + room
        while node and not self.open[node]:
            self.open[node] = True
            node >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        """Remove and return ``(room, row)`` with the least room >= n."""
        node = self.leaves + n
        if not self.open[node]:
            # Up to the first right sibling with an open row, then down left.
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.open[node] = False
            node >>= 1
            while node and not (self.open[2 * node] or self.open[2 * node + 1]):
                self.open[node] = False
                node >>= 1
        return room, row


def best_fit(lengths: list[int], row_length: int) -> list[list[int]]:
    """Rows as lists of item numbers; best-fit-decreasing, ties by number."""
    tree, rows = RoomTree(row_length), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        found = tree.take(n)
        if found is None:
            room, row = row_length, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(item)
        tree.put(room - n, row)
    return rows


Segment = tuple[int, int, np.ndarray]  # document, start, ids


def split_run(doc_id: int, run: np.ndarray, row_length: int) -> list[Segment]:
    return [(doc_id, at, run[at : at + row_length]) for at in range(0, len(run), row_length)]


def _matrix(number: int, rows: list[list[Segment]], row_length: int, pad_id: int, dtype: str) -> dict:
    ids = np.full((len(rows), row_length), pad_id, dtype)
    positions = np.zeros((len(rows), row_length), "<u4" if row_length > 1 << 16 else "<u2")
    ends = []
    for r, segments in enumerate(rows):
        at, cumulative = 0, [0]
        for _, _, run in segments:
            ids[r, at : at + len(run)] = run
            positions[r, at : at + len(run)] = np.arange(len(run))
            at += len(run)
            cumulative.append(at)
        ends.append(cumulative)
    return {
        "matrix": number,
        "n_rows": len(rows),
        "n_ids": sum(e[-1] for e in ends),
        "ids": ids.tobytes(),
        "positions": positions.tobytes(),
        "cu_seqlens": ends,
        "doc_ids": [[d for d, _, _ in row] for row in rows],
        "starts": [[s for _, s, _ in row] for row in rows],
    }


ARROW = pa.schema(
    [
        ("matrix", pa.int64()),
        ("n_rows", pa.int32()),
        ("n_ids", pa.int64()),
        ("ids", pa.binary()),
        ("positions", pa.binary()),
        ("cu_seqlens", pa.list_(pa.list_(pa.int32()))),
        ("doc_ids", pa.list_(pa.list_(pa.int64()))),
        ("starts", pa.list_(pa.list_(pa.int64()))),
    ]
)


def id_type(vocabulary: int) -> str:
    """Bytes of an id: two hold 65,536 different ones."""
    if not 0 < vocabulary <= 1 << 31:
        raise ValueError("a vocabulary has 1 to 2**31 ids")
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def checked(lists: pa.ListArray, vocabulary: int) -> tuple[np.ndarray, list[int]]:
    """All ids of a batch and where each row's begin, if they can be stored."""
    ends = lists.offsets.to_numpy().tolist()
    flat = lists.values[ends[0] : ends[-1]]
    if flat.null_count:
        raise ValueError("null among the ids")
    flat = flat.to_numpy(zero_copy_only=False)
    if len(flat) and (flat.min() < 0 or flat.max() >= vocabulary):
        stray = flat.min() if flat.min() < 0 else flat.max()
        raise ValueError(f"id {stray} is outside the vocabulary of {vocabulary} ids")
    return flat, [e - ends[0] for e in ends]


def _pack(row_length: int, rows_per_matrix: int, end_id: int | None, pad_id: int, vocabulary: int, window_ids: int):
    dtype = id_type(vocabulary)
    if not 0 <= pad_id < vocabulary or (end_id is not None and not 0 <= end_id < vocabulary):
        raise ValueError(f"the end and padding ids lie in the vocabulary of {vocabulary} ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        full: list[list[Segment]] = []  # rows that are ready
        rests: list[Segment] = []
        held = 0

        def flush(everything: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, full
            while len(full) >= rows_per_matrix or (everything and full):
                part, full = full[:rows_per_matrix], full[rows_per_matrix:]
                yield pa.RecordBatch.from_pylist([_matrix(number, part, row_length, pad_id, dtype)], ARROW)
                number += 1

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            flat, ends = checked(batch.column(1), vocabulary)
            flat = flat.astype(dtype)
            for doc_id, a, b in zip(doc_ids, ends, ends[1:]):
                ids = flat[a:b]
                if end_id is not None:
                    ids = np.append(ids, np.array(end_id, dtype))
                for segment in split_run(doc_id, ids, row_length):
                    if len(segment[2]) == row_length:
                        full.append([segment])
                    else:
                        # A copy, so that a rest does not hold its whole batch.
                        rests.append((*segment[:2], segment[2].copy()))
                        held += len(segment[2])
                if len(full) >= rows_per_matrix:
                    yield from flush(False)
                if held >= window_ids:
                    full += [[rests[i] for i in row] for row in best_fit([len(s[2]) for s in rests], row_length)]
                    rests, held = [], 0
        full += [[rests[i] for i in row] for row in best_fit([len(s[2]) for s in rests], row_length)]
        yield from flush(True)

    return run


def pack_ids(
    docs: DataFrame,
    vocabulary: int,
    id_col: str = "doc_id",
    ids_col: str = "ids",
    row_length: int = ROW_LENGTH,
    rows_per_matrix: int = ROWS_PER_MATRIX,
    end_id: int | None = None,
    pad_id: int = 0,
    window_ids: int = WINDOW_IDS,
) -> DataFrame:
    """Matrices of packed rows (see ``SCHEMA``) of the ids in a column.
    ``vocabulary`` is the number of ids of the model that gave them."""
    pack = _pack(row_length, rows_per_matrix, end_id, pad_id, vocabulary, window_ids)
    long_rows(docs)
    runs = docs.select(quoted(id_col).cast("bigint").alias("doc"), quoted(ids_col).cast("array<int>").alias("ids"))
    return runs.mapInArrow(pack, SCHEMA)


def pack_texts(
    docs: DataFrame,
    proto: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_length: int = ROW_LENGTH,
    rows_per_matrix: int = ROWS_PER_MATRIX,
    end_id: int | None = None,
    pad_id: int = 0,
    window_ids: int = WINDOW_IDS,
) -> DataFrame:
    """Matrices of the piece ids of a text column: encoded and packed in one
    task, so the ids never leave Python between the two."""
    vocabulary = pieces.vocabulary(proto)
    pack = _pack(row_length, rows_per_matrix, end_id, pad_id, vocabulary, window_ids)
    long_rows(docs)
    model = docs.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces.ChunkTable(model.value)
        encoded = (pa.RecordBatch.from_arrays([b.column(0), pieces.encode_batch(table, b.column(1))], ["doc", "ids"]) for b in batches)
        return pack(encoded)

    texts = docs.select(quoted(id_col).cast("bigint").alias("doc"), utf8(quoted(text_col)).alias("text"))
    return texts.mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the matrices as Parquet to a new folder on the shared store, by
    Spark's commit protocol; ``spark.read.parquet(path)`` gives them back."""
    packed.write.mode("errorifexists").parquet(path)


def _unpack(row_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, starts, runs = [], [], []
            for m in batch.to_pylist():
                # The width of an id follows from the size of the matrix.
                width = len(m["ids"]) // (m["n_rows"] * row_length)
                ids = np.frombuffer(m["ids"], f"<u{width}").reshape(m["n_rows"], row_length)
                for r, ends in enumerate(m["cu_seqlens"]):
                    for i, (a, b) in enumerate(zip(ends, ends[1:])):
                        docs.append(m["doc_ids"][r][i])
                        starts.append(m["starts"][r][i])
                        runs.append(ids[r, a:b].astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(docs, pa.int64()),
                    "start": pa.array(starts, pa.int64()),
                    "ids": pa.array(runs, pa.list_(pa.int32())),
                }
            )

    return run


def unpack_segments(packed: DataFrame, row_length: int = ROW_LENGTH) -> DataFrame:
    """``doc_id, start, ids`` of every segment, read back from the matrices."""
    return packed.mapInArrow(_unpack(row_length), "doc_id bigint, start bigint, ids array<int>")
