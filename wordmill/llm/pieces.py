"""SentencePiece encoding and decoding over a table of distinct chunks.

When no piece of the model has a white-space marker after another character,
pieces cannot cross the start of a marker run. A text then falls apart into
chunks (a run of markers and the characters up to the next run), and the ids
of a text are the ids of its chunks in a row. Each task keeps a table of the
distinct chunks it has met, segments each one once with the library, and joins
the ids back by position with array indexing. The table is bounded: beyond
``max_chunks`` entries or ``max_chunk_chars`` characters it keeps only chunks
that came up more than once.

Models for which this does not hold (pieces across markers, a normalizer that
changes text, no dummy prefix) are detected and their texts encoded whole.

Defined cases: null counts as empty; an empty text has no ids; bytes that are
not UTF-8 become U+FFFD; null ids decode to an empty text. The result column
replaces a column of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wordmill.llm.common import long_rows, quoted, unused_name, utf8

MARK = "▁"
MAX_CHUNKS = 250_000
MAX_CHUNK_CHARS = 20_000_000
# New chunks go to the library in texts of about so many characters, which
# costs much less than a call for each chunk.
JOINED_CHARS = 4_000

# What a normalizer other than the identity would change.
PROBE = " a  ﬁ ①Ａ　é\t\n b "


def read_model(path: str) -> bytes:
    """The model file, read on the driver and sent along with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def vocabulary(proto: bytes) -> int:
    """Number of ids of a model."""
    return sentencepiece.SentencePieceProcessor(model_proto=proto).get_piece_size()


def chunks_are_apart(model: sentencepiece.SentencePieceProcessor) -> bool:
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    crossing = any(MARK in p.lstrip(MARK) for p in pieces)
    known = model.piece_to_id(MARK) != model.unk_id()
    return known and not crossing and model.normalize(PROBE) == MARK + PROBE.replace(" ", MARK)


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first marker (the library puts
    that one before whatever it encodes). An empty chunk is a lone marker at
    the end of the text."""
    if not text:
        return []
    parts = text.replace(MARK, " ").split(" ")
    if "" not in parts:
        return parts
    out, blanks = [], 0
    for part in parts:
        if part:
            out.append(" " * blanks + part)
            blanks = 0
        else:
            blanks += 1
    if blanks:
        out.append(" " * (blanks - 1))
    return out


class Codes(dict):
    """Numbers of the chunks met; a chunk that is asked for the first time gets
    the next number and is noted as new."""

    def __init__(self, known: Iterable[str] = ()):
        super().__init__((chunk, i) for i, chunk in enumerate(known))
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class ChunkTable:
    def __init__(self, proto: bytes, max_chunks: int = MAX_CHUNKS, max_chars: int = MAX_CHUNK_CHARS):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.apart = chunks_are_apart(self.model)
        marked = (self.model.id_to_piece(i).startswith(MARK) for i in range(self.model.get_piece_size()))
        self.marked = np.fromiter(marked, bool, self.model.get_piece_size())
        self.max_chunks, self.max_chars = max_chunks, max_chars
        self.code = Codes()
        self.chars = 0
        self.ids = np.zeros(0, np.int32)
        self.start, self.length, self.uses = (np.zeros(0, np.int64) for _ in range(3))

    def _shrink(self) -> None:
        """Keep the chunks that came up again since the last time, half of the
        table at most."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > self.max_chunks // 2:
            keep = np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[: self.max_chunks // 2]])
        names = list(self.code)
        names = [names[i] for i in keep.tolist()]
        self.chars = sum(map(len, names))
        if self.chars > self.max_chars // 2:
            keep, names, self.chars = keep[:0], [], 0
        self.code = Codes(names)
        places, ends = self._places(keep)
        self.ids, self.length = self.ids[places], self.length[keep]
        self.start = ends - self.length
        self.uses = np.zeros(len(keep), np.int64)

    def _places(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the table the ids of some chunks are, one chunk after the
        other, and where each chunk ends in that row."""
        length = self.length[code]
        ends = np.cumsum(length)
        return np.repeat(self.start[code] - (ends - length), length) + np.arange(int(length.sum())), ends

    def _segment(self, single: list[str], other: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and number of ids of each chunk, in order, some chunks at a
        time. Of chunks with a single marker, only first pieces have a marker,
        so a text of several such chunks can be cut again."""
        for joined in joined_texts(single):
            ids = np.array(self.model.encode(joined, num_threads=1), np.int32)
            first = np.flatnonzero(self.marked[ids])
            yield ids, np.diff(first, append=len(ids))
        for c in other:
            ids = self.model.encode(c, num_threads=1) if c else [self.model.piece_to_id(MARK)]
            yield np.array(ids, np.int32), np.array([len(ids)])

    def _add(self, new: list[str]) -> None:
        spaced = [not c or c[0] == " " for c in new]
        single = [c for c, s in zip(new, spaced) if not s]
        other = [c for c, s in zip(new, spaced) if s]
        order = np.argsort(np.array(spaced), kind="stable")
        ids, counts = map(np.concatenate, zip(*self._segment(single, other)))
        length, start = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        length[order] = counts
        start[order] = len(self.ids) + np.cumsum(counts) - counts
        self.start = np.concatenate([self.start, start])
        self.length = np.concatenate([self.length, length])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.ids = np.concatenate([self.ids, ids])
        self.chars += sum(map(len, new))

    def encode(self, texts: list[str]) -> pa.ListArray:
        if not self.apart:
            return pa.array(self.model.encode(texts, num_threads=1), pa.list_(pa.int32()))
        if len(self.code) > self.max_chunks or self.chars > self.max_chars:
            self._shrink()
        split = [chunks(t) for t in texts]
        n_chunks = np.fromiter(map(len, split), np.int64, len(split))
        code = np.fromiter(map(self.code.__getitem__, chain.from_iterable(split)), np.int64, int(n_chunks.sum()))
        if self.code.new:
            new, self.code.new = self.code.new, []
            self._add(new)
        self.uses += np.bincount(code, minlength=len(self.uses))
        places, ends = self._places(code)
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_chunks)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(self.ids[places], pa.int32()))


def joined_texts(single: list[str]) -> Iterator[str]:
    """Chunks joined to texts of about ``JOINED_CHARS`` characters."""
    ends = np.cumsum(np.fromiter(map(len, single), np.int64, len(single)))
    part = np.flatnonzero(np.diff(ends // JOINED_CHARS, prepend=-1, append=-1)).tolist()
    for i, j in zip(part, part[1:]):
        yield " ".join(single[i:j])


# Texts encoded at a time inside a task; bounds the index arrays.
SLICE_BYTES = 2 << 20


def slices(bodies: list[bytes]) -> Iterator[list[bytes]]:
    """Consecutive parts of a batch of about ``SLICE_BYTES`` bytes."""
    part, size = [], 0
    for body in bodies:
        part.append(body)
        size += len(body)
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_batch(table: ChunkTable, batch: pa.Array) -> pa.ListArray:
    parts = [table.encode([b.decode("utf-8", "replace") for b in part]) for part in slices(batch.to_pylist())]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def decode_batch(model: sentencepiece.SentencePieceProcessor, batch: pa.ListArray) -> pa.Array:
    """One document's ids at a time as Python numbers."""
    flat, ends = batch.values.to_numpy(zero_copy_only=False), batch.offsets.to_numpy().tolist()
    valid = batch.is_valid().to_pylist()
    texts = [model.decode(flat[a:b].tolist()) if ok and b > a else "" for a, b, ok in zip(ends, ends[1:], valid)]
    return pa.array(texts, pa.string())


def encode_texts(docs: DataFrame, proto: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of the text as ``array<int>``, as the library's
    ``encode`` gives them (no begin or end ids)."""
    long_rows(docs)
    model = docs.sparkSession.sparkContext.broadcast(proto)

    @F.arrow_udf(ArrayType(IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = ChunkTable(model.value)
        for batch in batches:
            yield encode_batch(table, batch)

    return docs.withColumn(ids_col, encode(utf8(quoted(text_col))))


def counted_tokens(docs: DataFrame, proto: bytes, text_col: str = "text") -> Column:
    """The number of ids of the text, for use in ``docs``; the ids stay in the
    Python task."""
    long_rows(docs)
    model = docs.sparkSession.sparkContext.broadcast(proto)

    @F.arrow_udf(LongType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = ChunkTable(model.value)
        for batch in batches:
            yield encode_batch(table, batch).value_lengths().cast(pa.int64())

    return count(utf8(quoted(text_col)))


def decode_ids(docs: DataFrame, proto: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids, as the library's ``decode``."""
    long_rows(docs)
    model = docs.sparkSession.sparkContext.broadcast(proto)

    @F.arrow_udf(StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        processor = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        for batch in batches:
            yield decode_batch(processor, batch)

    return docs.withColumn(text_col, decode(quoted(ids_col)))


ROUND_TRIP = StructType([StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])


def encode_and_decode(docs: DataFrame, proto: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``: both directions in one Python
    task, which takes half the workers of the two operators in a row."""
    long_rows(docs)
    model = docs.sparkSession.sparkContext.broadcast(proto)

    @F.arrow_udf(ROUND_TRIP)
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = ChunkTable(model.value)
        for batch in batches:
            ids = encode_batch(table, batch)
            yield pa.StructArray.from_arrays([ids, decode_batch(table.model, ids)], ROUND_TRIP.names)

    out = unused_name(docs, "pieces_out")
    done = docs.withColumn(out, both(utf8(quoted(text_col))))
    return done.withColumns({name: F.col(out)[name] for name in ROUND_TRIP.names}).drop(out)
