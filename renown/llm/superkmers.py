"""Super-k-mers of texts: runs of consecutive windows that share a minimiser.

The minimiser of a window is the smallest hash among the short stretches inside it. Equal
windows have equal minimisers, so a whole run can travel as one string to the bucket of its
minimiser and every pair of equal windows meets there, while neighbouring windows share the
bytes they overlap in. Windows of words and of bytes are both cut here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.hashing import Buffer
from renown.llm.memory import tidy
from renown.session import stage

_PIECE_BYTES = 1 << 20
_PLACES = 1 << 20


def pack(docs: DataFrame, key: str, text: str, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Write the texts as rows (chunk, blob), about ``chunk_bytes`` of text each, compressed.

    A chunk is what a task sees of the corpus at a time: repeats inside it are merged
    before anything is shuffled, and results come back to it by its number. The
    written table fixes the numbers. A longer text makes a longer chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                held.append(part)
                size += part.nbytes if part.num_rows < batch.num_rows else batch.nbytes
                if size >= chunk_bytes:
                    yield _row(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield _row(number, held)

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return stage(rows.mapInArrow(tidy(run), "chunk long, blob binary"), "chunks")


def _row(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([to_blob(pa.Table.from_batches(held))], pa.binary())], ["chunk", "blob"])


def to_blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def from_blob(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


LAST = np.iinfo(np.int64).max


def opened(blob: bytes) -> tuple[np.ndarray, pa.Array, list[bytes]]:
    """Keys as numbers (a null key sorts last), keys as they are, and texts of a chunk."""
    table = from_blob(blob)
    keys = table.column("key").combine_chunks()
    texts = table.column("text").cast(pa.binary()).combine_chunks().to_pylist()
    return keys.fill_null(LAST).to_numpy(zero_copy_only=False), keys, texts


def pieces(texts: list[bytes], size: int = _PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Groups of texts of about ``size`` bytes with the number of their first text."""
    first, total = 0, 0
    for k, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield first, texts[first : k + 1]
            first, total = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of values[i : i + width] for every i where all of them exist."""
    if len(values) < width:
        return values[:0]
    span, low = 1, values
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return low if span == width else np.minimum(low[: len(values) - width + 1], low[width - span :])


@dataclass
class Runs:
    """Super-k-mers of some texts; ``first`` and ``windows`` count in the unit of the windows."""

    buffer: Buffer
    text: np.ndarray  # number of the text
    first: np.ndarray  # first window
    windows: np.ndarray  # number of windows
    start: np.ndarray  # bytes start..end hold all its windows
    end: np.ndarray
    minimiser: np.ndarray
    lead: np.ndarray | None = None  # from the first window to the place of the minimiser

    def hashes(self) -> np.ndarray:
        return self.buffer.hashes(self.start, self.end)


def plain_words(texts: list[bytes]) -> tuple[Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with single spaces between words, and start, end and text of the words.

    Every word is followed by one separator byte, the last of a text by its newline.
    """
    rough = Buffer(texts)
    start, end, text = rough.words()
    keep = np.zeros(len(rough.raw) + 1, np.int8)
    np.add.at(keep, start, 1)
    np.add.at(keep, end + 1, -1)
    mask = np.cumsum(keep[:-1]).astype(bool)
    shift = np.cumsum(mask) - mask
    raw = rough.raw.copy()
    raw[end] = 32
    plain = Buffer.__new__(Buffer)
    plain.raw = raw[mask]
    plain.bytes = plain.raw.tobytes()
    return plain, shift[start], shift[start] + (end - start), text


def word_runs(texts: list[bytes], k: int, m: int) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of k words, minimisers of m words; also start, end and text of all words."""
    buffer, start, end, text = plain_words(texts)
    n = len(start) - k + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return Runs(buffer, none, none, none, none, none, np.empty(0, np.uint64)), start, end, text
    short = buffer.hashes(start[: len(start) - m + 1], end[m - 1 :])
    lowest = sliding_min(short, k - m + 1)
    inside = np.flatnonzero(text[:n] == text[k - 1 :])
    fresh = np.ones(len(inside), bool)
    fresh[1:] = (np.diff(inside) != 1) | (lowest[inside[1:]] != lowest[inside[:-1]]) | (text[inside[1:]] != text[inside[:-1]])
    head = np.flatnonzero(fresh)
    count = np.diff(np.append(head, len(inside)))
    first = inside[head]
    return Runs(buffer, text[first], first, count, start[first], end[first + count - 1 + k - 1], lowest[first]), start, end, text


def byte_runs(texts: list[bytes], k: int, m: int) -> Runs:
    """Runs of windows of k bytes whose minimiser of m bytes lies at one place.

    The place is part of the order (the leftmost of equal hashes counts), so no run holds the
    same window twice and a run has at most k - m + 1 windows.
    """
    buffer = Buffer(texts)
    n = len(buffer.raw) - k + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return Runs(buffer, none, none, none, none, none, np.empty(0, np.uint64))
    at = np.arange(len(buffer.raw) - m + 1)
    places = np.uint64(_PLACES - 1)
    place = at.astype(np.uint64) & places
    short = buffer.rolling(at, at + m) & ~places
    lowest = sliding_min(short | place, k - m + 1)
    # in windows that hold the turn of the places, they are counted from half a turn before
    half = np.uint64(_PLACES // 2)
    for turn in range(_PLACES, len(at), _PLACES):
        near = slice(turn - (k - m), turn + k - m)
        late = sliding_min(short[near] | ((place[near] + half) & places), k - m + 1)
        lowest[near.start : near.start + len(late)] = (late & ~places) | ((late - half) & places)
    room = np.maximum(buffer.ends - buffer.starts - k + 1, 0)
    edge = np.zeros(len(buffer.raw) + 1, np.int8)
    has = room > 0
    np.add.at(edge, buffer.starts[has], 1)
    np.add.at(edge, buffer.starts[has] + room[has], -1)
    inside = np.flatnonzero(np.cumsum(edge[:n]))
    fresh = np.ones(len(inside), bool)
    fresh[1:] = (np.diff(inside) != 1) | (lowest[inside[1:]] != lowest[inside[:-1]])
    head = np.flatnonzero(fresh)
    count = np.diff(np.append(head, len(inside)))
    first = inside[head]
    text = np.searchsorted(buffer.starts, first, side="right") - 1
    lead = ((lowest[first] - first.astype(np.uint64)) & places).astype(np.int64)
    return Runs(buffer, text, first, count, first, first + count - 1 + k, lowest[first] >> np.uint64(20), lead)


def gather(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.BinaryArray:
    """The byte ranges as one binary column, without a loop over them."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw[index])])
