"""Line deduplication with two Bloom filters.

The hash space is cut into slices. Every chunk of the corpus sends the fingerprints of its
distinct lines to their slices, where one filter remembers what was seen once and a second what
was seen again. Only lines that the second filter knows are suspected; they alone are
shuffled with their bytes, compared exactly and left in the smallest document that holds them.
A false alarm of a filter costs a comparison and never a line.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.hashing import SPACE, Buffer, byte_hashes, mix
from renown.llm.superkmers import from_blob, gather, opened, pack, to_blob
from renown.session import stage

# of one slice: places of each filter, and probes of a fingerprint
PLACES, PROBES = 1 << 23, 4
# a line of ten characters fills eleven bytes, so a slice of so many chunks loads a filter to less than one half
CHUNKS_A_SLICE = 4

_SALTS = mix(np.arange(1, PROBES + 1, dtype=np.uint64))


@dataclass
class Lines:
    """The lines of the texts of a chunk, and their distinct keys."""

    doc: np.ndarray  # document key of each text
    raw_keys: pa.Array
    buffer: Buffer
    start: np.ndarray  # bytes start..end of every line, without its newline
    end: np.ndarray
    text: np.ndarray  # number of the text
    key: np.ndarray  # number of the key, -1 for a line that always stays
    keys: pa.Array
    low: np.ndarray  # smallest and largest document of each key in the chunk
    high: np.ndarray

    def names(self) -> np.ndarray:
        offsets = np.frombuffer(self.keys.buffers()[1], np.int32)[self.keys.offset : self.keys.offset + len(self.keys) + 1].astype(np.int64)
        data = np.frombuffer(self.keys.buffers()[2] or b"", np.uint8)
        return byte_hashes(data, offsets[:-1], offsets[1:])


def chunk_lines(blob: bytes, least: int) -> Lines:
    """Cut a chunk at newlines; keys are stripped and lowered, equal ones get one number."""
    doc, raw_keys, texts = opened(blob)
    buffer = Buffer(texts, lower=True)
    raw = buffer.raw
    end = np.flatnonzero(raw == 10)
    start = np.concatenate([[0], end[:-1] + 1])
    text = np.searchsorted(buffer.ends, end)
    solid = np.flatnonzero(~SPACE[raw])
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    filled = np.flatnonzero(b > a)
    left, right = solid[a[filled]], solid[b[filled] - 1] + 1
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    enough = points[right] - points[left] >= least
    filled, left, right = filled[enough], left[enough], right[enough]
    coded = gather(raw, left, right).dictionary_encode()
    key = np.full(len(end), -1, np.int64)
    key[filled] = coded.indices.to_numpy()
    order = np.argsort(key[filled], kind="stable")
    heads = np.searchsorted(key[filled][order], np.arange(len(coded.dictionary)))
    holder = doc[text[filled][order]]
    low, high = (f.reduceat(holder, heads) if len(heads) else holder for f in (np.minimum, np.maximum))
    return Lines(doc, raw_keys, buffer, start, end, text, key, coded.dictionary, low, high)


def _dealt(lines: Lines, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slice and fingerprint of the distinct keys, and the order in which they travel."""
    name = lines.names()
    slice_ = (name % np.uint64(slices)).astype(np.int64)
    print_ = name >> np.uint64(24)
    return slice_, print_, np.lexsort((print_, slice_))


def _emit(least: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = chunk_lines(blob.as_py(), least)
                if not len(lines.keys):
                    continue
                slice_, print_, order = _dealt(lines, slices)
                goes, starts = np.unique(slice_[order], return_index=True)
                blobs = []
                for a, b in zip(starts, np.append(starts[1:], len(order))):
                    at = order[a:b]
                    step = np.diff(print_[at], prepend=np.uint64(0))
                    blobs.append(to_blob(pa.table([pa.array(step), pa.array(lines.low[at] < lines.high[at])], ["step", "again"])))
                yield pa.RecordBatch.from_arrays([pa.array(goes), pa.array(np.full(len(goes), chunk)), pa.array(blobs, pa.binary())], ["slice", "chunk", "blob"])

    return run


class Filters:
    """What was seen once and what was seen again, of one slice."""

    def __init__(self, places: int = PLACES) -> None:
        self.once, self.again = np.zeros(places, bool), np.zeros(places, bool)

    def _at(self, prints: np.ndarray) -> np.ndarray:
        return (mix(prints[:, None] + _SALTS) % np.uint64(len(self.once))).astype(np.int64)

    def add(self, prints: np.ndarray, again: np.ndarray) -> None:
        """Distinct fingerprints; ``again`` marks those that repeat where they come from."""
        at = self._at(prints)
        seen = self.once[at].all(1) | again
        self.again[at[seen]] = True
        self.once[at] = True

    def suspects(self, prints: np.ndarray) -> np.ndarray:
        return self.again[self._at(prints)].all(1)


def _filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slice, phase, chunk, blob) in order: phase 0 fills the filters of the slice, phase 1 is asked of them."""
    current, filters = None, None
    for batch in batches:
        for slice_, phase, chunk, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if slice_ != current:
                current, filters = slice_, Filters()
            table = from_blob(blob)
            prints = np.cumsum(table.column("step").to_numpy(), dtype=np.uint64)
            if phase == 0:
                filters.add(prints, table.column("again").to_numpy())
                continue
            mask = filters.suspects(prints)
            if mask.any():
                columns = [pa.array([chunk], pa.int64()), pa.array([slice_], pa.int64()), pa.array([np.packbits(mask).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "slice", "mask"])


def _suspected(least: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob, replies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                lines = chunk_lines(blob.as_py(), least)
                slice_, _, order = _dealt(lines, slices)
                picked = []
                for reply in replies:
                    a, b = np.searchsorted(slice_[order], [reply["slice"], reply["slice"] + 1])
                    picked.append(order[a:b][np.unpackbits(np.frombuffer(reply["mask"], np.uint8), count=b - a).astype(bool)])
                at = np.concatenate(picked)
                for k in range(0, len(at), 8192):
                    part = at[k : k + 8192]
                    columns = [pa.array(np.full(len(part), chunk)), pa.array(part), lines.keys.take(pa.array(part)), pa.array(lines.low[part]), pa.array(lines.high[part])]
                    yield pa.RecordBatch.from_arrays(columns, ["chunk", "local", "line", "low", "high"])

    return run


def _cut(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, replies in zip(batch.column(0), batch.column(1).to_pylist()):
                lines = chunk_lines(blob.as_py(), least)
                first = np.full(len(lines.keys) + 1, np.iinfo(np.int64).max)  # the last is for lines without a key
                if replies:
                    told = np.array([(r["local"], r["first"]) for r in replies], np.int64)
                    first[told[:, 0]] = told[:, 1]
                gone = lines.doc[lines.text] > first[lines.key]
                yield _texts(lines, gone)

    return run


def _texts(lines: Lines, gone: np.ndarray) -> pa.RecordBatch:
    """The texts of a chunk without the lines that go."""
    count = len(lines.doc)
    joined, starts, ends = lines.buffer.bytes, lines.buffer.starts.tolist(), lines.buffer.ends.tolist()
    dropped = np.bincount(lines.text[gone], minlength=count)
    values = [joined[a:b] for a, b in zip(starts, ends)]
    first = np.searchsorted(lines.text, np.arange(count + 1))
    for k in np.flatnonzero(dropped).tolist():
        own = np.arange(first[k], first[k + 1])
        own = own[~gone[own]]
        values[k] = b"\n".join([joined[a:b] for a, b in zip(lines.start[own].tolist(), lines.end[own].tolist())])
    return pa.RecordBatch.from_arrays(
        [lines.raw_keys, pa.array(np.bincount(lines.text, minlength=count)), pa.array(dropped), pa.array(values, pa.binary()).cast(pa.string())],
        ["key", "n_lines", "n_dropped", "text"],
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Drop every line that a document with a smaller key also holds.

    Columns: the key (as a long), ``n_lines``, ``n_dropped`` and ``text``, the lines that stay joined by
    newlines. Lines are cut at newlines and compared without ASCII white space at both ends and with A-Z
    lowered; lines of fewer than ``least`` characters then always stay. A null or empty text is one
    empty line. A null key is larger than all others. Rows that share a key are one document: they
    keep their common lines, and so does a document that repeats a line. An empty table gives no rows.

    A line that very many documents hold travels once for each chunk, and its comparison is
    summed before it is shuffled.
    """
    chunks = pack(docs, key, text, chunk_bytes)
    slices = max(1, math.ceil(chunks.count() / CHUNKS_A_SLICE))
    spark = docs.sparkSession
    prints = stage(chunks.mapInArrow(_emit(least, slices), "slice long, chunk long, blob binary"), "line-prints")
    phases = [prints.select("slice", F.lit(p).alias("phase"), "chunk", "blob") for p in (0, 1)]
    parts = min(slices, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
    dealt = phases[0].union(phases[1]).repartition(parts, "slice").sortWithinPartitions("slice", "phase")
    masks = dealt.mapInArrow(_filtered, "chunk long, slice long, mask binary")
    asked = masks.groupBy("chunk").agg(F.collect_list(F.struct("slice", "mask")).alias("replies"))
    suspects = stage(
        chunks.join(asked, "chunk").select("chunk", "blob", "replies").mapInArrow(_suspected(least, slices), "chunk long, local long, line binary, low long, high long"),
        "line-suspects",
    )
    firsts = suspects.groupBy("line").agg(F.min("low").alias("first"), F.max("high").alias("last")).where("first < last").drop("last")
    told = suspects.join(firsts, "line").groupBy("chunk").agg(F.collect_list(F.struct("local", "first")).alias("replies"))
    kept = chunks.join(told, "chunk", "left").select("blob", "replies").mapInArrow(_cut(least), "key long, n_lines long, n_dropped long, text string")
    return kept.withColumnRenamed("key", key)
