"""Phrases whose words belong together, by best-first branch and bound.

Phrases grow by one word at a time: two of ``k`` words that overlap make one of ``k + 1``. A phrase
that starts with p holds p's first word at least as often as itself, so no continuation of p
scores above ``2000000 f(p) / (f(first word) + f(p))``; the same holds backwards with the last word. Per
language the frontier is expanded from the best bound downwards, in batches that end at a score.
What lies below is never counted. As soon as enough phrases survive above the line, ties
included, the language is settled; otherwise the line is lowered and the next batch is counted.

A chunk of one language is numbered once. Counting sends each distinct phrase of a chunk with its
count to a bucket; the buckets add up, and a chunk is told which of its phrases are frequent. Most
pairs are rare, so fingerprints of the pairs are added up first and only what they cannot rule out is sent.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown.llm.hashing import Buffer, byte_hashes, mix
from renown.llm.memory import tidy
from renown.llm.superkmers import from_blob, gather, to_blob
from renown.session import stage

SCALE = 2_000_000
_TOP = SCALE + 1  # above every score
# words a slice of fingerprints is made for, and its cells
SLICE_WORDS, CELLS = 1 << 23, 1 << 23
BUCKET_WORDS = 1 << 23

_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(10, 14)]] = True
_GAPS = _BREAKS.copy()
_GAPS[[32, 9]] = True

_CHUNK = "chunk long, lang string, n long, size long, places binary, grams binary"


def _planes(name: str, rows: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of bytes as a column per byte: what compresses well is not mixed with what does not."""
    return {f"{name}{k}": np.ascontiguousarray(rows[:, k]) for k in range(rows.shape[1])}


def _rows(table: pa.Table, name: str, width: int) -> np.ndarray:
    """Rows of bytes from ``_planes``."""
    return np.stack([table.column(f"{name}{k}").to_numpy() for k in range(width)], 1).astype(np.uint8, copy=False)


def _places(places: np.ndarray) -> bytes:
    rows = (places + 1).astype("<u4").view(np.uint8).reshape(-1, 4)
    return to_blob(pa.table(_planes("place", rows)))


def _placed(blob: bytes) -> np.ndarray:
    return _rows(from_blob(blob), "place", 4).view("<u4").ravel().astype(np.int32) - 1


def _numbered(chunk: int, lang: str, texts: list[bytes]) -> pa.RecordBatch:
    """A chunk as numbers of its distinct words, frequent ones first, with -1 where a piece ends."""
    buffer = Buffer(texts, lower=True)
    start, end, _ = buffer.words(_GAPS)
    coded = gather(buffer.raw, start, end).dictionary_encode()
    word = coded.indices.to_numpy()
    pieces = np.cumsum(_BREAKS[buffer.raw])
    apart = np.flatnonzero(np.diff(pieces[start])) + 1
    count = np.bincount(word, minlength=len(coded.dictionary))
    order = np.argsort(-count, kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order))
    grams = pa.table([coded.dictionary.take(pa.array(order)), pa.array(count[order])], ["key", "n"])
    return _row(chunk, lang, len(word), np.insert(number[word], apart, -1), grams)


def _row(chunk: int, lang: str, n: int, places: np.ndarray, grams: pa.Table) -> pa.RecordBatch:
    columns = [[chunk], [lang], [n], [grams.num_rows], [_places(places)], [to_blob(grams)]]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["chunk", "lang", "n", "size", "places", "grams"])


def _cut(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, []).append(text.as_py().encode())
                size[lang] = size.get(lang, 0) + len(held[lang][-1]) + 1
                full = lang if size[lang] >= chunk_bytes else max(size, key=size.get) if sum(size.values()) >= 2 * chunk_bytes else None
                if full is not None:
                    yield _numbered(number, full, held.pop(full))
                    del size[full]
                    number += 1
        for lang in held:
            yield _numbered(number, lang, held[lang])
            number += 1

    return tidy(run)


def _phrases(left: np.ndarray, right: np.ndarray, n: np.ndarray, forward: np.ndarray, backward: np.ndarray) -> pa.Table:
    """The phrases of a chunk as they are kept, the bytes of long numbers apart."""
    parts = [_planes(c, np.ascontiguousarray(x, kind).view(np.uint8).reshape(len(x), int(kind[2]))) for c, x, kind in (("left", left, "<i8"), ("right", right, "<i8"), ("sb", backward, "<i4"))]
    return pa.table(parts[0] | parts[1] | parts[2] | {"n": n.astype(np.int32), "pb": forward.astype(np.int32)})


def _grams(blob: bytes) -> pa.Table:
    """The words of a chunk, or its phrases: left, right, n, pb, sb."""
    table = from_blob(blob)
    if "key" in table.column_names:
        return table
    parts = [_rows(table, c, 8).view("<i8").ravel() for c in ("left", "right")]
    return pa.table({"left": parts[0], "right": parts[1], "n": table.column("n"), "pb": table.column("pb"), "sb": _rows(table, "sb", 4).view("<i4").ravel()})


def _keys(table: pa.Table) -> pa.Array:
    """Keys of the phrases of a chunk: words as they are, longer ones by the numbers of their two parts."""
    if "key" in table.column_names:
        return table.column("key").combine_chunks()
    parts = np.stack([table.column(c).to_numpy() for c in ("left", "right")], 1)
    return _bytes(parts.astype(">i8").view(np.uint8).reshape(len(parts), 16))


def _laid_out(asked: pa.Table, width: int) -> pa.Table:
    """What is asked of a bucket as it travels: steps instead of places, and keys of ``width`` bytes by byte (0: as they are)."""
    columns = {"n": asked.column("n"), "step": np.diff(asked.column("local").to_numpy(), prepend=0)}
    if not width:
        return pa.table({"key": asked.column("key"), **columns})
    key = asked.column("key").combine_chunks()
    raw = np.frombuffer(key.buffers()[2], np.uint8)[key.offset * width : (key.offset + len(key)) * width]
    return pa.table(_planes("key", raw.reshape(-1, width)) | columns)


def _asked_of(blob: bytes) -> pa.Table:
    """(key, n, local) from ``_laid_out``."""
    table = from_blob(blob)
    width = sum(c.startswith("key") for c in table.column_names)
    key = table.column("key") if "key" in table.column_names else _bytes(_rows(table, "key", width))
    return pa.table([key, table.column("n"), np.cumsum(table.column("step").to_numpy())], ["key", "n", "local"])


def _asked(buckets: int, slices: int, phrases: bool):
    """Rows (lang, chunk, grams, masks, new, old) to one row for each bucket.

    Where there are masks, only what the count of fingerprints lets through is asked for; where there are
    bounds, only what belongs to the batch between the lines ``new`` and ``old``. ``phrases`` have keys of one width.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, chunk, grams, masks, new, old in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2), *(batch.column(k).to_pylist() for k in (3, 4, 5))):
                table = _grams(grams.as_py())
                local = np.arange(table.num_rows)
                if masks is not None:
                    slice_, _, order = _dealt(table, slices)
                    local = np.sort(np.concatenate([order[:0], *(_let_through(slice_[order], order, m) for m in masks)]))
                elif "pb" in table.column_names:
                    local = np.flatnonzero(_fresh(table.column("pb").to_numpy(), table.column("sb").to_numpy(), new, old))
                if not len(local):
                    continue
                table = table.take(pa.array(local))
                key = _keys(table)
                width = len(key[0].as_py()) if phrases else 0
                offsets = np.frombuffer(key.buffers()[1], np.int32)[key.offset : key.offset + len(key) + 1].astype(np.int64)
                bucket = (byte_hashes(np.frombuffer(key.buffers()[2], np.uint8), offsets[:-1], offsets[1:]) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                sent = pa.table([key, table.column("n"), pa.array(local.astype(np.int32))], ["key", "n", "local"]).take(pa.array(order))
                goes, starts = np.unique(bucket[order], return_index=True)
                blobs = [to_blob(_laid_out(sent.slice(a, b - a), width)) for a, b in zip(starts, np.append(starts[1:], len(order)))]
                columns = [pa.array([lang] * len(goes), pa.string()), pa.array(goes), pa.array(np.full(len(goes), chunk)), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "chunk", "blob"])

    return tidy(run)


def _let_through(slices: np.ndarray, order: np.ndarray, mask: dict) -> np.ndarray:
    a, b = np.searchsorted(slices, [mask["slice"], mask["slice"] + 1])
    return order[a:b][np.unpackbits(np.frombuffer(mask["mask"], np.uint8), count=b - a).astype(bool)]


def _dealt(table: pa.Table, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slice and cell of each phrase, and the order in which they travel."""
    left, right = (table.column(c).to_numpy().astype(np.uint64) for c in ("left", "right"))
    name = mix(mix(left + np.uint64(1)) ^ right)
    slice_, cell = (name % np.uint64(slices)).astype(np.int64), ((name >> np.uint64(32)) % np.uint64(CELLS)).astype(np.int64)
    return slice_, cell, np.lexsort((cell, slice_))


def _prints(slices: int):
    """Rows (lang, chunk, grams) to the cells of their phrases and how often each occurs, by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, chunk, grams in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2)):
                table = _grams(grams.as_py())
                if not table.num_rows:
                    continue
                slice_, cell, order = _dealt(table, slices)
                goes, starts = np.unique(slice_[order], return_index=True)
                step = np.diff(cell[order], prepend=0)
                step[starts] = cell[order[starts]]
                numbers = np.stack([step, table.column("n").to_numpy()[order]], 1).astype("<u4")
                sent = pa.table(_planes("byte", numbers.view(np.uint8)))
                blobs = [to_blob(sent.slice(a, b - a)) for a, b in zip(starts, np.append(starts[1:], len(order)))]
                columns = [pa.array([lang] * len(goes), pa.string()), pa.array(goes), pa.array(np.full(len(goes), chunk)), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "slice", "chunk", "blob"])

    return tidy(run)


def _reached(least: int):
    """Rows (lang, slice, chunk, blob) in order to what each chunk is told: which of its cells reach ``least``.

    The blobs of a slice are held until they are added up; a slice is made for ``SLICE_WORDS`` words, so they are few.
    """

    def opened(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        numbers = _rows(from_blob(blob), "byte", 8).view("<u4").astype(np.int64)
        return np.cumsum(numbers[:, 0]), numbers[:, 1]

    def told(slice_: int, cells: np.ndarray, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        for chunk, blob in held:
            mask = cells[opened(blob)[0]] >= least
            if mask.any():
                columns = [pa.array([chunk], pa.int64()), pa.array([slice_], pa.int64()), pa.array([np.packbits(mask).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "slice", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, cells, held = (None, 0), np.empty(0), []
        for batch in batches:
            for lang, slice_, chunk, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, slice_) != current:
                    yield from told(current[1], cells, held)
                    current, cells, held = (lang, slice_), np.zeros(CELLS, np.int64), []
                np.add.at(cells, *opened(blob))
                held.append((chunk, blob))
        yield from told(current[1], cells, held)

    return tidy(run)


def _fresh(forward: np.ndarray, backward: np.ndarray, new: int, old: int) -> np.ndarray:
    """What a bound reaches in this batch and none reached in the batches before."""
    best = np.maximum(forward, backward)
    return (best >= new) & (best < old)


def _added(table: pa.Table, read: Callable[[bytes], pa.Table]) -> pa.Table:
    summed = pa.concat_tables([read(b).select(["key", "n"]) for b in table.column("blob").to_pylist()]).group_by("key").aggregate([("n", "sum")])
    return summed.rename_columns({"n_sum": "n"})


def _merged(table: pa.Table) -> pa.Table:
    head = table.slice(0, 1).select(["lang", "bucket"])
    return head.append_column("blob", pa.array([to_blob(_added(table, _asked_of).select(["key", "n"]))], pa.binary()))


def _frequent(least: int):
    def run(table: pa.Table) -> pa.Table:
        summed = _added(table, from_blob)
        summed = summed.filter(pc.greater_equal(summed.column("n"), least)).sort_by("key")
        bucket, count = table.column("bucket")[0].as_py(), summed.num_rows
        ids = (np.uint64(bucket << 32) + np.arange(count, dtype=np.uint64)).astype(">u8")
        return pa.table(
            [
                pa.array([table.column("lang")[0].as_py()] * count, pa.string()), pa.array(np.full(count, bucket)),
                pa.array([i.tobytes() for i in ids], pa.binary()), summed.column("key").cast(pa.binary()), summed.column("n").cast(pa.int64()),
            ],
            ["lang", "bucket", "id", "key", "a"],
        )

    return run


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, blob asked, frequent phrases of the bucket) to what the chunk is told."""
    for batch in batches:
        for chunk, blob, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            asked, known = _asked_of(blob.as_py()), known.values
            at = pc.index_in(asked.column("key").combine_chunks().cast(pa.binary()), value_set=known.field("key"))
            found = pc.is_valid(at)
            rows = known.take(at.filter(found))
            if len(rows):
                ids = np.frombuffer(b"".join(rows.field("id").to_pylist()), np.uint8).reshape(-1, 8)
                step = np.diff(asked.column("local").filter(found).to_numpy(), prepend=0)
                reply = pa.table({"step": step, **_planes("id", ids), "pb": rows.field("pb"), "sb": rows.field("sb")})
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([to_blob(reply)], pa.binary())], ["chunk", "reply"])


def _heard(replies: list[bytes] | None, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every phrase of the chunk: its number and its two bounds, -1 where it is not frequent."""
    ids, forward, backward = np.zeros(count, np.int64), np.full(count, -1, np.int64), np.full(count, -1, np.int64)
    for blob in replies or []:
        table = from_blob(blob)
        local = np.cumsum(table.column("step").to_numpy())
        ids[local] = _rows(table, "id", 8).view(">i8").ravel()
        forward[local], backward[local] = table.column("pb").to_numpy(), table.column("sb").to_numpy()
    return ids, forward, backward


def grown(places: np.ndarray, take: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring phrases as the phrases one word longer, where ``take`` says so.

    Returns the number of the longer phrase at each place (-1 where there is none), and left part,
    right part and count of each.
    """
    pair = places[:-1][take].astype(np.int64) * count + places[1:][take]
    code, number, n = np.unique(pair, return_inverse=True, return_counts=True)
    longer = np.full(max(len(places) - 1, 0), -1, np.int64)
    longer[take] = number
    return longer, code // max(count, 1), code % max(count, 1), n


def _bytes(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as one binary column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, lang, n, size, places, replies) to the chunks of phrases one word longer."""
    for batch in batches:
        for chunk, lang, n, count, places, replies in zip(*(batch.column(k).to_pylist() for k in range(4)), batch.column(4), batch.column(5).to_pylist()):
            places = _placed(places.as_py())
            ids, forward, backward = _heard(replies, count)
            left, right = places[:-1], places[1:]
            alive = np.append(forward >= 0, False)  # the last is for -1
            longer, left, right, times = grown(places, alive[left] & alive[right], count)
            yield _row(chunk, lang, n, longer, _phrases(ids[left], ids[right], times, forward[left], backward[right]))


def _longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, lang, places, grams, replies, new, old) of three words to the four-word phrases of the batch."""
    for batch in batches:
        for chunk, lang, places, grams, replies, new, old in zip(*(batch.column(k).to_pylist() for k in (0, 1)), *(batch.column(k) for k in (2, 3)), *(batch.column(k).to_pylist() for k in (4, 5, 6))):
            places = _placed(places.as_py())
            known = _grams(grams.as_py())
            first, second = (known.column(c).to_numpy() for c in ("left", "right"))
            _, forward, backward = _heard(replies, known.num_rows)
            left, right = places[:-1], places[1:]
            forward, backward = np.append(forward, -1), np.append(backward, -1)
            take = (left >= 0) & (right >= 0) & _fresh(forward[left], backward[right], new, old)
            _, left, right, times = grown(places, take, known.num_rows)
            numbers = np.stack([first[left], second[left], second[right]], 1).astype(">i8")
            table = pa.table([_bytes(numbers.view(np.uint8).reshape(len(numbers), 24)), pa.array(times)], ["key", "n"])
            columns = [pa.array([lang], pa.string()), pa.array([chunk], pa.int64()), pa.array([to_blob(table)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "grams"])


def _ratio(a: Column, l: Column, r: Column) -> Column:
    """floor(2000000 a / (l + r)), exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * wide(a), wide(l) + wide(r)).cast("bigint")


def _bounded(records: DataFrame) -> DataFrame:
    """Scores with their cut, and the bounds of all continuations forwards (``pb``) and backwards (``sb``).

    ``heads`` and ``tails`` hold how often the first and the last 1, 2, ... words occur, the whole phrase last.
    """
    a, size = F.col("a"), F.size("words")
    cut = lambda k: F.struct(
        _ratio(a, F.element_at("heads", k), F.element_at("tails", size - k)).alias("score"), k.alias("k"),
        F.element_at("heads", k).alias("l"), F.element_at("tails", size - k).alias("r"),
    )
    known = F.forall(F.concat("heads", "tails"), lambda x: x.isNotNull())
    return records.withColumn("best", F.when(known, F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut)))).withColumns(
        {"pb": _ratio(a, F.element_at("heads", 1), a), "sb": _ratio(a, F.element_at("tails", 1), a)}
    )


@dataclass
class _Counter:
    """Adds up phrases over the chunks, in buckets."""

    buckets: int
    fan: int
    least: int

    slices: int
    parts: int

    def ask(self, rows: DataFrame, new: Column | None = None, old: Column | None = None, masks: Column | None = None, phrases: bool = True) -> DataFrame:
        none = F.lit(None).cast("array<struct<slice:bigint,mask:binary>>")
        columns = [none if masks is None else masks, F.lit(0).cast("bigint") if new is None else new, F.lit(_TOP).cast("bigint") if old is None else old]
        asked = rows.select("lang", "chunk", "grams", *[c.alias(n) for c, n in zip(columns, ("masks", "new", "old"))])
        return stage(asked.mapInArrow(_asked(self.buckets, self.slices, phrases), "lang string, bucket long, chunk long, blob binary"), "phrase-asked")

    def masks(self, rows: DataFrame) -> DataFrame:
        """Which phrases of each chunk may occur ``least`` times: (chunk, masks).

        Phrases are added up in cells, which never count too little; their cells travel once, and far less than with the phrases.
        """
        cells = rows.select("lang", "chunk", "grams").mapInArrow(_prints(self.slices), "lang string, slice long, chunk long, blob binary")
        dealt = cells.repartition(min(self.parts, 4 * self.slices), "lang", "slice").sortWithinPartitions("lang", "slice")
        told = dealt.mapInArrow(_reached(self.least), "chunk long, slice long, mask binary")
        return told.groupBy("chunk").agg(F.collect_list(F.struct("slice", "mask")).alias("masks"))

    def frequent(self, asked: DataFrame) -> DataFrame:
        """Phrases found ``least`` times, numbered. Chunks are added up in parts first, so no group grows with all of them."""
        part = asked.select("lang", "bucket", F.pmod(F.xxhash64("chunk"), F.lit(self.fan)).alias("part"), "blob")
        some = part.groupBy("lang", "bucket", "part").applyInArrow(_merged, "lang string, bucket long, blob binary")
        return some.groupBy("lang", "bucket").applyInArrow(_frequent(self.least), "lang string, bucket long, id binary, key binary, a long")

    def tell(self, asked: DataFrame, known: DataFrame) -> DataFrame:
        """What each chunk hears about its phrases: (chunk, reply)."""
        lists = known.groupBy("lang", "bucket").agg(F.collect_list(F.struct("key", "id", F.col("pb").cast("int").alias("pb"), F.col("sb").cast("int").alias("sb"))).alias("known"))
        return asked.join(lists, ["lang", "bucket"]).select("chunk", "blob", "known").mapInArrow(tidy(_told), "chunk long, reply binary")


def _gathered(replies: DataFrame) -> DataFrame:
    return replies.groupBy("chunk").agg(F.collect_list("reply").alias("replies"))


def _covered(records: DataFrame, longer: DataFrame, name: str, width: int) -> DataFrame:
    """Drop phrases inside a longer one that occurs at least 80 times for 100 of theirs.

    One word more is enough: if a phrase two words longer is that frequent, so is the one between.
    """
    ends = longer.select("lang", F.substring("key", 1, width).alias(name), "a").union(longer.select("lang", F.substring("key", 9, width), "a"))
    most = ends.groupBy("lang", name).agg(F.max("a").alias("most"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    return records.join(most, ["lang", name], "left").where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * 80)).drop("most")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = 2000, least: int = 30, chunk_bytes: int = 4 << 20, growth: int = 8) -> DataFrame:
    """The ``top`` phrases of two to four words of each language by score.

    Columns: lang, rank, phrase, ``a`` (occurrences), ``l`` and ``r`` (of the two parts of the lowest-scoring cut),
    ``n`` (words of the language) and ``score`` = floor(2000000 a / (l + r)). Texts are lowered in A-Z and
    cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs. Phrases found less
    than ``least`` times do not count, and a phrase inside a longer one that occurs at least 0.8
    times as often is dropped. Ranks follow score and ``a`` downwards, then the phrase. A null text is
    empty, a null language is ``und``; a language without such phrases, and an empty table, give no rows.

    The first line is the score of pair number ``2 * top``; a language that it does not settle goes on
    to pair number ``growth`` times as far, in the end to all of them.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chunks = stage(rows.mapInArrow(_cut(chunk_bytes), _CHUNK), "phrase-words")
    total = chunks.agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("n")).first()
    words_in_all, parts = total["n"] or 0, max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counter = _Counter(math.ceil(words_in_all / BUCKET_WORDS) or 1, max(1, math.isqrt(total["chunks"])), least, math.ceil(words_in_all / SLICE_WORDS) or 1, parts)

    asked = counter.ask(chunks, phrases=False)
    words = stage(counter.frequent(asked).withColumns({"pb": F.lit(0), "sb": F.lit(0)}), "phrase-word-counts")
    heard = _gathered(counter.tell(asked, words))
    names = ["chunk", "lang", "n", "size", "places"]
    two = stage(chunks.join(heard, "chunk").select(*names, "replies").mapInArrow(tidy(_longer), _CHUNK), "phrase-pairs")

    asked = counter.ask(two.select("chunk", "lang", "grams").join(counter.masks(two), "chunk"), masks=F.col("masks"))
    part = lambda n, width=8: F.substring("key", 1 + 8 * (n - 1), width)
    word = lambda n: words.select("lang", F.col("id").alias(f"id{n}"), F.col("key").cast("string").alias(f"w{n}"), F.col("a").alias(f"f{n}"))
    pairs = stage(
        _bounded(
            counter.frequent(asked).withColumns({"id1": part(1), "id2": part(2)}).join(word(1), ["lang", "id1"]).join(word(2), ["lang", "id2"])
            .select("lang", "bucket", "id", "key", "a", F.array("w1", "w2").alias("words"), F.array("f1", "a").alias("heads"), F.array("f2", "a").alias("tails"))
        ),
        "phrase-pair-counts",
    )
    heard = _gathered(counter.tell(asked, pairs))
    three = stage(two.join(heard, "chunk").select(*names, "replies").mapInArrow(tidy(_longer), _CHUNK), "phrase-triples")
    pair = lambda n: pairs.select("lang", F.col("id").alias(f"id{n}"), F.col("words").alias(f"w{n}"), F.col("heads").alias(f"h{n}"), F.col("tails").alias(f"t{n}"))

    triples = quads = replies = None
    reach, old = 2 * top, pairs.select("lang").distinct().withColumns({"old": F.lit(_TOP).cast("bigint"), "settled": F.lit(False)})
    while True:
        best = Window.partitionBy("lang").orderBy(F.desc("best.score"))
        head = pairs.select("lang", "best").withColumn("place", F.row_number().over(best)).where(F.col("place") <= reach)
        level = head.groupBy("lang").agg(F.when(F.count(F.lit(1)) == reach, F.min("best.score")).otherwise(0).alias("level"))
        # a settled language keeps its line
        new = F.when(F.col("settled"), F.col("old")).otherwise(F.col("level"))
        line = stage(old.join(level, "lang").select("lang", new.alias("new"), "old"), "phrase-line")

        asked = counter.ask(three.select("chunk", "lang", "grams").join(line, "lang"), F.col("new"), F.col("old"))
        found = (
            counter.frequent(asked).withColumns({"id1": part(1), "id2": part(2)}).join(pair(1), ["lang", "id1"]).join(pair(2), ["lang", "id2"])
            .select(
                "lang", "bucket", "id", "key", "a", F.concat("w1", F.slice("w2", 2, 1)).alias("words"),
                F.concat("h1", F.array("a")).alias("heads"), F.concat("t2", F.array("a")).alias("tails"),
            )
        )
        found = stage(_bounded(found), "phrase-triple-counts")
        triples = found if triples is None else triples.unionByName(found)
        told = stage(counter.tell(asked, found), "phrase-told")
        replies = told if replies is None else replies.union(told)
        grown_ = three.join(_gathered(replies), "chunk").join(line, "lang").where("new < old").select("chunk", "lang", "places", "grams", "replies", "new", "old")
        longest = grown_.mapInArrow(tidy(_longest), "lang string, chunk long, grams binary")
        three_of = lambda n: triples.select("lang", F.col("key").alias(f"key{n}"), F.col("a").alias(f"a{n}"))
        found = (
            counter.frequent(counter.ask(longest)).withColumns({"id1": part(1), "id3": part(3), "key1": part(1, 16), "key2": part(2, 16)})
            .join(pair(1), ["lang", "id1"]).join(pair(3), ["lang", "id3"]).join(three_of(1), ["lang", "key1"], "left").join(three_of(2), ["lang", "key2"], "left")
            .select(
                "lang", "bucket", "id", "key", "a", F.concat("w1", "w3").alias("words"),
                F.concat("h1", F.array("a1", "a")).alias("heads"), F.concat("t3", F.array("a2", "a")).alias("tails"),
            )
        )
        found = stage(_bounded(found), "phrase-quad-counts")
        quads = found if quads is None else quads.unionByName(found)

        scored = [_covered(pairs, triples, "id", 8), _covered(triples, quads, "key", 16), quads]
        columns = ["lang", "words", "a", "best"]
        alive = scored[0].select(*columns).union(scored[1].select(*columns)).union(scored[2].select(*columns)).join(line, "lang").where(F.col("best.score") >= F.col("new"))
        alive = stage(alive.select(*columns, "new"), "phrase-alive")
        enough = line.join(alive.groupBy("lang").agg(F.count(F.lit(1)).alias("count")), "lang", "left")
        old = stage(enough.select("lang", F.col("new").alias("old"), ((F.col("new") <= 0) | (F.coalesce("count", F.lit(0)) >= top)).alias("settled")), "phrase-settled")
        if old.where(~F.col("settled")).isEmpty():
            break
        reach *= growth
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    sizes = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    return (
        alive.select("lang", F.array_join("words", " ").alias("phrase"), "a", "best.l", "best.r", "best.score")
        .withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top).join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
