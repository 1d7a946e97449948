"""Substring deduplication on words with super-k-mer partitioning.

Runs of windows that share a minimiser travel as one packed string to the bucket of the
minimiser. There the windows are sorted, equal ones are counted exactly, and the smallest
document key of each window goes back to the chunks that hold it. A window is removed from
every document with a larger key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.hashing import Buffer, mix
from renown.llm.memory import tidy
from renown.llm.superkmers import LAST, from_blob, gather, opened, pack, pieces, to_blob, word_runs


def chunk_runs(blob: bytes, k: int, m: int) -> tuple[np.ndarray, pa.Array, list, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of a chunk: its keys, the pieces with their runs and words, and over all runs
    the number of the string (equal bytes, equal number), the document key and the smallest key of the string."""
    keys, raw_keys, texts = opened(blob)
    cut = [(first, len(part), *word_runs(part, k, m)) for first, part in pieces(texts)]
    strings = pa.chunked_array([gather(runs.buffer.raw, runs.start, runs.end) for _, _, runs, *_ in cut], pa.binary())
    code = np.concatenate([np.empty(0, np.int64), *(c.indices.to_numpy().astype(np.int64) for c in strings.dictionary_encode().chunks)])
    key = np.concatenate([np.empty(0, np.int64), *(keys[first + runs.text] for first, _, runs, *_ in cut)])
    lowest = np.full(code.max() + 1 if len(code) else 0, LAST, np.int64)
    np.minimum.at(lowest, code, key)
    return keys, raw_keys, cut, code, key, lowest[code]


def _buckets(cut: list, code: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each distinct string of a chunk."""
    minimiser = np.concatenate([np.empty(0, np.uint64), *(runs.minimiser for _, _, runs, *_ in cut)])
    _, first = np.unique(code, return_index=True)
    return (minimiser[first] % np.uint64(buckets)).astype(np.int64)


def _emit(k: int, m: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from _packed(chunk, blob.as_py(), k, m, buckets)

    return tidy(run)


def _packed(chunk: int, blob: bytes, k: int, m: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct runs of a chunk, one row for each bucket they go to."""
    _, _, cut, code, _, lowest = chunk_runs(blob, k, m)
    _, first = np.unique(code, return_index=True)
    if not len(first):
        return
    own = np.zeros(len(code), bool)
    own[first] = True
    strings, base = [], 0
    for _, _, runs, *_ in cut:
        at = np.flatnonzero(own[base : base + len(runs.first)])
        strings.append(gather(runs.buffer.raw, runs.start[at], runs.end[at]))
        base += len(runs.first)
    bucket = _buckets(cut, code, buckets)
    order = np.argsort(bucket, kind="stable")
    # keys travel as differences, which compress
    steps = np.diff(lowest[first][order], prepend=0)
    table = pa.table([pa.array(steps), pa.chunked_array(strings).take(pa.array(order))], ["step", "text"])
    goes, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    blobs = [to_blob(table.slice(a, b - a)) for a, b in zip(starts, ends)]
    before = np.concatenate([[0], np.cumsum(steps)])[starts]
    yield pa.RecordBatch.from_arrays(
        [pa.array(goes), pa.array(np.full(len(goes), chunk)), pa.array(before), pa.array(blobs, pa.binary())], ["bucket", "chunk", "before", "blob"]
    )


def _windows(strings: list[bytes], k: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of packed strings: the joined bytes; of the windows the hash, string, place in
    it, start and end."""
    joined = b"\n".join([*strings, b""])
    found: list[tuple] = []
    factors = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    base = 0
    for first, part in pieces(strings):
        buffer = Buffer(part)
        start, end, text = buffer.words()
        words = buffer.hashes(start, end)
        n = max(len(start) - k + 1, 0)
        at = np.flatnonzero(text[:n] == text[k - 1 :]) if n else np.empty(0, np.int64)
        value = np.zeros(n, np.uint64)
        for j in range(k):
            value += words[j : j + n] * factors[j]
        head = np.searchsorted(text, np.arange(len(part)))
        found.append((mix(value[at]), first + text[at], at - head[text[at]], base + start[at], base + end[at + k - 1]))
        base += len(buffer.raw)
    return joined, *(np.concatenate(c) for c in zip(*found))


def equal_ranges(raw: bytes, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes a..a+size and b..b+size agree, eight at a time."""
    padded = raw + bytes(16)
    view = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    same = np.ones(len(a), bool)
    open_ = np.arange(len(a))
    for step in range(0, int(size.max()) if len(size) else 0, 8):
        open_ = open_[size[open_] > step]
        left = np.minimum(size[open_] - step, 8).astype(np.uint64)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8))
        differ = ((view[a[open_] + step] ^ view[b[open_] + step]) & mask) != 0
        same[open_[differ]] = False
        open_ = open_[~differ]
    return same


def _grouped(raw: bytes, value: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows that puts equal ones together, and where groups begin in it."""
    order = np.argsort(value, kind="stable")
    fresh = np.ones(len(order), bool)
    fresh[1:] = value[order[1:]] != value[order[:-1]]
    head = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    size = end - start
    later = ~fresh
    same = (size[order[later]] == size[head[later]]) & equal_ranges(raw, start[order[later]], start[head[later]], np.minimum(size[order[later]], size[head[later]]))
    if not same.all():
        # different windows under one hash: sort the strings themselves
        strings = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
        order = np.array(sorted(range(len(strings)), key=strings.__getitem__), np.int64)
        fresh = np.array([i == 0 or strings[order[i]] != strings[order[i - 1]] for i in range(len(order))])
    return order, np.flatnonzero(fresh)


def _matched(k: int):
    def run(table: pa.Table) -> pa.Table:
        parts = [from_blob(b) for b in table.column("blob").to_pylist()]
        number = np.concatenate([np.arange(p.num_rows) for p in parts])  # of a string in its row
        chunk = np.repeat(table.column("chunk").to_numpy(), [p.num_rows for p in parts])
        key = np.concatenate([b + np.cumsum(p.column("step").to_numpy()) for b, p in zip(table.column("before").to_pylist(), parts)])
        raw, value, string, place, start, end = _windows(pa.concat_tables(parts).column("text").to_pylist(), k)
        order, heads = _grouped(raw, value, start, end)
        lowest = np.minimum.reduceat(key[string[order]], heads)
        lowest = np.repeat(lowest, np.diff(np.append(heads, len(order))))
        hit = lowest < key[string[order]]
        order, lowest = order[hit], lowest[hit]
        by_chunk = np.argsort(chunk[string[order]], kind="stable")
        order, lowest = order[by_chunk], lowest[by_chunk]
        chunks, starts = np.unique(chunk[string[order]], return_index=True)
        reply = pa.table([number[string[order]].astype(np.int32), place[order].astype(np.int32), lowest], ["number", "place", "key"])
        blobs = [to_blob(reply.slice(a, b - a)) for a, b in zip(starts, np.append(starts[1:], len(order)))]
        bucket = np.full(len(chunks), table.column("bucket")[0].as_py())
        return pa.table([pa.array(chunks, pa.int64()), pa.array(bucket, pa.int64()), pa.array(blobs, pa.binary())], ["chunk", "bucket", "blob"])

    return run


def _cut(k: int, m: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, replies in zip(batch.column(0), batch.column(1).to_pylist()):
                yield from _kept(blob.as_py(), replies or [], k, m, buckets)

    return tidy(run)


def _kept(blob: bytes, replies: list[dict], k: int, m: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The texts of a chunk without their removed words."""
    _, raw_keys, cut, code, key, lowest = chunk_runs(blob, k, m)
    bucket = _buckets(cut, code, buckets)
    sent = np.argsort(bucket, kind="stable")
    told, codes = [from_blob(r["blob"]) for r in replies], []
    for reply, table in zip(replies, told):
        codes.append(sent[np.searchsorted(bucket[sent], reply["bucket"]) + table.column("number").to_numpy()])
    codes = np.concatenate([np.empty(0, np.int64), *codes])
    places = np.concatenate([np.empty(0, np.int64), *(t.column("place").to_numpy().astype(np.int64) for t in told)])
    smaller = np.concatenate([np.empty(0, np.int64), *(t.column("key").to_numpy() for t in told)])
    address = codes << 32 | places
    order = np.argsort(address)
    address, smaller = address[order], smaller[order]
    asked = np.isin(code, codes) | (lowest < key)
    base = 0
    for first, count, runs, start, end, text in cut:
        at = np.flatnonzero(asked[base : base + len(runs.first)])
        size = runs.windows[at]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        run = np.repeat(at, size)
        limit = lowest[base + run]
        if len(address):
            wanted = code[base + run] << 32 | place
            near = np.minimum(np.searchsorted(address, wanted), len(address) - 1)
            limit = np.where(address[near] == wanted, np.minimum(limit, smaller[near]), limit)
        window = (runs.first[run] + place)[limit < key[base + run]]
        cover = np.zeros(len(start) + 1, np.int32)
        np.add.at(cover, window, 1)
        np.add.at(cover, window + k, -1)
        gone = np.cumsum(cover[:-1]) > 0
        base += len(runs.first)
        yield _texts(raw_keys.slice(first, count), runs.buffer, start, end, text, gone, count)


def _texts(keys: pa.Array, buffer: Buffer, start: np.ndarray, end: np.ndarray, text: np.ndarray, gone: np.ndarray, count: int) -> pa.RecordBatch:
    edge = np.zeros(len(buffer.raw) + 1, np.int8)
    edge[start[~gone]] += 1
    edge[end[~gone] + 1] -= 1
    mask = np.cumsum(edge[:-1]).astype(bool)
    kept = buffer.raw[mask]
    # bytes of the kept words of each text; the last separator goes
    size = np.bincount(text[~gone], weights=(end - start + 1)[~gone], minlength=count).astype(np.int64)
    stop = np.cumsum(size)
    joined = kept.tobytes()
    values = [joined[a:b] for a, b in zip((stop - size).tolist(), np.maximum(stop - 1, stop - size).tolist())]
    return pa.RecordBatch.from_arrays(
        [
            keys, pa.array(np.bincount(text, minlength=count)), pa.array(np.bincount(text[gone], minlength=count)),
            pa.array(values, pa.binary()).cast(pa.string()),
        ],
        ["key", "n_words", "n_removed", "text"],
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 13, m: int = 2, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Remove every word covered by a window of ``k`` words that also starts in a document with a smaller key.

    Columns: the key (as a long), ``n_words``, ``n_removed`` and ``text``, the kept words
    joined by one space. Words are runs outside ASCII white space, unchanged. Windows are
    judged on the input. Null, empty and short texts have no windows; a null text has no words.
    A null key is larger than all others, so its windows are removed if any key has them, and
    rows with equal keys never remove each other's words. An empty table gives no rows.

    A window that occurs in very many documents is one string per chunk, so a bucket sees
    it at most once for every ``chunk_bytes`` of text.
    """
    chunks = pack(docs, key, text, chunk_bytes)
    buckets = max(1, chunks.count())
    travelling = chunks.mapInArrow(_emit(k, m, buckets), "bucket long, chunk long, before long, blob binary")
    replies = travelling.groupBy("bucket").applyInArrow(_matched(k), "chunk long, bucket long, blob binary")
    gathered = replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "blob")).alias("replies"))
    kept = chunks.join(gathered, "chunk", "left").select("blob", "replies").mapInArrow(_cut(k, m, buckets), "key long, n_words long, n_removed long, text string")
    return kept.withColumnRenamed("key", key)
