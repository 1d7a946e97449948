"""Benchmark decontamination by spaced-seed hashing.

A document is contaminated by an item if ``WINDOW`` consecutive words of both agree in
all but ``SUBSTITUTIONS`` places. A seed looks at six of the words a mask selects and
ignores the rest. Cut the window into four interleaved blocks of three: two substitutions
spoil two blocks at most, so the mask over the other two still hits. Of the six
pairs of blocks three are shifts of one another, which leaves three masks; they find every
such window, and every hit is verified word by word on its diagonal.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from renown.llm.hashing import LETTERS, Buffer, mix
from renown.llm.memory import tidy

WINDOW, SUBSTITUTIONS = 12, 2
MASKS = tuple(tuple(p for p in range(WINDOW) if p % 4 in (0, k)) for k in (1, 2, 3))

_FILTER_BITS = 22
_ROWS = 256
_FACTORS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of the words: runs of letters, digits and non-ASCII bytes, A-Z lowered."""
    buffer = Buffer([(t or "").encode() for t in texts], lower=True)
    start, end, text = buffer.words(~LETTERS)
    return buffer.hashes(start, end), text


def _seeds(words: np.ndarray, text: np.ndarray, offsets: tuple[int, ...], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a seed with these word offsets lies inside one text, and its hash there."""
    span = offsets[-1] + 1
    n = len(words) - span + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(text[:n] == text[span - 1 :])
    total = np.full(len(at), salt + 1, np.uint64)
    for k, offset in enumerate(offsets):
        total += words[at + offset] * _FACTORS[k]
    return at, mix(total)


class TestSet:
    """Seeds of the items, sorted, behind a bitmap that turns most look-ups away."""

    def __init__(self, ids: list, texts: list[str]) -> None:
        self.ids = ids
        self.words, self.item = _words(texts)
        self.first = np.searchsorted(self.item, np.arange(len(ids)))
        self.size = np.bincount(self.item, minlength=len(ids))
        short = sorted({int(n) for n in self.size if 0 < n < WINDOW})
        # an item shorter than the window has to appear whole
        self.offsets = [*MASKS, *(tuple(range(n)) for n in short)]
        hashes, places, kinds = [], [], []
        for kind, offsets in enumerate(self.offsets):
            at, found = _seeds(self.words, self.item, offsets, kind)
            fits = self.size[self.item[at]] == len(offsets) if kind >= len(MASKS) else self.size[self.item[at]] >= WINDOW
            hashes.append(found[fits])
            places.append(at[fits])
            kinds.append(np.full(fits.sum(), kind))
        order = np.argsort(np.concatenate(hashes), kind="stable")
        self.hashes = np.concatenate(hashes)[order]
        self.places = np.concatenate(places)[order]
        self.bitmap = np.zeros(1 << _FILTER_BITS, bool)
        self.bitmap[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, words: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(mask number, place in the texts, place in the items) of equal seeds."""
        for kind, offsets in enumerate(self.offsets):
            at, found = _seeds(words, text, offsets, kind)
            maybe = self.bitmap[(found >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
            at, found = at[maybe], found[maybe]
            low = np.searchsorted(self.hashes, found, "left")
            many = np.searchsorted(self.hashes, found, "right") - low
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            yield kind, np.repeat(at, many), self.places[np.repeat(low, many) + step]

    def windows(self, words: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Rows (text, item, first word in the texts, first word in the items, length), verified and distinct."""
        found = [np.empty((0, 5), np.int64)]
        for kind, here, there in self.hits(words, text):
            offsets = self.offsets[kind]
            length = WINDOW if kind < len(MASKS) else len(offsets)
            for back in range(length - offsets[-1]):
                a, b = here - back, there - back
                ok = (a >= 0) & (b >= 0) & (a + length <= len(words)) & (b + length <= len(self.words))
                a, b = a[ok], b[ok]
                ok = (text[a] == text[a + length - 1]) & (self.item[b] == self.item[b + length - 1])
                a, b = a[ok], b[ok]
                equal = sum((words[a + k] == self.words[b + k]).astype(np.int64) for k in range(length)) if len(a) else np.empty(0)
                ok = equal >= length - (SUBSTITUTIONS if length == WINDOW else 0)
                a, b = a[ok], b[ok]
                found.append(np.stack([text[a], self.item[b], a, b, np.full(len(a), length)], 1))
        return np.unique(np.concatenate(found), axis=0)


def _summaries(test: TestSet, texts: list[str | None]) -> list[list[dict]]:
    """Per text, one entry for each item that occurs in it."""
    words, text = _words(texts)
    rows = test.windows(words, text)
    entries: list[list[dict]] = [[] for _ in texts]
    if not len(rows):
        return entries
    begins = np.searchsorted(text, np.arange(len(texts)))
    cuts = np.flatnonzero((np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)) + 1
    for group in np.split(rows, cuts):
        t, item = int(group[0, 0]), int(group[0, 1])
        covered = np.unique(np.concatenate([np.arange(a, a + n) for a, n in zip(group[:, 2], group[:, 4])])) - begins[t]
        entries[t].append(
            {
                "item_id": test.ids[item], "n_windows": len(group), "n_words": len(covered),
                "first_word": int(covered[0]), "last_word": int(covered[-1]),
            }
        )
    return entries


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    carry: tuple[str, ...] | None = None,
    slice_bytes: int = 8 << 20,
) -> DataFrame:
    """Find items of a benchmark in every whole text, without a shuffle of the texts.

    Columns: ``record`` (struct of the ``carry`` columns, default all) and ``hits``, an array
    of (item_id, n_windows, n_words, first_word, last_word) with one entry per item found;
    clean documents have an empty array. Items shorter than the window have to
    appear whole. Null and empty texts or items match nothing. A repeated item is reported
    once per row of the benchmark; repeated documents each get their hits.

    The items travel to the tasks in slices of at most ``slice_bytes`` of text (or
    one longer item), so a benchmark of any size costs one pass over the texts per slice and
    never more memory.
    """
    items = benchmark.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, math.ceil(2 * volume / slice_bytes)) if volume > slice_bytes else 1
    entry = T.StructType(
        [
            items.schema.fields[0],
            *(T.StructField(n, T.IntegerType()) for n in ("n_windows", "n_words", "first_word", "last_word")),
        ]
    )
    rows = docs.select(
        F.struct(*[F.col(c) for c in (carry or docs.columns)]).alias("record"), F.col(text).alias("text"),
        F.array().cast(T.ArrayType(entry)).alias("hits"),
    )
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).collect()
        rows = _scan(rows, TestSet([r["item_id"] for r in part], [r["text"] for r in part]))
    return rows.select("record", "hits")


def _scan(rows: DataFrame, test: TestSet) -> DataFrame:
    hits_type = to_arrow_schema(rows.select("hits").schema).field("hits").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                part = whole.slice(start, _ROWS)
                earlier = part.column(2).to_pylist()
                found = [old + new for old, new in zip(earlier, _summaries(test, part.column(1).to_pylist()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, hits_type)], ["record", "text", "hits"])

    return rows.mapInArrow(tidy(run), rows.schema)
