"""Language-model scores from a causal self-attention model trained in numpy on subword ids.

A token (a word, or the end of a text) is a sequence of subword ids. The model reads the
first and last id of the tokens before, one input row for each id, and predicts the next
token's first id on two levels, its class and the id inside the class; attention looks back
inside windows that overlap, so each token is scored once and, past the start of a text,
always with some context. Behind its first id a token has the share of its corpus count,
smoothed by a subword model for tokens that are rare or unseen:

    P(token | before) = P(class | before) * P(first | class, before)
                        * (count + a * P(later ids | first)) / (count of first + a)

where a is the number of tokens with this first id seen once. First ids that no training text
has share what their class keeps for new ones. These are probabilities of whole texts.
Counts come from all training texts; the weights are trained in parallel on all their
windows and averaged after every round, each input row by how often it was trained.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renown.llm.superkmers import from_blob, opened, pack, to_blob
from renown.session import stage

WIDTH, CONTEXT = 32, 8  # tokens of a window; of them, seen again only as context
STRIDE = WIDTH - CONTEXT
DIMS, CLASSES, INPUTS = 16, 128, 512  # INPUTS: input rows at least; a larger vocabulary has one for each unit
ROUNDS, BATCH = 2, 64  # rounds of training, windows of a step
_SHARED = 64  # classes shared by the less frequent ids
_LANE = 8  # positions of one class that the second level works on together


@functools.lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def units(words: list[bytes], path: str, size: int) -> list[np.ndarray]:
    """Subword ids of words; the last id of a word is its word-final twin (2 * id + 1).

    A word without ids (white space the vocabulary drops) is the one unit 2 * size.
    """
    found = _tokenizer(path).encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
    out = []
    for encoding in found:
        ids = 2 * np.array(encoding.ids, np.int32)
        if len(ids):
            ids[-1] += 1
        out.append(ids if len(ids) else np.array([2 * size], np.int32))
    return out


def is_training(key: int | None, fold: int, held: int) -> bool:
    """A null key is read as the empty text."""
    return zlib.crc32(b"" if key is None else str(key).encode()) % fold != held


# counting -------------------------------------------------------------------------------


def _words(fold: int, held: int):
    """Distinct words of a chunk with their count in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, keys, texts = opened(blob.as_py())
                count: Counter[bytes] = Counter()
                for key, text in zip(keys.to_pylist(), texts):
                    words = text.lower().split()
                    if is_training(key, fold, held):
                        count.update(words)
                    else:
                        count.update(dict.fromkeys(words, 0))
                names = list(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(np.full(len(names), chunk)), pa.array(list(count.values()), pa.int64())], ["word", "chunk", "n"]
                )

    return run


def _cut_up(path: str, size: int, held_rows: int = 400_000):
    """Add the units to rows sorted by word, each word cut up once, and pack them by chunk."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        chunk = table.column("chunk").to_numpy()
        order = np.argsort(chunk, kind="stable")
        table = table.drop_columns("chunk").take(pa.array(order))
        chunks, starts = np.unique(chunk[order], return_index=True)
        blobs = [to_blob(table.slice(a, b - a)) for a, b in zip(starts, np.append(starts[1:], len(order)))]
        return pa.RecordBatch.from_arrays([pa.array(chunks), pa.array(blobs, pa.binary())], ["chunk", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for whole in batches:
            for start in range(0, whole.num_rows, 8192):
                batch = whole.slice(start, 8192)
                coded = batch.column(0).dictionary_encode()
                parts = units(coded.dictionary.to_pylist(), path, size)
                names = pa.array([p.tobytes() for p in parts], pa.binary())
                held.append(pa.RecordBatch.from_arrays([*batch.columns, names.take(coded.indices)], [*batch.schema.names, "units"]))
                rows += batch.num_rows
                if rows >= held_rows:
                    yield packed(held)
                    held, rows = [], 0
        if held:
            yield packed(held)

    return run


def _joined(fold: int, held: int):
    """The texts of a chunk as numbers of its words, looked up here once for all passes, and beside them its vocabulary."""

    def run(texts: pa.Table, packed: pa.Table) -> pa.Table:
        chunk, blob = texts.column("chunk")[0].as_py(), texts.column("blob")[0].as_py()
        words = pa.concat_tables([_NO_WORDS, *(from_blob(b) for b in packed.column("words").to_pylist())]).combine_chunks()
        count, mine = words.column("count"), words.column("mine")
        vocabulary = pa.table([count, mine, words.column("units")], ["count", "mine", "units"])
        new = int((mine.to_numpy(zero_copy_only=False) & (count.to_numpy() > 0)).sum())
        _, keys, found = opened(blob)
        ends = sum(is_training(k, fold, held) for k in keys.to_pylist())
        tokens = int(words.column("n").to_numpy().sum()) + ends
        number = {w: i for i, w in enumerate(words.column("word").to_pylist())}
        numbers = [np.fromiter(map(number.__getitem__, text.lower().split()), np.int32) for text in found]
        start = np.concatenate([[0], np.cumsum([len(x) for x in numbers])]).astype(np.int64)
        numbered = pa.LargeListArray.from_arrays(pa.array(start), pa.array(np.concatenate(numbers)))
        coded = pa.table([keys, pa.array([len(text) for text in found], pa.int64()), numbered], ["key", "bytes", "words"])
        row = [[chunk], [to_blob(coded)], [to_blob(vocabulary)], [new], [tokens], [ends]]
        return pa.table(row, _JOINED)

    return run


_NO_WORDS = pa.table(
    [[]] * 5, pa.schema([("word", pa.binary()), ("n", pa.int64()), ("count", pa.int64()), ("mine", pa.bool_()), ("units", pa.binary())])
)
_JOINED = pa.schema([("chunk", pa.int64()), ("blob", pa.binary()), ("vocabulary", pa.binary()), ("new", pa.int64()), ("tokens", pa.int64()), ("ends", pa.int64())])


@dataclass
class Vocabulary:
    """Words of one chunk with their units laid end to end."""

    count: np.ndarray
    mine: np.ndarray
    flat: np.ndarray
    start: np.ndarray

    @classmethod
    def read(cls, blob: bytes) -> Vocabulary:
        table = from_blob(blob)
        parts = table.column("units").cast(pa.large_binary()).combine_chunks()
        start = np.concatenate([[0], np.cumsum(pc.binary_length(parts).to_numpy() // 4)]).astype(np.int64)
        _, offsets, data = parts.buffers()
        low = np.frombuffer(offsets, np.int64)[parts.offset] // 4 if start[-1] else 0
        flat = np.frombuffer(data, np.int32)[low : low + start[-1]] if start[-1] else np.empty(0, np.int32)
        return cls(table.column("count").to_numpy(), table.column("mine").to_numpy(zero_copy_only=False), flat, start)


def _unit_counts(size: int):
    """Counts over the words a chunk is the first to have: (code, n) with code = row * units + unit.

    Row 0: first units; 1: first units of words seen once; 2: first units of distinct words;
    3 + p: later units of distinct words behind the unit p. Every distinct word of the corpus
    is met once. Spelling is learnt from distinct words, because it has to serve the rare ones.
    """
    width = 2 * size + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                v = Vocabulary.read(blob.as_py())
                weight = np.where(v.mine, v.count, 0)
                first = v.start[:-1]
                later = np.ones(len(v.flat), bool)
                later[first] = False
                at = np.flatnonzero(later)
                head, tail = v.flat[first].astype(np.int64), v.flat[at]
                code = np.concatenate([codes, head, width + head, 2 * width + head, (3 + v.flat[at - 1].astype(np.int64)) * width + tail])
                n = np.concatenate([sums, weight, weight == 1, weight > 0, np.repeat(weight > 0, np.diff(v.start))[at]])
                codes, inverse = np.unique(code[n > 0], return_inverse=True)
                sums = np.bincount(inverse, weights=n[n > 0], minlength=len(codes)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], ["code", "n"])

    return run


@dataclass
class Counts:
    """Corpus counts of units and what follows from them; all arrays are bounded by the vocabulary file."""

    tokens: int
    distinct: int
    ends: int
    klass: np.ndarray  # class of a first unit
    slot: np.ndarray  # output row of a first unit on the second level, -1 where there is none
    block: np.ndarray  # the output rows of class c are block[c]..block[c + 1]
    first: np.ndarray  # log10 of what the second level leaves a first unit: all for own classes, else the part of seen or one of unseen ones
    pair: np.ndarray  # sorted codes of (unit before, later unit) that occur
    behind: np.ndarray  # log10 share of the later unit behind the one before, for each of them
    alone: np.ndarray  # log10 share among all later units
    back: np.ndarray  # log10 weight of that share behind each unit
    klass_count: np.ndarray
    unit_count: np.ndarray
    once: np.ndarray

    @classmethod
    def of(cls, code: np.ndarray, n: np.ndarray, width: int, tokens: int, distinct: int, ends: int) -> Counts:
        row, unit = code // width, code % width
        end = width - 1
        first, single = (np.bincount(unit[row == r], weights=n[row == r], minlength=width) for r in (0, 1))
        order = np.argsort(-first, kind="stable")
        order = order[order != end]
        first[end] = ends
        own = CLASSES - 1 - _SHARED
        klass = np.empty(width, np.int64)
        klass[order[:own]] = np.arange(own)
        klass[order[own:]] = own + np.arange(len(order) - own) % _SHARED
        klass[end] = CLASSES - 1
        klass_count = np.bincount(klass, weights=first, minlength=CLASSES)
        # second level: an output row for each seen unit of a shared class, laid out by class
        shared = (klass >= own) & (klass < CLASSES - 1)
        seen, unseen = shared & (first > 0), shared & (first == 0)
        rows = np.flatnonzero(seen)
        rows = rows[np.argsort(klass[rows], kind="stable")]
        slot = np.full(width, -1, np.int64)
        slot[rows] = np.arange(len(rows))
        block = np.concatenate([[0], np.cumsum(np.bincount(klass[rows], minlength=CLASSES))])
        rest = np.bincount(klass[unseen], minlength=CLASSES)
        new = np.bincount(klass[shared & (first == 1)], minlength=CLASSES) + 1.0
        new = np.where(rest > 0, new / (klass_count + new), 0.0)
        fixed = np.zeros(width)
        fixed[seen] = np.log10(1 - new[klass[seen]])
        fixed[unseen] = np.log10(new[klass[unseen]] / rest[klass[unseen]])
        # later units behind the unit before, backed off to their overall share as often as new ones follow
        seen = row > 2
        before, unit, n = row[seen] - 3, unit[seen], n[seen]
        alone = np.bincount(unit, weights=n, minlength=width) + 0.1
        alone /= alone.sum()
        follow = np.bincount(before, weights=n, minlength=width)
        kinds_after = np.bincount(before, minlength=width) + 1.0
        order = np.argsort(before * width + unit)
        before, unit, n = before[order], unit[order], n[order]
        behind = (n + kinds_after[before] * alone[unit]) / (follow[before] + kinds_after[before])
        return cls(
            tokens, distinct, ends, klass, slot, block, fixed,
            before * width + unit, np.log10(behind), np.log10(alone), np.log10(kinds_after / (follow + kinds_after)),
            klass_count, first, single + 1.0,
        )

    def classes(self, v: Vocabulary) -> np.ndarray:
        """Class of every word: that of its first unit."""
        return self.klass[v.flat[v.start[:-1]]]

    def slots(self, v: Vocabulary) -> np.ndarray:
        """Output row of every word on the second level: that of its first unit."""
        return self.slot[v.flat[v.start[:-1]]]

    def inside(self, v: Vocabulary) -> np.ndarray:
        """log10 of the part of every word that both levels of the model leave open."""
        first = v.flat[v.start[:-1]]
        step = np.zeros(len(v.flat))
        if len(step):
            before, unit = v.flat[:-1].astype(np.int64), v.flat[1:]
            step[1:] = self.back[before] + self.alone[unit]
            if len(self.pair):
                code = before * len(self.klass) + unit
                at = np.minimum(np.searchsorted(self.pair, code), len(self.pair) - 1)
                step[1:] = np.where(self.pair[at] == code, self.behind[at], step[1:])
        step[v.start[:-1]] = 0
        sums = np.concatenate([[0.0], np.cumsum(step)])
        spelled = sums[v.start[1:]] - sums[v.start[:-1]]
        return self.first[first] + np.log10((v.count + self.once[first] * 10.0**spelled) / (self.unit_count[first] + self.once[first]))

    def base(self, count: np.ndarray | int) -> np.ndarray:
        return np.log10((count + 1.0) / (self.tokens + self.distinct + 1.0))


# the model ------------------------------------------------------------------------------

_SHAPES = {"first": (INPUTS, DIMS), "last": (INPUTS, DIMS), "mix": (DIMS, 3 * DIMS), "near": (WIDTH,), "out": (DIMS, CLASSES), "bias": (CLASSES,)}
_BACK = np.subtract.outer(np.arange(WIDTH), np.arange(WIDTH))
_CAUSAL = _BACK >= 0


def unflat(weights: np.ndarray) -> dict[str, np.ndarray]:
    found, at = {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        found[name] = weights[at : at + size].reshape(shape)
        at += size
    return found


_TABLES = ("first", "last")  # weights of which a step touches few rows


def initial(counts: Counts, seed: int = 5) -> dict[str, np.ndarray]:
    """Small random weights; both biases start at the frequencies. "fine" and "level" are the second level."""
    rng = np.random.default_rng(seed)
    inputs = (max(INPUTS, len(counts.klass) + 1), DIMS)
    shapes = _SHAPES | {"first": inputs, "last": inputs, "fine": (counts.block[-1], DIMS), "level": (counts.block[-1],)}
    w = {name: rng.standard_normal(shape) * 0.1 for name, shape in shapes.items()}
    w["near"] *= 0
    w["bias"] = np.log(counts.klass_count + 0.5) - np.log((counts.klass_count + 0.5).sum())
    has = counts.slot >= 0
    w["level"][counts.slot[has]] = np.log(counts.unit_count[has])
    w["level"] -= np.repeat([w["level"][a:b].max() for a, b in zip(counts.block[:-1], counts.block[1:]) if b > a], (n := np.diff(counts.block))[n > 0])
    return {name: value.astype(np.float32) for name, value in w.items()}


def forward(w: dict[str, np.ndarray], first: np.ndarray, last: np.ndarray, at: np.ndarray | slice = slice(None)) -> dict[str, np.ndarray]:
    """Masked attention over a batch of windows (rows) of input ids; "hidden" and "logits" are those of the positions ``at``."""
    n = len(first)
    x = w["first"][first] + w["last"][last]
    three = (x.reshape(-1, DIMS) @ w["mix"]).reshape(n, WIDTH, 3, DIMS)
    q, k, v = (np.ascontiguousarray(three[:, :, i]) for i in range(3))
    seen = np.matmul(q, k.transpose(0, 2, 1))
    seen *= DIMS**-0.5
    seen += w["near"][np.maximum(_BACK, 0)]
    np.minimum(seen, 40.0, out=seen)
    np.exp(seen, out=seen)
    seen *= _CAUSAL  # nothing, not next to nothing: products of next to nothing are denormal and many times as slow
    seen /= seen.sum(2, keepdims=True)
    hidden = np.matmul(seen, v)
    hidden += x
    hidden = hidden.reshape(-1, DIMS)[at]
    logits = hidden @ w["out"]
    logits += w["bias"]
    return {"x": x, "q": q, "k": k, "v": v, "seen": seen, "hidden": hidden, "logits": logits}


def log_shares(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of the target classes."""
    logits = np.clip(logits, -60.0, 60.0)
    found = logits[np.arange(len(target)), target]
    np.exp(logits, out=logits)
    return found - np.log(logits.sum(1))


@dataclass
class Lanes:
    """Positions with a second level, by class in lanes of ``_LANE``; a lane holds all output rows of its class."""

    at: np.ndarray  # positions in the order of their classes
    cell: np.ndarray  # their places in the lanes, laid end to end
    rows: np.ndarray  # output rows of each lane, padded to the longest class
    real: np.ndarray  # which of them are no padding
    place: np.ndarray  # which of its lane's rows a position aims at
    heads: np.ndarray  # first lane of each class

    @classmethod
    def of(cls, target: np.ndarray, slot: np.ndarray, block: np.ndarray) -> Lanes:
        at = np.flatnonzero(slot >= 0)
        at = at[np.argsort(target[at], kind="stable")]
        many = np.bincount(target[at], minlength=len(block) - 1)
        lanes = -(-many // _LANE)
        before = np.cumsum(lanes) - lanes
        klass = np.repeat(np.arange(len(many)), lanes)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        rows = block[klass][:, None] + np.arange(np.diff(block).max(initial=0))
        real = rows < block[klass + 1][:, None]
        low = block[target[at]]
        return cls(at, np.repeat(before, many) * _LANE + turn, np.where(real, rows, 0), real, slot[at] - low, before[many > 0])

    def laid(self, values: np.ndarray) -> np.ndarray:
        """Rows of the positions in their lanes, 0 in cells without one."""
        found = np.zeros((len(self.rows) * _LANE, values.shape[1]), values.dtype)
        found[self.cell] = values[self.at]
        return found.reshape(len(self.rows), _LANE, -1)

    def by_class(self, values: np.ndarray) -> np.ndarray:
        """Sums over the lanes of each class."""
        sums = values[self.heads]
        many = np.diff(self.heads, append=len(values))
        for turn in range(1, many.max()):
            more = np.flatnonzero(many > turn)
            sums[more] += values[self.heads[more] + turn]
        return sums


def fine_shares(w: dict[str, np.ndarray], block: np.ndarray, hidden: np.ndarray, target: np.ndarray, slot: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """Natural log probability of the first unit in its class; 0 where the class is one unit."""
    found = np.zeros(len(target))
    lanes = Lanes.of(target, np.where(counted, slot, -1), block)
    if len(lanes.at):
        logits = np.matmul(lanes.laid(hidden), w["fine"][lanes.rows].transpose(0, 2, 1))
        logits += w["level"][lanes.rows][:, None]
        np.clip(logits, -60.0, 60.0, out=logits)
        aim = logits.reshape(-1, logits.shape[2])[lanes.cell, lanes.place]
        np.exp(logits, out=logits)
        logits *= lanes.real[:, None]
        found[lanes.at] = aim - np.log(logits.sum(2).ravel()[lanes.cell])
    return found


def gradients(
    w: dict[str, np.ndarray], first: np.ndarray, last: np.ndarray, target: np.ndarray, counted: np.ndarray,
    slot: np.ndarray | None = None, block: np.ndarray | None = None,
) -> dict:
    """Gradient of the mean loss over the counted positions; that of a table is (rows, gradient of these rows)."""
    n, at = len(first), np.flatnonzero(counted)
    f = forward(w, first, last, at)
    hidden, p = f["hidden"], f["logits"]
    target = target.ravel()[at]
    one = p.dtype.type(1 / max(1, len(at)))
    if p.size and max(p.max(), -p.min()) > 60:
        p -= p.max(1, keepdims=True)
    np.exp(p, out=p)
    p *= one / p.sum(1, keepdims=True)
    p[np.arange(len(at)), target] -= one
    some = p @ w["out"].T
    grads = {"out": hidden.T @ p, "bias": p.sum(0)}
    if slot is not None:
        grads |= {"fine": np.zeros_like(w["fine"]), "level": np.zeros_like(w["level"])}
        lanes = Lanes.of(target, slot.ravel()[at], block)
        if len(lanes.at):
            h, fine = lanes.laid(hidden), w["fine"][lanes.rows]
            inner = np.matmul(h, fine.transpose(0, 2, 1))
            inner += np.where(lanes.real, w["level"][lanes.rows], -np.inf)[:, None]
            inner -= inner.max(2, keepdims=True)
            np.exp(inner, out=inner)
            scale = np.zeros((len(lanes.rows) * _LANE, 1), p.dtype)
            scale[lanes.cell] = one
            inner *= scale.reshape(-1, _LANE, 1) / inner.sum(2, keepdims=True)
            inner.reshape(len(scale), -1)[lanes.cell, lanes.place] -= one
            rows, real = lanes.rows[lanes.heads], lanes.real[lanes.heads]
            grads["fine"][rows[real]] = lanes.by_class(np.matmul(inner.transpose(0, 2, 1), h))[real]
            grads["level"][rows[real]] = lanes.by_class(inner.sum(1))[real]
            some[lanes.at] += np.matmul(inner, fine).reshape(-1, DIMS)[lanes.cell]
    dh = np.zeros((n * WIDTH, DIMS), some.dtype)
    dh[at] = some
    dh = dh.reshape(n, WIDTH, DIMS)
    dseen = np.matmul(dh, f["v"].transpose(0, 2, 1))
    dv = np.matmul(f["seen"].transpose(0, 2, 1), dh)
    ds = f["seen"] * (dseen - (dseen * f["seen"]).sum(2, keepdims=True))
    grads["near"] = np.bincount(_BACK[_CAUSAL], weights=ds.sum(0)[_CAUSAL], minlength=WIDTH)
    ds *= DIMS**-0.5
    three = np.stack([np.matmul(ds, f["k"]), np.matmul(ds.transpose(0, 2, 1), f["q"]), dv], 2).reshape(-1, 3 * DIMS)
    dx = dh.reshape(-1, DIMS) + three @ w["mix"].T
    grads["mix"] = f["x"].reshape(-1, DIMS).T @ three
    for name, ids in zip(_TABLES, (first, last)):
        # sorting numbers of (id, place) is several times as fast as a stable argsort
        rows, order = np.divmod(np.sort(ids.ravel() * ids.size + np.arange(ids.size)), ids.size)
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        grads[name] = rows[starts], np.add.reduceat(dx[order], starts)
    return grads


def gradient(w: dict[str, np.ndarray], first: np.ndarray, last: np.ndarray, target: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """Gradient of the first level, laid end to end."""
    grads = gradients(w, first, last, target, counted)
    for name in _TABLES:
        rows, some = grads[name]
        grads[name] = np.zeros(w[name].shape, np.float32)
        grads[name][rows] = some
    return np.concatenate([np.asarray(grads[name], np.float32).ravel() for name in _SHAPES])


class Adam:
    """Steps of all weights; in tables only the rows that a step touches move, each with its own count of steps."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float = 0.01) -> None:
        self.weights, self.rate = {name: value.copy() for name, value in weights.items()}, rate
        self.mean, self.square = ({name: np.zeros_like(value) for name, value in weights.items()} for _ in range(2))
        self.steps, self.touched = 0, {name: np.zeros(len(weights[name]), np.int64) for name in _TABLES}

    def step(self, grads: dict) -> None:
        self.steps += 1
        for name, grad in grads.items():
            rows, steps = slice(None), self.steps
            if name in _TABLES:
                rows, grad = grad
                self.touched[name][rows] += 1
                steps = self.touched[name][rows][:, None]
            mean = self.mean[name][rows] + 0.1 * (grad - self.mean[name][rows])
            square = self.square[name][rows] + 0.01 * (grad * grad - self.square[name][rows])
            self.mean[name][rows], self.square[name][rows] = mean, square
            self.weights[name][rows] -= self.rate / (1 - 0.9**steps) * mean / (np.sqrt(square / (1 - 0.99**steps)) + 1e-8)


def to_rows(weights: dict[str, np.ndarray]) -> np.ndarray:
    """All weights as rows of DIMS numbers: the two tables, then the others end to end."""
    rest = np.concatenate([weights[name].ravel() for name in sorted(weights) if name not in _TABLES])
    rest = np.pad(rest, (0, -len(rest) % DIMS)).reshape(-1, DIMS)
    return np.concatenate([*(weights[name] for name in _TABLES), rest])


def of_rows(rows: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Weights shaped like others from their rows."""
    found, at = {}, 0
    for name in _TABLES:
        found[name] = rows[at : at + len(like[name])]
        at += len(like[name])
    rest, at = rows[at:].ravel(), 0
    for name in sorted(set(like) - set(_TABLES)):
        found[name] = rest[at : at + like[name].size].reshape(like[name].shape)
        at += like[name].size
    return found


# texts as positions ---------------------------------------------------------------------


@dataclass
class Positions:
    """Input ids and target classes of texts laid end to end; text t has tokens start[t]..start[t + 1]."""

    first: np.ndarray
    last: np.ndarray
    target: np.ndarray
    start: np.ndarray
    word: np.ndarray  # vocabulary number of the token, -1 for an end
    slot: np.ndarray | None = None  # output row of the token on the second level, -1 for none


def positions(texts: list[np.ndarray], v: Vocabulary, klass: np.ndarray, slots: np.ndarray) -> Positions:
    """Texts are given as vocabulary numbers of their words."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    start = np.concatenate([[0], np.cumsum(lengths)])
    word = np.full(start[-1], -1, np.int64)
    inside = np.ones(start[-1], bool)
    inside[start[1:] - 1] = False
    word[inside] = np.concatenate(texts)
    target = np.where(inside, klass[word] if len(klass) else 0, CLASSES - 1)
    slot = np.where(inside, slots[word] if len(slots) else -1, -1)
    # what a position reads is the token before; the first one reads "start", which is id 0
    first = np.zeros(start[-1], np.int64)
    last = np.zeros(start[-1], np.int64)
    if len(klass):
        first[1:] = np.where(inside[:-1], 1 + v.flat[v.start[:-1]][word[:-1]], 0)
        last[1:] = np.where(inside[:-1], 1 + v.flat[v.start[1:] - 1][word[:-1]], 0)
    return Positions(first, last, target, start, word, slot)


def windows(start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of every window, and the end of its text; the windows of a text overlap by the context."""
    lengths = np.diff(start)
    many = np.maximum(1, -(-(lengths - CONTEXT) // STRIDE))
    step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(start[:-1], many) + STRIDE * step, np.repeat(start[1:], many)


def batches_of(p: Positions) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of windows: their positions, and which of them are scored there and nowhere else."""
    begin, end = windows(p.start)
    opens = np.isin(begin, p.start[:-1])
    for at in range(0, len(begin), BATCH):
        place = begin[at : at + BATCH, None] + np.arange(WIDTH)
        scored = place < end[at : at + BATCH, None]
        scored[~opens[at : at + BATCH], :CONTEXT] = False
        yield np.minimum(place, end[at : at + BATCH, None] - 1), scored


def _opened(batches: Iterator[pa.RecordBatch], counts: Counts, keep: Callable[[int | None], bool], spell: bool):
    for batch in batches:
        for blob, vocabulary in zip(batch.column(0), batch.column(1)):
            v = Vocabulary.read(vocabulary.as_py())
            klass, slots = counts.classes(v), counts.slots(v)
            inside = counts.inside(v) if spell else None
            table = from_blob(blob.as_py())
            keys, numbered = table.column("key").combine_chunks(), table.column("words").combine_chunks()
            start, numbers = numbered.offsets.to_numpy(), numbered.values.to_numpy()
            sizes = table.column("bytes").to_pylist()
            at = [i for i, name in enumerate(keys.to_pylist()) if keep(name)]
            # a few hundred kilobytes of text at a time
            group, size = [], 0
            for i in at:
                group.append(i)
                size += sizes[i]
                if size > 1 << 19:
                    yield v, inside, keys.take(pa.array(group)), positions([numbers[start[j] : start[j + 1]] for j in group], v, klass, slots)
                    group, size = [], 0
            if group:
                yield v, inside, keys.take(pa.array(group)), positions([numbers[start[j] : start[j + 1]] for j in group], v, klass, slots)


def _train(counts: Counts, weights: dict[str, np.ndarray], turn: int, fold: int, held: int):
    """Train on every window of the training texts of a task; rows (place, steps, numbers * steps) of what moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Adam(weights, 0.01 / (1 + turn))
        for _, _, _, p in _opened(batches, counts, lambda key: is_training(key, fold, held), False):
            for place, scored in batches_of(p):
                model.step(gradients(model.weights, p.first[place], p.last[place], p.target[place], scored, p.slot[place], counts.block))
        if model.steps:
            rows = to_rows(model.weights)
            tables = np.concatenate([model.touched[name] for name in _TABLES])
            steps = np.concatenate([tables, np.full(len(rows) - len(tables), model.steps)])
            for at in np.array_split(np.flatnonzero(steps), 1 + len(rows) // 8192):
                value = rows[at].astype(np.float64) * steps[at, None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(steps[at]), *(pa.array(np.ascontiguousarray(value[:, k])) for k in range(DIMS))],
                    ["place", "steps", *_NUMBERS],
                )

    return run


_NUMBERS = [f"v{k}" for k in range(DIMS)]


def _score(counts: Counts, w: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end_share = counts.base(counts.ends)
        for v, inside, keys, p in _opened(batches, counts, lambda key: True, True):
            logs = np.zeros(len(p.target))
            for place, scored in batches_of(p):
                f = forward(w, p.first[place], p.last[place], np.flatnonzero(scored))
                at = place[scored]
                found = log_shares(f["logits"], p.target[at])
                logs[at] = found + fine_shares(w, counts.block, f["hidden"], p.target[at], p.slot[at], np.ones(len(at), bool))
            logs /= np.log(10)
            word = p.word >= 0
            logs[word] += inside[p.word[word]]
            base, known = counts.base(v.count), v.count > 0
            texts = np.repeat(np.arange(len(keys)), np.diff(p.start))
            total = lambda values: np.bincount(texts[word], weights=values, minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    keys, pa.array(np.diff(p.start)), pa.array(total(known[p.word[word]]).astype(np.int64) + int(counts.ends > 0)),
                    pa.array(total(base[p.word[word]]) + end_share), pa.array(np.bincount(texts, weights=logs, minlength=len(keys))),
                ],
                ["key", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def score_texts(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", fold: int = 7, held: int = 2, chunk_bytes: int = 8 << 20
) -> DataFrame:
    """Score every whole text; learn from those whose crc32(key as text) mod ``fold`` is not ``held``.

    Columns: the key (as a long), ``held_out``, ``n_tokens`` (words and one end), ``n_known``
    (tokens seen in training), ``train_tokens``, ``base_score`` (log10 under add-one unigram counts
    over all training tokens) and ``score`` (log10 under the model). Words are runs outside
    ASCII white space with A-Z lowered. A null text is empty and has its end only; a null key
    hashes as the empty text. Repeated rows are separate texts. Without training texts all
    counts are 0 and both scores stay finite; an empty table gives no rows.

    ``vocabulary`` is the path of a tokenizer file for the subword ids. Word counts are summed over
    the corpus and come back to the chunks that have the word, so no task or driver holds
    them all; unit counts and weights are bounded by the vocabulary and the model.
    """
    import json

    with open(vocabulary, encoding="utf-8") as file:
        spec = json.load(file)
    size = 1 + max(*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]))
    chunks = pack(docs, key, text, chunk_bytes)
    same = Window.partitionBy("word")
    counted = (
        chunks.mapInArrow(_words(fold, held), "word binary, chunk long, n long")
        .withColumn("count", F.sum("n").over(same)).withColumn("mine", F.col("chunk") == F.min("chunk").over(same))
        .mapInArrow(_cut_up(vocabulary, size), "chunk long, words binary")
    )
    joined = stage(
        chunks.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(
            _joined(fold, held), "chunk long, blob binary, vocabulary binary, new long, tokens long, ends long"
        ),
        "lm-chunks",
    )
    new, tokens, ends = (int(x or 0) for x in joined.agg(F.sum("new"), F.sum("tokens"), F.sum("ends")).first())
    sums = joined.select("vocabulary").mapInArrow(_unit_counts(size), "code long, n long")
    table = sums.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n = (table.column(c).to_numpy() for c in ("code", "n"))
    counts = Counts.of(code, n, 2 * size + 2, tokens, new + (ends > 0), ends)
    weights = initial(counts)
    for turn in range(ROUNDS):
        schema = ", ".join(["place long", "steps long", *(f"{c} double" for c in _NUMBERS)])
        moved = joined.select("blob", "vocabulary").mapInArrow(_train(counts, weights, turn, fold, held), schema)
        mean = moved.groupBy("place").agg(*((F.sum(c) / F.sum("steps")).cast("float").alias(c) for c in _NUMBERS)).toArrow()
        rows = to_rows(weights)
        rows[mean.column("place").to_numpy()] = np.stack([mean.column(c).to_numpy() for c in _NUMBERS], 1)
        weights = of_rows(rows, weights)
    scored = joined.select("blob", "vocabulary").mapInArrow(
        _score(counts, weights), "key long, n_tokens long, n_known long, base_score double, score double"
    )
    held_out = F.pmod(F.crc32(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary")), F.lit(fold)) == held
    return scored.select(
        F.col("key").alias(key), held_out.alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
