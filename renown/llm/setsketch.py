"""Near duplicates with SetSketch registers.

A document is the set of its word shingles. A register keeps the smallest of exponential
variates of the elements on a logarithmic scale: K = floor(1 - log_b(min)). Registers of a
union are the larger ones, and two sets agree in a register about as often as their elements
agree, so bands of registers find candidates. The joint likelihood of the counts of larger,
equal and smaller registers, given both set sizes, estimates the similarity; promising
pairs are then verified on the full sets.

Documents with equal sets are one class. In a band only pairs with the class at its head are
tried at first. Whatever that leaves unconnected meets the rest of its band in blocks, so a
crowd of near copies neither yields all its pairs nor loses a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renown.llm.components import components
from renown.llm.hashing import Buffer, mix
from renown.llm.memory import tidy
from renown.session import stage

REGISTERS, PER_BAND = 128, 4
BANDS = REGISTERS // PER_BAND
# base, rate and top value of the registers: the scale holds sets of up to 10**20 elements
_B, _A, _Q = 1.001, 20.0, (1 << 16) - 2
# the share of equal registers deviates by 0.035 at 0.8; over six times that is let through to the verification
MARGIN = 0.22

_ROWS = 256
_MULTIPLIERS = (mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def registers(elements: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit element hashes."""
    low = (elements >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, (1 << 32) - 1, np.uint32)
    for start in range(0, len(low), 512):
        least = np.minimum(least, (low[start : start + 512, None] * _MULTIPLIERS).min(0))
    value = -np.log1p(-(least + 0.5) / 2.0**32) / _A
    return np.clip(np.floor(1 - np.log(value) / np.log(_B)), 0, _Q + 1).astype(np.uint16)


def merge(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(left, right)


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (_B - 1) / _B) / np.log(_B)


def similarity(above: np.ndarray, below: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, steps: int = 128) -> np.ndarray:
    """Most likely Jaccard similarity, from how often the left register is above and below the right one."""
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    grid = top * np.linspace(0, 1, steps + 1)
    up, down = (np.maximum(_share(np.maximum(x, 0)), 1e-9) for x in (u - v * grid, v - u * grid))
    same = np.maximum(1 - up - down, 1e-9)
    above, below = above[:, None], below[:, None]
    likely = above * np.log(up) + below * np.log(down) + (REGISTERS - above - below) * np.log(same)
    return np.take_along_axis(grid, likely.argmax(1)[:, None], 1)[:, 0]


def _shingles(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text: n words each, or all words where there are fewer."""
    buffer = Buffer([(t or "").encode() for t in texts], lower=True)
    start, end, text = buffer.words()
    words = buffer.hashes(start, end)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    factors = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        total += words[k : k + len(total)] * factors[k]
    total = mix(total)
    found = []
    for low, high in zip(first[:-1], first[1:]):
        if high - low >= n:
            found.append(np.unique(total[low : high - n + 1]))
        elif high > low:
            found.append(mix((words[low:high] * factors[: high - low]).sum(dtype=np.uint64, keepdims=True) + np.uint64(high - low)))
        else:
            found.append(np.empty(0, np.uint64))
    return found


def _class_of(elements: np.ndarray) -> bytes | None:
    """128-bit name of a set; equal sets and no others share it."""
    if not len(elements):
        return None
    sums = [mix(elements ^ np.uint64(salt)).sum(dtype=np.uint64) for salt in (0x5BF03635, 0x27D4EB2F165667C5)]
    return b"".join(int(mix(s[None] + np.uint64(len(elements)))[0]).to_bytes(8, "big") for s in sums)


def sketches(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Rows (key, tie, n_shingles, class, sketch); class and sketch are null for empty sets."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    schema = T.StructType(
        [*rows.schema.fields[:2], T.StructField("n_shingles", T.LongType()), T.StructField("class", T.BinaryType()), T.StructField("sketch", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                part = whole.slice(start, _ROWS)
                sets = _shingles(part.column(2).to_pylist(), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_class_of(s) for s in sets], pa.binary()),
                        pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["key", "tie", "n_shingles", "class", "sketch"],
                )

    return rows.mapInArrow(tidy(run), schema)


def _bands(classes: DataFrame) -> DataFrame:
    """One row per class and band; the band's value is its registers as they are."""
    width = 2 * PER_BAND
    values = F.array(*[F.substring("sketch", 1 + k * width, width) for k in range(BANDS)])
    return classes.select("class", F.posexplode(values).alias("band", "value"))


def _estimates(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, steps: int = 128) -> np.ndarray:
    return similarity((left > right).sum(1), (left < right).sum(1), n_left, n_right, steps)


def _registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _likely(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, sketches and sizes) whose estimate reaches ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                part = whole.slice(start, 4096)
                a, b, sa, sb, na, nb = part.columns
                good = _estimates(_registers_of(sa), _registers_of(sb), na.to_numpy().astype(float), nb.to_numpy().astype(float)) >= least
                yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(good))

    return pairs.select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b").mapInArrow(tidy(run), "a binary, b binary")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                part = whole.slice(start, _ROWS)
                # a text that stands in many pairs of the batch is taken apart once
                distinct = {}
                for name, value in zip(part.column(0).to_pylist() + part.column(1).to_pylist(), part.column(2).to_pylist() + part.column(3).to_pylist()):
                    distinct.setdefault(name, value)
                sets = dict(zip(distinct, _shingles(list(distinct.values()), n)))
                good = []
                for a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    good.append(100 * both >= percent * (len(sets[a]) + len(sets[b]) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(tidy(run), "a binary, b binary")


def _leftover(members: DataFrame, details: DataFrame, n: int, least: float, percent: int, block_rows: int = 256) -> DataFrame:
    """Verified links across components among the members (band, value, class, component) of the bands.

    ``details`` holds (class, sketch, n, text). The members of a band form blocks, large
    components in blocks of their own; blocks meet unless all their members belong
    together already. A pair is tried in its first common band only, the most similar ones
    first, and not at all once links found in the same two blocks connect it. So two blocks
    return at most one link for each component they connect.
    """
    sizes = members.groupBy("band", "value").agg(F.count(F.lit(1)).alias("size"))
    shares = members.groupBy("band", "value", "component").agg(F.count(F.lit(1)).alias("own"))
    # slim rows are dealt to blocks before sketches and texts join them
    dealt = (
        members.join(sizes, ["band", "value"]).join(shares, ["band", "value", "component"])
        .withColumn(
            "block",
            F.when(F.col("own") >= block_rows, F.struct(F.col("component").alias("c"), F.pmod(F.xxhash64("class"), F.ceil(F.col("own") / block_rows)).alias("k")))
            .otherwise(F.struct(F.lit(b"").alias("c"), F.pmod(F.xxhash64("component"), F.ceil(F.col("size") / block_rows)).alias("k"))),
        )
        .join(details, "class")
        .groupBy("band", "value", "block")
        .agg(
            F.collect_list(F.struct("class", "component", "sketch", "n", "text")).alias("rows"),
            F.min("component").alias("low"), F.max("component").alias("high"), F.first("size").alias("size"),
        )
    )
    blocks = stage(dealt, "sketch-blocks")
    alone = blocks.where(F.col("size") <= block_rows)
    many = blocks.where(F.col("size") > block_rows)
    # which blocks meet is found without their rows; these then go to the blocks, not to the band, so
    # a crowded band is spread over as many tasks as it has blocks
    slim = many.select("band", "value", "block", "low", "high")
    other = slim.select("band", "value", *[F.col(c).alias(f"{c}2") for c in ("block", "low", "high")])
    meet = slim.join(other, ["band", "value"]).where(
        (F.col("block") <= F.col("block2")) & ((F.col("low") != F.col("high")) | (F.col("low2") != F.col("high2")) | (F.col("low") != F.col("low2")))
    )
    met = meet.select("band", "value", "block", "block2").join(many.select("band", "value", "block", "rows"), ["band", "value", "block"]).join(
        many.select("band", "value", F.col("block").alias("block2"), F.col("rows").alias("rows2")), ["band", "value", "block2"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, left, right, same in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).to_pylist()):
                links = _links(band, left.values, right.values, same, n, least, percent)
                yield pa.RecordBatch.from_arrays([pa.array([link[k] for link in links], pa.binary()) for k in (0, 1)], ["a", "b"])

    pairs = alone.select("band", "rows", F.col("rows").alias("rows2"), F.lit(True).alias("same"))
    pairs = pairs.unionByName(met.select("band", "rows", "rows2", (F.col("block") == F.col("block2")).alias("same")))
    return pairs.mapInArrow(tidy(run), "a binary, b binary")


def _links(band: int, x: pa.StructArray, y: pa.StructArray, same: bool, n: int, least: float, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between two blocks that connect components, by union and find over the likely pairs."""
    cx, cy = (np.array(v.field("component").to_pylist(), "S16") for v in (x, y))
    sx, sy = _registers_of(x.field("sketch")), _registers_of(y.field("sketch"))
    nx, ny = (v.field("n").to_numpy().astype(float) for v in (x, y))
    close = 100 * np.minimum(nx[:, None], ny[None]) >= percent * np.maximum(nx[:, None], ny[None])
    close &= cx[:, None] != cy[None]
    if same:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    picked, likely = [np.empty((2, 0), np.int64)], [np.empty(0)]
    for start in range(0, len(i), 8192):
        a, b = i[start : start + 8192], j[start : start + 8192]
        equal = sx[a] == sy[b]
        # the share of equal registers nearly is the estimate; what is far off needs no likelihood
        open_ = equal.mean(1) >= least - 0.06
        a, b, equal = a[open_], b[open_], equal[open_]
        first = equal.reshape(-1, BANDS, PER_BAND).all(2).argmax(1) == band
        a, b = a[first], b[first]
        value = _estimates(sx[a], sy[b], nx[a], ny[b], 32)  # a grid of 0.03, well inside the margin
        picked.append(np.stack([a, b])[:, value >= least])
        likely.append(value[value >= least])
    i, j = np.concatenate(picked, 1)
    if not len(i):
        return []
    order = np.argsort(-np.concatenate(likely), kind="stable")
    sets = [_shingles(v.field("text").to_pylist(), n) for v in ((x,) if same else (x, y))]
    left, right = sets[0], sets[-1]
    parent: dict[bytes, bytes] = {}

    def root(c: bytes) -> bytes:
        while (up := parent.get(c, c)) != c:
            parent[c] = parent.get(up, up)
            c = up
        return c

    links, names_x, names_y = [], x.field("class"), y.field("class")
    for at in order.tolist():
        p, q = int(i[at]), int(j[at])
        one, two = root(cx[p]), root(cy[q])
        if one == two:
            continue
        both = len(np.intersect1d(left[p], right[q], assume_unique=True))
        if 100 * both >= percent * (len(left[p]) + len(right[q]) - both):
            parent[one] = two
            links.append((names_x[p].as_py(), names_y[q].as_py()))
    return links


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents linked by 100 * intersection >= percent * union of their shingle sets.

    One row per input row: the key, ``tie`` (hash of the text), ``n_shingles``, ``component_id``
    (smallest key reachable) and ``kept`` (the key is the component's). Words are runs outside
    ASCII white space with A-Z lowered; a text with fewer than ``n`` words is one shingle.
    Null texts, empty texts and texts without words have no shingles, no links and are kept.
    A null key sorts last: it names a component only if no other key is in it. Rows that
    repeat a key and text are one class. An empty table gives no rows.

    Two sets at the limit of 0.85 share no band once in 10**10 pairs, at 0.8 once in
    10**7. By the binomial tail, pairs that are exactly at the limit are estimated too low to be
    verified 4 times in 10**10 at 0.85 and 9 times in 10**9 at 0.8, so bands and estimate together
    lose 4 in 10**10 and 6 in 10**8.
    """
    least = percent / 100 - MARGIN
    rows = stage(sketches(docs, key, text, n), "sketches")
    classes = stage(
        rows.where(F.col("class").isNotNull()).groupBy("class").agg(
            F.min(F.struct(F.col("key").isNull().alias("last"), "key", "tie")).alias("head"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
        ),
        "sketch-classes",
    )
    bands = _bands(classes)
    heads = bands.groupBy("band", "value").agg(F.min("class").alias("a"), F.count(F.lit(1)).alias("many")).where("many > 1").drop("many")
    grouped = stage(bands.join(heads, ["band", "value"]), "sketch-bands")
    star = grouped.where(F.col("a") != F.col("class")).select("a", F.col("class").alias("b")).distinct()
    named = lambda side: classes.select(F.col("class").alias(side), F.col("sketch").alias(f"sketch_{side}"), F.col("n").alias(f"n_{side}"))
    sized = star.join(named("b"), "b").join(named("a"), "a").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    pairs = stage(_likely(sized, least), "sketch-pairs")
    # texts of the classes that share a band with another, one text each
    wanted = classes.join(grouped.select("class").distinct(), "class", "left_semi").select(
        "class", F.col("head.key").alias("_key"), F.col("head.tie").alias("_tie")
    )
    texts = stage(
        docs.select(F.col(key).alias("_k"), F.xxhash64(text).alias("_t"), F.col(text).alias("text"))
        .join(wanted, F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_t") == F.col("_tie")))
        .groupBy("class").agg(F.first("text").alias("text")),
        "sketch-texts",
    )
    links = stage(_verified(pairs, texts, n, percent), "sketch-links")
    label = components(links)
    # the head of a band has been tried with all of it; what is left are pairs of the others
    members = (
        grouped.where(F.col("a") != F.col("class")).select("band", "value", "class")
        .join(label.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    # bands where more than one component meets
    mixed = members.groupBy("band", "value").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    open_ = stage(members.join(mixed.select("band", "value"), ["band", "value"], "left_semi"), "sketch-open")
    details = classes.select("class", "sketch", "n").join(texts, "class")
    found = links.union(stage(_leftover(open_, details, n, least, percent), "sketch-more"))
    final = components(found).withColumnRenamed("node", "class")
    owner = (
        classes.join(final, "class", "left").withColumn("component", F.coalesce("component", "class"))
    )
    smallest = owner.groupBy("component").agg(F.min(F.struct("head.last", "head.key")).alias("least")).select("component", F.col("least.key").alias("component_id"))
    named_classes = owner.join(smallest, "component").select("class", "component_id")
    component = F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return (
        rows.select("key", "tie", "n_shingles", "class").join(named_classes, "class", "left")
        .select(F.col("key").alias(key), "tie", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
    )
