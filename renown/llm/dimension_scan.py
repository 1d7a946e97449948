"""Approximate nearest neighbours by cosine with an adaptive dimension scan.

Vectors are scaled to length one, rotated at random and dealt to the lists of the
nearest centroids. A search probes the lists nearest to the query. Inside a list the
columns are read block by block: after each block the partial distance, scaled
up, is tested against the distance of the k-th best so far, and candidates that exceed
it by more than chance allows are abandoned. Survivors are scored exactly on the
original vectors.

Equal vectors are one entry with their smallest ids, so a vector that fills a third of the
table is one candidate and one query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown.session import stage

_COLUMN_BLOCK = 16
# candidates scanned in full before the first test
_FIRST = 128


def usable(vector: str, key: str) -> Column:
    """Vectors that take part: a key, at least one component, all finite, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.col(key).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means on the sample."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return centres


def probes_for(sample: np.ndarray, centres: np.ndarray, k: int, recall: float, seed: int, asked: int = 256) -> int:
    """The fewest lists that hold the share ``recall`` of the k nearest of sampled queries."""
    rows = np.random.default_rng(seed).permutation(len(sample))[:asked]
    similar = sample[rows] @ sample.T
    similar[np.arange(len(rows)), rows] = -np.inf
    nearest = np.argsort(-similar, axis=1)[:, : min(k, max(1, len(sample) - 1))]
    order = np.argsort(-(sample[rows] @ centres.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    home = (sample @ centres.T).argmax(1)
    needed = np.take_along_axis(place, home[nearest], axis=1)
    return int(np.quantile(needed, recall, method="higher")) + 1


def _unit(raw: np.ndarray, turn: np.ndarray) -> np.ndarray:
    wide = raw.astype(np.float64)
    # scale by the largest component first, so that squares neither overflow nor vanish
    wide /= np.abs(wide).max(1, keepdims=True)
    return ((wide / np.linalg.norm(wide, axis=1, keepdims=True)) @ turn).astype(np.float32)


def cosines(query: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Cosine in double precision on the original vectors."""
    a, b = query.astype(np.float64), raw.astype(np.float64)
    return (b * a).sum(1) / (np.sqrt((b * b).sum(1)) * np.sqrt((a * a).sum()))


def scan(query: np.ndarray, turned: np.ndarray, k: int, chance: float) -> np.ndarray:
    """Places of the candidates that survive the tests; ``turned`` are rotated unit vectors."""
    n, dims = turned.shape
    if n <= max(_FIRST, k):
        return np.arange(n)
    head = ((turned[:_FIRST] - query) ** 2).sum(1)
    limit = np.sqrt(np.partition(head, k - 1)[k - 1])
    alive, partial = np.arange(_FIRST, n), np.zeros(n - _FIRST, np.float32)
    for start in range(0, dims, _COLUMN_BLOCK):
        end = min(dims, start + _COLUMN_BLOCK)
        partial += ((turned[alive, start:end] - query[start:end]) ** 2).sum(1)
        # with all columns read the distance is exact; the slack covers single precision
        slack = 1 + chance / math.sqrt(end) if end < dims else 1 + 1e-3
        keep = np.sqrt(partial * (dims / end)) <= limit * slack + 1e-3
        alive, partial = alive[keep], partial[keep]
    return np.concatenate([np.flatnonzero(head <= (limit * (1 + 1e-3) + 1e-3) ** 2), alive])


def _blocks(rows: DataFrame, block_rows: int, id_type: str) -> DataFrame:
    """Pack rows (list, id, ids, vector) into blocks of a list, at most about ``block_rows`` long."""
    sizes = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    dealt = rows.join(sizes, "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return dealt.groupBy("list", "part").agg(F.collect_list(F.struct("id", "ids", "vector")).alias("rows")).drop("part")


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    recall: float = 0.97,
    sample_rows: int = 16_384,
    chance: float = 2.1,
    block_rows: int = 1024,
    seed: int = 11,
) -> DataFrame:
    """The ``k`` nearest other rows of every row that satisfies ``queries``.

    Columns ``query_id``, ``rank`` (from 1), the key and ``score``; nearest first, ties to the
    smaller key; all other rows where there are fewer than k. Every usable vector is
    indexed. Centroids are fitted on at most ``sample_rows`` vectors, chosen by a hash.
    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor
    do rows with a null key or another length than most. An empty table gives no rows.

    There are about half as many lists as the root of the number of vectors. How many of them a
    query sees is read off the sample: the fewest lists that hold the share ``recall`` of the
    true neighbours of sampled queries. Queries that found fewer than k others there are
    searched again in all lists. Rows meet in blocks of at most about ``block_rows``
    vectors, and each pair of blocks returns k + 1 entries per query.
    """
    spark = vectors.sparkSession
    valid = vectors.where(usable(vector, key)).select(F.col(key).alias("id"), F.col(vector).alias("vector"), queries.alias("asks"))
    length = valid.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dims = length["n"] if length else 1
    valid = valid.where(F.size("vector") == dims)
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    entries = stage(
        valid.withColumn("_place", place).where(F.col("_place") <= k + 1).groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("id"), "ids", "vector"),
        "scan-entries",
    )
    n = entries.count()
    lists = max(1, min(math.isqrt(n) // 2, sample_rows // 8))
    chosen = entries.select("vector", F.xxhash64("id", F.lit(seed)).alias("h"))
    share = min(1.0, sample_rows / max(n, 1))
    sample = chosen.where(F.pmod("h", F.lit(1 << 30)) < F.lit(share * (1 << 30))).orderBy("h").limit(sample_rows).collect()
    turn = rotation(dims, seed)
    unit = _unit(np.array([r["vector"] for r in sample], np.float64), turn) if sample else np.eye(1, dims, dtype=np.float32)
    lists = min(lists, len(unit))
    centres = centroids(unit, lists, seed).astype(np.float32)

    probes = probes_for(unit, centres, k, recall, seed)

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)

    def assign(width: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    near = np.argsort(-(_unit(matrix(batch.column(2)), turn) @ centres.T), axis=1, kind="stable")[:, :width]
                    rows = pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1]))
                    taken = batch.take(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int32)), *taken.columns], ["list", "id", "ids", "vector"])

        return run

    listed = f"list int, id {valid.schema['id'].dataType.simpleString()}, ids array<{valid.schema['id'].dataType.simpleString()}>, vector {valid.schema['vector'].dataType.simpleString()}"
    id_type = valid.schema["id"].dataType.simpleString()
    index = stage(_blocks(entries.mapInArrow(assign(1), listed), block_rows, id_type), "scan-index")
    asking = valid.where("asks").select(F.col("id").alias("query_id"), "vector")
    classes = stage(asking.join(entries, "vector").select("query_id", "id"), "scan-queries")
    wanted = entries.join(classes.select("id").distinct(), "id", "left_semi")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, c in zip(batch.column(0), batch.column(1)):
                if not len(q.values) or not len(c.values):
                    continue
                asked, held = q.values, c.values
                raw, ids = matrix(held.field("vector")), held.field("ids")
                turned, first = _unit(raw, turn), held.field("id").to_numpy()
                queries_raw = matrix(asked.field("vector"))
                for name, query, spun in zip(asked.field("id").to_pylist(), queries_raw, _unit(queries_raw, turn)):
                    at = scan(spun, turned, min(k + 1, len(turned)), chance)
                    scores = cosines(query, raw[at])
                    best = np.lexsort((first[at], -scores))[: k + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(best), held.field("id").type), pa.array(scores[best]), ids.take(pa.array(at[best]))], ["id", "score", "ids"]
                    )

    def found(asked: DataFrame, width: int) -> DataFrame:
        groups = _blocks(asked.mapInArrow(assign(width), listed), block_rows // 4, id_type).withColumnRenamed("rows", "asked")
        pairs = groups.join(index.withColumnRenamed("rows", "held"), "list").select("asked", "held")
        hits = pairs.mapInArrow(_merged(probe), f"id {id_type}, score double, ids array<{id_type}>")
        single = hits.select("id", "score", F.explode("ids").alias("other"))
        order = Window.partitionBy("id").orderBy(F.desc("score"), "other")
        return single.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k + 1).drop("_place")

    best = stage(found(wanted, probes), "scan-found")
    if lists > probes:
        everyone = valid.count()
        few = best.groupBy("id").count().where(F.col("count") < min(k + 1, everyone)).select("id")
        again = wanted.join(few, "id", "left_semi")
        best = best.join(few, "id", "left_anti").unionByName(found(again, lists))
    mine = classes.join(best, "id").where(F.col("other") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "other")
    return (
        mine.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("other").alias(key), "score")
    )


def _merged(probe):
    """Join the small results of a task into fewer batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in probe(batches):
            held.append(batch)
            if len(held) == 1000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run
