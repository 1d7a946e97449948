"""Approximate neighbour graphs by refinement, and layouts from their edges.

``knn_graph`` starts from rows that lie close along random directions and then lets
neighbours of neighbours meet until no edge improves: a neighbour of a neighbour is
likely a neighbour. A round moves each vector once per list it stands in that holds
anything new, so its cost grows with the lists that still change, not with the pairs of rows.

``graph_axes`` takes the slowest non-trivial axes of the walk on such a graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renown.operators.ordering import number_rows
from renown.session import stage

# directions and rows per block of the start; rounds at most
DIRECTIONS, BLOCK, ROUNDS = 4, 256, 20
# columns of the Krylov space before a restart, restarts, and the residual that ends the search
COLUMNS, RESTARTS, TOLERANCE = 24, 20, 1e-6

_MEMBERS = "id bigint, other bigint, score double"


def knn_graph(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 15,
    metric: str = "euclidean",
    width: int | None = None,
    rounds: int = ROUNDS,
    seed: int = 42,
) -> DataFrame:
    """(key, neighbour, place 1..k, score) like ``neighbours.nearest``, found approximately.

    Lists hold ``width`` (3 k unless given) rows while they are refined; a row also meets the
    ``width`` nearest of the rows that list it. More width, more recall and more work. Scores are
    exact; some of the k nearest may be missed. Rows without a vector and, under cosine, zero
    vectors take no part; all vectors must have one length. Equal scores go to the smaller key.
    """
    if metric not in ("euclidean", "cosine"):
        raise ValueError(metric)
    width = width or 3 * k
    # vectors travel as they are given, floats in four bytes, and are divided by their norm where they meet
    kind = "<f4" if df.schema[vector].dataType == T.ArrayType(T.FloatType()) else "<f8"
    given = F.col(vector) if kind == "<f4" else F.col(vector).cast("array<double>")
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("id"), given.alias("v"))
    if metric == "cosine":
        norm = F.sqrt(F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))
        rows = rows.withColumn("norm", norm).where(F.col("norm") > 0)
    else:
        rows = rows.withColumn("norm", F.lit(1.0))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 1
    along = np.random.default_rng(seed).normal(size=(DIRECTIONS, dims))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = np.asarray(batch.column("v").flatten(), dtype=kind).reshape(-1, dims)
            norm = np.asarray(batch.column("norm"))
            shadows = (given.astype("<f8") / norm[:, None]) @ along.T
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("norm"), pa.array([p.tobytes() for p in given], pa.binary())]
                + [pa.array(shadows[:, j]) for j in range(DIRECTIONS)],
                ["id", "norm", "v", *[f"d{j}" for j in range(DIRECTIONS)]],
            )

    fields = ", ".join(f"d{j} double" for j in range(DIRECTIONS))
    packed = stage(rows.mapInArrow(pack, f"id bigint, norm double, v binary, {fields}"), "packed")
    vectors = packed.select("id", "norm", "v")
    infinite = F.lit(float("inf"))
    start = None
    for j in range(DIRECTIONS):
        order = number_rows(packed.select("id", f"d{j}"), [F.col(f"d{j}").asc(), F.col("id").asc()], "_at")
        block = F.floor((F.col("_at") + (BLOCK // DIRECTIONS) * j) / BLOCK)
        members = order.select(block.alias("at"), F.col("id").alias("member"))
        met = _meet(members.withColumns({"fresh": F.lit(True), "bound": infinite}), vectors, dims, kind, width)
        start = met if start is None else start.unionByName(met)
    lists = stage(_best(start.withColumn("fresh", F.lit(True)), width), "lists")
    for _ in range(rounds):
        lists, improved = _refine(lists, vectors, dims, kind, width)
        if not improved:
            break
    found = lists.where(F.col("place") <= k)
    score = 1 - F.col("score") / 2 if metric == "cosine" else F.sqrt("score")
    return found.select(F.col("id").alias(key), F.col("other").alias("neighbour"), "place", score.alias("score"))


def _best(edges: DataFrame, width: int) -> DataFrame:
    """The ``width`` best different rows of each list with their place; an edge known before isn't fresh."""
    once = edges.groupBy("id", "other").agg(F.min("score").alias("score"), F.min("fresh").alias("fresh"))
    best = Window.partitionBy("id").orderBy("score", "other")
    return once.withColumn("place", F.row_number().over(best)).where(F.col("place") <= width)


def _refine(lists: DataFrame, vectors: DataFrame, dims: int, kind: str, width: int) -> tuple[DataFrame, bool]:
    nearest = Window.partitionBy("other").orderBy("score", "id")
    back = lists.withColumn("_back", F.row_number().over(nearest)).where(F.col("_back") <= width)
    members = lists.select(F.col("id").alias("at"), F.col("other").alias("member"), "fresh").unionByName(
        back.select(F.col("other").alias("at"), F.col("id").alias("member"), "fresh")
    )
    own = vectors.select(F.col("id").alias("at"), F.col("id").alias("member"), F.lit(False).alias("fresh"))
    members = members.groupBy("at", "member").agg(F.max("fresh").alias("fresh")).unionByName(own)
    # where no row is fresh no pair is, so nothing moves there
    news = lists.where("fresh").select(F.col("id").alias("at")).unionByName(back.where("fresh").select(F.col("other").alias("at"))).distinct()
    members = members.join(news, "at", "left_semi")
    # a row takes only what beats the last of its full list
    full = lists.groupBy("id").agg(F.max("score").alias("_last"), F.count(F.lit(1)).alias("_n"))
    bound = full.select(
        F.col("id").alias("member"), F.when(F.col("_n") >= width, F.col("_last")).otherwise(float("inf")).alias("bound")
    )
    met = _meet(members.join(bound, "member", "left").fillna(float("inf"), ["bound"]), vectors, dims, kind, width)
    edges = lists.withColumn("fresh", F.lit(False)).drop("place").unionByName(met.withColumn("fresh", F.lit(True)))
    refined = stage(_best(edges, width), "lists")
    return refined, not refined.where("fresh").isEmpty()


def _meet(members: DataFrame, vectors: DataFrame, dims: int, kind: str, width: int) -> DataFrame:
    """(id, other, score) of members (at, member, fresh, bound) that meet at a place: pairs with a fresh one, below the bound.

    A place holds at most 2 ``width`` + 1 rows, or a block of the start.
    """
    there = members.join(vectors.withColumnRenamed("id", "member"), "member")
    # rows of a place stand in a row; they come batch by batch, and a place may go on in the next one
    sorted_ = there.select("at", "member", "fresh", "bound", "norm", "v").repartition("at").sortWithinPartitions("at")

    def place(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids = np.asarray(rows.column("member"))
        fresh = rows.column("fresh").to_numpy(zero_copy_only=False)
        bound = np.asarray(rows.column("bound"))
        points = np.frombuffer(b"".join(rows.column("v").to_pylist()), dtype=kind).reshape(len(ids), dims).astype("<f8")
        points = points / np.asarray(rows.column("norm"))[:, None]
        order = np.argsort(ids)
        ids, fresh, bound, points = ids[order], fresh[order], bound[order], points[order]
        # rounding lets copies of a vector tie whatever the order of the sums
        norms = (points**2).sum(axis=1)
        score = np.round(np.maximum(norms[:, None] + norms[None, :] - 2 * points @ points.T, 0.0), 12)
        score[~(fresh[:, None] | fresh[None, :]) | (score > bound[:, None])] = np.inf
        np.fill_diagonal(score, np.inf)
        if len(ids) > width:
            last = np.partition(score, width - 1, axis=1)[:, width - 1 : width]
            score[score > last] = np.inf
        a, b = np.nonzero(np.isfinite(score))
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b]), pa.array(score[a, b])], ["id", "other", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            at = np.asarray(rows.column("at"))
            starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
            for start, end in zip(starts[:-1], starts[1:]):
                yield place(rows.slice(start, end - start))
            held = rows.slice(starts[-1])
        if held is not None:
            yield place(held)

    return sorted_.mapInArrow(run, _MEMBERS)


def undirected(edges: DataFrame, key: str, neighbour: str = "neighbour", weight: Column | None = None) -> DataFrame:
    """(id, other, weight) in both directions, each pair once with its largest weight; loops go."""
    one = edges.where(F.col(key) != F.col(neighbour)).select(
        F.col(key).alias("id"), F.col(neighbour).alias("other"), (F.lit(1.0) if weight is None else weight).cast("double").alias("weight")
    )
    both = one.unionByName(one.select(F.col("other").alias("id"), F.col("id").alias("other"), "weight"))
    return both.where(F.col("weight") > 0).groupBy("id", "other").agg(F.max("weight").alias("weight"))


def graph_axes(
    links: DataFrame, axes: int = 2, columns: int = COLUMNS, restarts: int = RESTARTS, tolerance: float = TOLERANCE
) -> tuple[DataFrame, list[float]]:
    """(id, axis array) of the nodes of ``undirected`` links, and the eigenvalues of the axes.

    The axes are the eigenvectors of the lazy walk (I + D^-1 W) / 2 after the constant one, largest
    eigenvalue first, with unit degree-weighted square and the sign that makes the component of
    largest size (smallest id among equals) positive. Blocks of ``axes`` + 1 vectors are multiplied
    by the walk, deflated against the constant axis and all before, and the best combination of all
    is taken; only sums of products reach the driver. Parts of the graph without links between them
    show as axes of eigenvalue 1. Equal eigenvalues leave their axes free to turn. A search that
    misses the tolerance is an error, as are fewer nodes than axes + 1.
    """
    links = stage(links, "links")
    degrees = links.groupBy("id").agg(F.sum("weight").alias("degree"))
    nodes = degrees.agg(F.count(F.lit(1)).alias("n"), F.sum("degree").alias("mass")).first()
    if nodes["n"] < axes + 1:
        raise ValueError(f"{nodes['n']} nodes have no {axes} axes beside the constant one")
    block = min(axes + 1, nodes["n"] - 1)
    columns = max(block, min(columns, nodes["n"] - 1) // block * block)
    root, noise = F.sqrt(F.col("degree") / nodes["mass"]), F.array(*[_noise(j) for j in range(block)])
    state = stage(degrees.select("id", root.alias("root"), F.sqrt("degree").alias("half"), noise.alias("b")), "axes")
    for _ in range(restarts):
        state, values, residual = _krylov(state, links, block, columns, axes)
        if residual <= tolerance:
            break
    else:
        raise RuntimeError(f"residual {residual:.2e} after {restarts} restarts of {columns} columns")
    walk = F.transform(F.slice("b", 1, axes), lambda x: x / F.col("root"))
    placed = stage(state.select("id", walk.alias("axis")), "axes")
    largest = [F.max_by(F.col("axis")[j], F.struct(F.round(F.abs(F.col("axis")[j]), 9), -F.col("id"))) for j in range(axes)]
    signs = [1.0 if s >= 0 else -1.0 for s in placed.agg(*largest).first()]
    turned = F.array(*[F.col("axis")[j] * signs[j] for j in range(axes)])
    return placed.select("id", turned.alias("axis")), values[:axes]


def _noise(j: int) -> Column:
    """A number between -1/2 and 1/2 that depends on the id only."""
    return F.pmod(F.xxhash64(F.lit(j), F.col("id")), F.lit(1 << 20)) / float(1 << 20) - 0.5


def _combined(parts: list[tuple[str, np.ndarray]]) -> Column:
    """Array of linear combinations: the columns of each matrix weigh the entries of its array."""
    sums = []
    for j in range(parts[0][1].shape[1]):
        total = F.lit(0.0)
        for name, weights in parts:
            for i in np.flatnonzero(weights[:, j]):
                total = total + F.col(name)[int(i)] * float(weights[i, j])
        sums.append(total)
    return F.array(*sums)


def _grams(df: DataFrame, *pairs: tuple[str, int, str, int]) -> list[np.ndarray]:
    """Matrices of the sums of products of two arrays' entries, all in one pass."""
    sums = [F.sum(F.col(a)[i] * F.col(b)[j]) for a, n, b, m in pairs for i in range(n) for j in range(m)]
    flat, found = np.array(df.agg(*sums).first(), dtype=float), []
    for _, n, _, m in pairs:
        found.append(flat[: n * m].reshape(n, m))
        flat = flat[n * m :]
    return found


def _krylov(
    state: DataFrame, links: DataFrame, block: int, columns: int, axes: int
) -> tuple[DataFrame, list[float], float]:
    """One restart: the state with the best vectors in ``b``, their eigenvalues, the largest residual of the axes.

    ``all`` holds the constant axis and the columns so far, ``image`` what one step of the walk makes of the columns.
    """
    state = state.withColumns({"all": F.array("root"), "image": F.array().cast("array<double>")})
    size = 0
    while True:
        # deflation against the constant axis and all columns, twice against rounding
        (first,) = _grams(state, ("all", size + 1, "b", block))
        state = state.withColumn("b", _combined([("b", np.eye(block)), ("all", -first)]))
        again, held = _grams(state, ("all", size + 1, "b", block), ("b", block, "b", block))
        values, vectors = np.linalg.eigh(held - again.T @ again)
        kept = values > 1e-20
        if not kept.any():
            break
        turn = vectors[:, kept] / np.sqrt(values[kept])
        block = turn.shape[1]
        state = state.withColumn("b", _combined([("b", turn), ("all", -again @ turn)]))
        ends = state.select(F.col("id").alias("other"), F.col("b").alias("_b"), F.col("half").alias("_half"))
        share = [F.sum(F.col("weight") * F.col("_b")[j] / F.col("_half")) for j in range(block)]
        flow = links.join(ends, "other").groupBy("id").agg(F.array(*share).alias("_flow"))
        step = F.array(*[(F.col("b")[j] + F.col("_flow")[j] / F.col("half")) / 2 for j in range(block)])
        state = stage(
            state.join(flow, "id").withColumn("_step", step).select(
                "id", "root", "half", F.concat("all", "b").alias("all"), F.concat("image", "_step").alias("image"), F.col("_step").alias("b")
            ),
            "axes",
        )
        size += block
        if size + block > columns:
            break
    (products,) = _grams(state, ("all", size + 1, "image", size))
    values, vectors = np.linalg.eigh((products[1:] + products[1:].T) / 2)
    best, values = vectors[:, ::-1][:, : axes + 1], values[::-1][: axes + 1]
    lifted = np.vstack([np.zeros(best.shape[1]), best])
    gaps = _combined([("image", best[:, :axes]), ("all", -lifted[:, :axes] * values[:axes])])
    (off,) = _grams(state.withColumn("_gap", gaps), ("_gap", axes, "_gap", axes))
    state = state.withColumn("b", _combined([("all", lifted)])).select("id", "root", "half", "b")
    return stage(state, "axes"), [float(v) for v in values], float(np.sqrt(off.diagonal().max()))
