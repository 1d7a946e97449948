"""Exact k nearest neighbours without comparing all pairs.

Rows go to the cell of their nearest pivot, cells are cut into tiles of bounded
size, and a tile is compared with a cell only where the triangle inequality
can't rule it out:

1. the k-th distance inside a row's own tile, or the reach of the nearest cells
   that hold k other rows, bounds the k-th distance overall;
2. a cell whose nearest possible point lies beyond that bound holds no neighbour;
3. strips of tiles meet in blocks: a block reads each tile it needs once and yields at
   most k candidates per row, and the k-th so far tightens the bound.

No candidate is dropped unseen, so the result equals brute force. Pruning is
strong in the plane and weak for many dimensions, where exact search costs about
one product of each pair of tiles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renown.session import stage

_TILE_BYTES = 16 << 20
_PIVOT_BYTES = 64 << 20
_MAX_PIVOTS = 16_384
# bounds of the tiles that a block holds on either side, and strips where there are tiles enough
STRIPS = 12
_STRIP_BYTES, _STRIP_ROWS = 32 << 20, 65_536


def nearest(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 15,
    metric: str = "euclidean",
    tile_rows: int | None = None,
) -> DataFrame:
    """(key, neighbour, place 1..k, score) with the row itself left out by key.

    ``metric`` is ``euclidean`` (score = distance, small first) or ``cosine``
    (score = similarity, large first). Equal scores go to the smaller key. Rows
    without a vector have no neighbours, nor have zero vectors under cosine.

    Equal vectors are searched once: each class of them carries its k + 1 smallest keys,
    finds k + 1 entries, and its rows take theirs from that list.
    """
    if metric not in ("euclidean", "cosine"):
        raise ValueError(metric)
    cosine = metric == "cosine"
    rows = df.where(F.col(vector).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    if cosine:
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        rows = (
            rows.withColumn("_norm", norm)
            .where(F.col("_norm") > 0)
            .select("id", F.transform("v", lambda x: x / F.col("_norm")).alias("v"))
        )
    rows = stage(rows, "vectors")
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    classes = stage(
        rows.withColumn("_place", place).where(F.col("_place") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("id"), "v", "ids"),
        "distinct-vectors",
    )
    found = _search(classes.select("id", "v"), k, cosine, tile_rows)
    own = classes.select("id", F.col("id").alias("neighbour"), F.lit(-1.0 if cosine else 0.0).alias("score"))
    held = classes.select(F.col("id").alias("neighbour"), F.explode("ids").alias("other"))
    in_class = Window.partitionBy("id").orderBy("score", "other")
    lists = (
        found.unionByName(own).join(held, "neighbour").withColumn("_place", F.row_number().over(in_class))
        .where(F.col("_place") <= k + 1).select(F.col("id").alias("class"), "other", "score")
    )
    members = rows.join(classes.select(F.col("id").alias("class"), "v"), "v").select("id", "class")
    best = Window.partitionBy("id").orderBy("score", "other")
    score = -F.col("score") if cosine else F.sqrt("score")
    return (
        members.join(lists, "class").where(F.col("other") != F.col("id"))
        .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
        .select(F.col("id").alias(key), F.col("other").alias("neighbour"), "place", score.alias("score"))
    )


def _search(rows: DataFrame, k: int, cosine: bool, tile_rows: int | None) -> DataFrame:
    """(id, neighbour, score) over distinct vectors: at least the k best of each, small scores first."""
    df = rows
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
    n, dims = size["n"], size["dims"] or 1
    if tile_rows is None:
        tile_rows = max(256, min(4096, _TILE_BYTES // (8 * dims)))
    # pivots: a hash-ordered sample whose size in bytes is bounded
    n_pivots = max(1, min(n // tile_rows, _MAX_PIVOTS, _PIVOT_BYTES // (8 * dims)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(n_pivots).collect()
    pivots = np.array([r["v"] for r in sample]).reshape(-1, dims)
    pivot_norms = (pivots**2).sum(axis=1)

    def to_cells(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                points = np.stack(part["v"].to_numpy())
                cell = (pivot_norms[None, :] - 2 * points @ pivots.T).argmin(axis=1)
                gap = np.sqrt(((points - pivots[cell]) ** 2).sum(axis=1))
                yield pd.DataFrame({"id": part["id"], "v": part["v"], "cell": cell.astype(np.int32), "gap": gap})

    celled = stage(rows.mapInPandas(to_cells, "id bigint, v array<double>, cell int, gap double"), "cells")
    # one row per pivot
    stats = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("reach")).collect()
    members = np.zeros(max(1, len(pivots)), dtype=np.int64)
    reach = np.full(max(1, len(pivots)), -np.inf)
    for r in stats:
        members[r["cell"]], reach[r["cell"]] = r["n"], r["reach"]
    tiles_of = np.maximum(1, -(-members // tile_rows))
    first_tile = np.concatenate([[0], np.cumsum(tiles_of)[:-1]])
    layout = df.sparkSession.createDataFrame(
        pd.DataFrame({"cell": np.arange(len(members), dtype=np.int32), "first": first_tile, "tiles": tiles_of})
    )
    # a cell's rows spread evenly over its tiles, so a crowded cell is many tiles
    tiled = celled.join(F.broadcast(layout), "cell").select(
        "id", "v", "cell", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("tiles"))).alias("tile")
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        """One tile: its rows by id, each row's bound, and the cells it has to visit."""
        group = group.sort_values("id")
        points = np.stack(group["v"].to_numpy())
        norms = (points**2).sum(axis=1)
        # room for rounding in the products below
        margin = 1e-6 * (1 + np.sqrt(max(norms.max(), pivot_norms.max())))
        bounds, visits = [], np.zeros(len(pivots), dtype=bool)
        for at in range(0, len(points), 256):
            part, part_norms = points[at : at + 256], norms[at : at + 256, None]
            to_pivots = np.sqrt(np.maximum(part_norms + pivot_norms[None, :] - 2 * part @ pivots.T, 0.0))
            # cells by their farthest point: the first ones that hold k other rows
            far = np.where(members > 0, to_pivots + reach, np.inf)
            order = np.argsort(far, axis=1, kind="stable")
            held = np.cumsum(members[order], axis=1)
            enough = (held >= k + 1).argmax(axis=1)
            bound = np.take_along_axis(far, np.take_along_axis(order, enough[:, None], 1), 1)[:, 0]
            bound[held[:, -1] < k + 1] = np.inf
            if len(points) > k:
                gaps = part_norms + norms[None, :] - 2 * part @ points.T
                gaps[np.arange(len(part)), at + np.arange(len(part))] = np.inf
                kth = np.partition(gaps, k - 1, axis=1)[:, k - 1]
                bound = np.minimum(bound, np.sqrt(np.maximum(kth, 0.0)))
            bound = bound + margin
            near = np.where(members > 0, to_pivots - reach, np.inf)
            visits |= (near <= bound[:, None] + margin).any(axis=0)
            bounds.append(bound)
        return pd.DataFrame(
            {
                "tile": [int(group["tile"].iloc[0])],
                "cell": [int(group["cell"].iloc[0])],
                "ids": [group["id"].to_numpy()],
                "points": [points.astype("<f8").tobytes()],
                "bounds": [np.concatenate(bounds)],
                "visits": [np.flatnonzero(visits).astype(np.int32)],
            }
        )

    packed = "tile bigint, cell int, ids array<bigint>, points binary, bounds array<double>, visits array<int>"
    tiles = stage(tiled.groupBy("tile").applyInPandas(pack, packed), "tiles")
    # pairs of tile numbers first; a block of two strips of tiles then gets the vectors of its tiles once
    strip_tiles = max(1, min(min(_STRIP_ROWS, _STRIP_BYTES // (8 * dims)) // tile_rows, int(tiles_of.sum()) // STRIPS))
    cells = tiles.select(F.col("cell").alias("visit"), F.col("tile").alias("tile2"))
    pairs = tiles.select("tile", F.explode("visits").alias("visit")).join(cells, "visit")
    strips = [F.floor(F.col(c) / strip_tiles).alias(n) for c, n in (("tile", "strip"), ("tile2", "strip2"))]
    pairs = stage(pairs.select("tile", "tile2", *strips), "tile-pairs")
    visits = pairs.groupBy("tile", "strip", "strip2").agg(F.collect_list("tile2").alias("meets"))
    left = visits.join(tiles.select("tile", "ids", "points", "bounds"), "tile")
    right = pairs.select(F.col("tile2").alias("tile"), "strip", "strip2").distinct().join(tiles.select("tile", "ids", "points"), "tile")
    sides = left.unionByName(right, allowMissingColumns=True)

    def match(block: pd.DataFrame) -> pd.DataFrame:
        """The k best rows of the second strip for each row of the first."""
        asked = block["meets"].notna()
        held = {}
        for row in block[~asked].itertuples():
            ids = np.asarray(row.ids)
            points = np.frombuffer(row.points, dtype="<f8").reshape(len(ids), dims)
            held[row.tile] = ids, points, (points**2).sum(axis=1)
        out = [pd.DataFrame({"id": np.empty(0, np.int64), "neighbour": np.empty(0, np.int64), "score": np.empty(0)})]
        for row in block[asked].itertuples():
            ids, bounds = np.asarray(row.ids), np.asarray(row.bounds)
            points = np.frombuffer(row.points, dtype="<f8").reshape(len(ids), dims)
            for at in range(0, len(ids), 512):
                part, part_ids, bound = points[at : at + 512], ids[at : at + 512], bounds[at : at + 512]
                # a bound that isn't a number rules nothing out
                limit = np.nan_to_num(bound**2 / 2 - 1 if cosine else bound**2, nan=np.inf, posinf=np.inf)
                best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
                for tile in sorted(row.meets):
                    found = _below(part, part_ids, limit, *held[tile], cosine)
                    where, to, score = (np.concatenate(c) for c in zip(best, found))
                    order = np.lexsort((to, score, where))
                    where, to, score = where[order], to[order], score[order]
                    place = np.arange(len(where)) - np.searchsorted(where, where)
                    # the k-th so far is the new limit of its row
                    last = place == k - 1
                    limit[where[last]] = np.minimum(limit[where[last]], score[last])
                    best = tuple(c[place < k] for c in (where, to, score))
                out.append(pd.DataFrame({"id": part_ids[best[0]], "neighbour": best[1], "score": best[2]}))
        return pd.concat(out)

    # a small block may be long work, so blocks are dealt by number and not by their bytes
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), STRIPS**2)
    return sides.repartition(tasks, "strip", "strip2").groupBy("strip", "strip2").applyInPandas(match, "id bigint, neighbour bigint, score double")


def _below(
    part: np.ndarray, part_ids: np.ndarray, limit: np.ndarray, ids: np.ndarray, points: np.ndarray, norms: np.ndarray, cosine: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of part, id, score) of the pairs at or below each row's limit, itself left out.

    One product of matrices finds the pairs that may be; only those are scored.
    """
    products = part @ points.T
    dims = part.shape[1]
    if cosine:
        where, at = np.nonzero(products >= (-limit - 1e-11)[:, None])
        # rounding lets copies of a vector tie whatever the order of the sums
        score = -np.round(products[where, at], 12)
    else:
        own = (part**2).sum(axis=1)
        # room for rounding in the product
        room = 8 * (dims + 8) * np.finfo(float).eps * (own + np.nanmax(norms, initial=0.0))
        products *= -2
        products += norms
        where, at = np.nonzero(products <= (limit + room - own)[:, None])
        score = np.zeros(len(where))
        for j in range(dims):
            score += (part[where, j] - points[at, j]) ** 2
    keep = np.isfinite(score) & (score <= limit[where]) & (part_ids[where] != ids[at])
    return where[keep], ids[at[keep]], score[keep]


def label_purity(neighbours: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """One row: each row's share of labelled neighbours with its own label, averaged over the rows."""
    own = labels.where(F.col(label).isNotNull()).select(F.col(key), F.col(label).alias("_own"))
    other = own.select(F.col(key).alias("neighbour"), F.col("_own").alias("_other"))
    return (
        neighbours.join(own, key)
        .join(other, "neighbour")
        .groupBy(key)
        .agg(F.avg((F.col("_own") == F.col("_other")).cast("double")).alias("share"))
        .agg(F.avg("share").alias("purity"))
    )
