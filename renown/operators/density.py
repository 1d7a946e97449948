"""Nested regions of a plane: connected cells of a grid above falling densities.

Points are counted in the cells of a grid. A layer keeps the densest cells that
together hold its share of the points, and its regions are the connected groups
of those cells. A finer layer keeps a subset of the cells of a coarser one, so
each of its regions lies inside exactly one coarser region: the layers are cuts
through the merge tree of the density.

Only the counting and the last join touch the points. Everything between works on
cells, whose number the grid bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.operators.ordering import running_total
from renown.session import stage

# cells per axis, and the share of the points that each layer keeps, from coarse to fine
BINS, SHARES = 128, [0.95, 0.6, 0.3]
_MAX_BINS = 512
_STRIDE = 1 << 32


def grid(
    points: DataFrame, x: str = "x", y: str = "y", bins: int = BINS, box: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """Add ``_cell``, column * 2**32 + row; null where a coordinate is null or not finite.

    ``box`` (least x, least y, greatest x, greatest y) is the extent of the points unless given;
    points beyond it belong to the cells at its edge.
    """
    if not 1 <= bins <= _MAX_BINS:
        raise ValueError(f"between 1 and {_MAX_BINS} bins")
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    # only numbers below infinity are places
    there = (F.abs(xs) < float("inf")) & (F.abs(ys) < float("inf"))
    if box is None:
        ends = points.where(there).agg(F.min(xs), F.min(ys), F.max(xs), F.max(ys)).first()
        box = tuple(0.0 if e is None else e for e in ends)
    column, row = _bin(xs, box[0], box[2], bins), _bin(ys, box[1], box[3], bins)
    return points.withColumn("_cell", F.when(there, column * F.lit(_STRIDE) + row))


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    if high <= low:
        return F.lit(0).cast("bigint")
    at = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(bins)).cast("bigint")
    return F.least(F.lit(bins - 1).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), at))


def cell_regions(cells: DataFrame, shares: list[float] = SHARES) -> DataFrame:
    """(layer, _cell, n, region) of the kept cells of (_cell, n); the region is its smallest cell.

    Cells of equal count are kept or left together, so a layer may hold more than its share.
    """
    if not shares or any(b > a for a, b in zip(shares, shares[1:])) or not 0 < shares[-1] <= shares[0] <= 1:
        raise ValueError("shares of the points between 0 and 1, none above the one before")
    cells = stage(cells, "grid-cells")
    total = F.sum("n").cast("bigint")
    counts = cells.groupBy("n").agg(total.alias("points")).withColumn("_rank", -F.col("n"))
    mass = running_total(counts, "points", "mass", "_rank")
    points = cells.agg(total).scalar()
    # one number per layer
    least = mass.agg(
        *[F.max(F.when(F.col("mass") >= F.lit(s) * points, F.col("n"))).alias(f"l{i}") for i, s in enumerate(shares)]
    ).first()
    layers = F.array(*[F.struct(F.lit(i).alias("layer"), F.lit(n).cast("bigint").alias("least")) for i, n in enumerate(least)])
    nodes = stage(
        cells.select("_cell", "n", F.explode(layers).alias("_l")).where(F.col("n") >= F.col("_l.least"))
        .select("_l.layer", "_cell", "n"),
        "grid-nodes",
    )
    steps = [a * _STRIDE + b for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)]
    beside = nodes.select("layer", "_cell", F.explode(F.array(*[F.col("_cell") + F.lit(s) for s in steps])).alias("_other"))
    links = stage(beside.join(nodes.select("layer", F.col("_cell").alias("_other")), ["layer", "_other"]), "grid-links")
    return nodes.join(connected(nodes.select("layer", "_cell"), links), ["layer", "_cell"])


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(layer, _cell, region): the smallest cell each one is connected with.

    ``links`` (layer, _cell, _other) holds both directions. Each round, a cell and the cell it
    points at take the smallest label next to it, then labels are followed once; rounds go on
    until no label falls, about the logarithm of the widest region.
    """
    labels = stage(nodes.withColumn("region", F.col("_cell")), "labels")
    while True:
        near = (
            links.join(labels.select("layer", F.col("_cell").alias("_other"), F.col("region").alias("_near")), ["layer", "_other"])
            .groupBy("layer", "_cell").agg(F.min("_near").alias("_near"))
        )
        both = labels.join(near, ["layer", "_cell"], "left")
        low = F.least("region", "_near")
        offers = both.select(
            "layer", F.explode(F.array(F.struct(F.col("_cell"), low.alias("to")), F.struct(F.col("region").alias("_cell"), low.alias("to")))).alias("_o")
        )
        hooked = offers.groupBy("layer", F.col("_o._cell").alias("_cell")).agg(F.min("_o.to").alias("_to"))
        onward = hooked.select("layer", F.col("_cell").alias("_to"), F.col("_to").alias("_end"))
        followed = hooked.join(onward, ["layer", "_to"]).select("layer", "_cell", F.col("_end").alias("_new"))
        moved = stage(labels.join(followed, ["layer", "_cell"]), "labels")
        labels = moved.select("layer", "_cell", F.col("_new").alias("region"))
        if moved.where(F.col("region") != F.col("_new")).isEmpty():
            return labels


def density_layers(
    points: DataFrame,
    key: str,
    x: str = "x",
    y: str = "y",
    bins: int = BINS,
    shares: list[float] = SHARES,
    box: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """(key, layer, cluster) of every point and layer; null cluster outside the regions of a layer.

    Layer 0 is the coarsest, and a cluster of a later layer lies within one cluster of each earlier
    layer. Points without a place are in no cluster. The table of cells has at most ``bins`` squared rows.
    """
    placed = stage(grid(points, x, y, bins, box).select(key, "_cell"), "grid")
    cells = placed.where(F.col("_cell").isNotNull()).groupBy("_cell").agg(F.count(F.lit(1)).alias("n"))
    regions = cell_regions(cells, shares)
    found = regions.groupBy("_cell").agg(F.map_from_entries(F.collect_list(F.struct("layer", "region"))).alias("_in"))
    layers = F.array(*[F.lit(i) for i in range(len(shares))])
    # bounded by the grid: at most 512 * 512 rows of one number per layer
    return placed.join(F.broadcast(found), "_cell", "left").select(
        key, F.explode(layers).alias("layer"), "_in"
    ).select(key, "layer", F.try_element_at("_in", F.col("layer")).alias("cluster"))


def region_tree(regions: DataFrame) -> DataFrame:
    """(layer, region, parent, cells, points) from ``cell_regions``; no parent in layer 0.

    The parent is the region of the layer before that holds the region's cells.
    """
    outer = regions.select((F.col("layer") + 1).alias("layer"), F.col("_cell"), F.col("region").alias("_parent"))
    return (
        regions.join(outer, ["layer", "_cell"], "left")
        .groupBy("layer", "region")
        .agg(
            F.min("_parent").alias("parent"), F.count(F.lit(1)).alias("cells"), F.sum("n").cast("bigint").alias("points")
        )
    )
