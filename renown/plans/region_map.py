"""Texts to vectors, a plane, and named regions at several zoom levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.operators import density, expect, graph, layout, regions
from renown.session import stage


def label_layers(
    documents: DataFrame, key: str, text: str, dimensions: int = layout.DIMENSIONS, layers: list[int] = regions.LAYERS
) -> DataFrame:
    """(key, layer, label) of every document, layer 0 the coarsest."""
    vectors = layout.encode_hashed(documents, key, text, dimensions)
    coords = stage(layout.layout(vectors, key, "embedding"), "layout")
    return regions.label_regions(regions.cluster_layers(coords, key, layers), documents, key, text)


def label_nested(
    documents: DataFrame, key: str, text: str, dimensions: int = layout.DIMENSIONS, shares: list[float] = density.SHARES,
    bins: int = density.BINS,
) -> DataFrame:
    """(key, layer, label) like ``label_layers``, but each region lies within one region of the layer before."""
    vectors = layout.encode_hashed(documents, key, text, dimensions)
    coords = stage(layout.layout(vectors, key, "embedding"), "layout")
    clusters = stage(density.density_layers(coords, key, bins=bins, shares=shares), "clusters")
    expect.enforce(expect.layers_nest(clusters, key, "each region lies within one of the layer before"))
    return regions.label_regions(clusters, documents, key, text)


def graph_layout(vectors: DataFrame, key: str, vector: str, k: int = 15, metric: str = "cosine", **search: float) -> DataFrame:
    """(key, x, y) of the rows in the neighbour graph of their vectors; ``search`` goes to ``graph.graph_axes``."""
    near = stage(graph.knn_graph(vectors, key, vector, k, metric), "neighbours")
    placed, _ = graph.graph_axes(graph.undirected(near, key), **search)
    x, y = (F.col("axis")[j].cast("float").alias(n) for j, n in enumerate("xy"))
    return placed.select(F.col("id").alias(key), x, y)
