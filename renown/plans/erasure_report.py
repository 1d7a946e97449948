"""Before and after of an erasure: probe area, neighbourhood purity and chance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.operators import erasure, layout, neighbours, probe, stats

VARIANTS = ["raw", "centroid", "leace"]


def erased_variant(df: DataFrame, vector: str, concept: str, variant: str) -> DataFrame:
    """All rows of a variant, fitted on the labelled ones."""
    if variant == "raw":
        return df
    fit = {"centroid": erasure.fit_centroid, "leace": erasure.fit_leace}[variant]
    return erasure.erase(df, vector, fit(df, vector, concept))


def purity(df: DataFrame, key: str, vector: str, concept: str, variant: str, k: int = 15) -> DataFrame:
    """(variant, purity, chance) on the two-dimensional layout of the labelled rows."""
    points = layout.layout(erased_variant(df, vector, concept, variant), key, vector)
    labelled = df.where(F.col(concept).isNotNull()).select(key, concept)
    placed = points.join(labelled, key).select(key, F.array("x", "y").alias("xy"))
    near = neighbours.nearest(placed, key, "xy", k)
    chance = stats.class_balance(labelled, concept)
    return (
        neighbours.label_purity(near, labelled, key, concept)
        .withColumn("chance", chance.scalar())
        .select(F.lit(variant).alias("variant"), "purity", "chance")
    )


def report(df: DataFrame, key: str, vector: str, concept: str, k: int = 15) -> DataFrame:
    """One row per variant: held-out area, purity, chance."""
    rows = probe.split_vectors(df, key, vector, concept)
    areas = reduce(
        DataFrame.unionByName, [probe.probe_split(rows, key, vector, concept, v) for v in VARIANTS]
    )
    purities = reduce(
        DataFrame.unionByName, [purity(df, key, vector, concept, v, k) for v in VARIANTS]
    )
    return areas.join(purities, "variant")
