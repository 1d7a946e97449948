"""Regions of the layout at several zoom levels, their names and exemplars."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renown.functions.texts import words
from renown.operators.facets import wide_labels
from renown.operators.ordering import number_rows
from renown.session import stage

# Clusters per layer from coarse to fine, the fewest allowed, seed,
# and the distance quantile beyond which a point belongs to no region.
LAYERS, FEWEST, SEED, EDGE = [4, 16, 64], 4, 42, 0.9
NAME_TERMS = 3
UNLABELLED = "Unlabelled"


def cluster_layers(coords: DataFrame, key: str, layers: list[int] = LAYERS, edge: float = EDGE) -> DataFrame:
    """(key, layer, cluster, distance): null cluster for points far from their centre."""
    if not layers or min(layers) < FEWEST:
        raise ValueError(f"at least one layer, and at least {FEWEST} clusters in each")
    points = stage(
        coords.select(key, F.array(F.col("x").cast("double"), F.col("y").cast("double")).alias("_xy")), "coords"
    )
    features = points.withColumn("_v", array_to_vector("_xy"))
    found = []
    for layer, k in enumerate(layers):
        model = KMeans(k=k, seed=SEED, featuresCol="_v", predictionCol="cluster").fit(features)
        # 2 * k numbers
        centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
        centre = F.get(centres, F.col("cluster"))
        gap = F.sqrt(
            F.pow(F.col("_xy")[0] - centre[0], 2) + F.pow(F.col("_xy")[1] - centre[1], 2)
        )
        placed = model.transform(features).select(key, F.lit(layer).alias("layer"), "cluster", gap.alias("distance"))
        found.append(within_edge(placed, key, edge))
    return stage(reduce(DataFrame.unionByName, found), "clusters")


def within_edge(placed: DataFrame, key: str, edge: float = EDGE) -> DataFrame:
    """Rows (key, layer, cluster, distance) with a null cluster beyond the cluster's ``edge`` quantile.

    The limit is the exact quantile, interpolated between the two nearest places. Rows are numbered
    by distance in range partitions, so a crowded cluster is gathered nowhere. Clusters must not be
    null and one layer is given at a time.
    """
    placed = number_rows(placed, [F.col("distance").asc(), F.col(key).asc()], "_place", within=("cluster",))
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("_n"))
    at = (F.col("_n") - 1) * F.lit(float(edge))
    ends = placed.join(sizes, "cluster").where(F.col("_place") - 1 <= F.ceil(at)).where(F.col("_place") - 1 >= F.floor(at))
    low = F.min("distance")
    limits = ends.groupBy("cluster").agg(
        (low + (F.max("distance") - low) * F.max(at - F.floor(at))).alias("_limit")
    )
    return placed.join(limits, "cluster").select(
        key, "layer", F.when(F.col("distance") <= F.col("_limit"), F.col("cluster")).alias("cluster"), "distance"
    )


def region_terms(documents: DataFrame, region: str, text: str, top: int = NAME_TERMS) -> DataFrame:
    """(region, place, term, weight): terms that are frequent in a region and rare elsewhere.

    The weight is the term's share of the region's words times
    log(1 + mean words per region / uses of the term overall).
    """
    uses = (
        documents.where(F.col(region).isNotNull())
        .select(F.col(region).alias("region"), F.explode(words(F.col(text))).alias("term"))
        .groupBy("region", "term")
        .agg(F.count("*").alias("uses"))
    )
    return weigh_terms(uses, top)


def weigh_terms(uses: DataFrame, top: int = NAME_TERMS) -> DataFrame:
    """The best terms from (region, term, uses); the counts are written once for three passes."""
    uses = stage(uses, "terms")
    per_region = uses.groupBy("region").agg(F.sum("uses").alias("words"))
    overall = uses.groupBy("term").agg(F.sum("uses").alias("all_uses"))
    mean_words = per_region.agg(F.avg("words")).scalar()
    weight = F.col("uses") / F.col("words") * F.log1p(mean_words / F.col("all_uses"))
    weighted = (
        uses.join(per_region, "region")
        .join(overall, "term")
        .withColumn("weight", F.round(weight, 12))
    )
    best = Window.partitionBy("region").orderBy(F.col("weight").desc(), F.col("term").asc())
    return (
        weighted.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= top)
        .select("region", "place", "term", "weight")
    )


def region_names(terms: DataFrame) -> DataFrame:
    """(region, label): the best terms of a region in order."""
    ordered = F.array_sort(F.collect_list(F.struct("place", "term")))  # a handful of terms
    return terms.groupBy("region").agg(
        F.array_join(F.transform(ordered, lambda t: t["term"]), " / ").alias("label")
    )


def exemplars(placed: DataFrame, region: str, key: str, top: int = 5) -> DataFrame:
    """(region, place, key): the rows nearest to their region's centre."""
    near = Window.partitionBy(region).orderBy("distance", key)
    return (
        placed.where(F.col(region).isNotNull())
        .withColumn("place", F.row_number().over(near))
        .where(F.col("place") <= top)
        .select(region, "place", key, "distance")
    )


def label_regions(clusters: DataFrame, documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, layer, label) with named regions; gaps are Unlabelled.

    Each text is split into words once. Words are counted by the set of regions of their text, of which
    there are few, before the counts go to the region of every layer.
    """
    region = F.when(F.col("cluster").isNotNull(), F.concat_ws("-", "layer", "cluster"))
    placed = clusters.withColumn("region", region)
    # one region per layer
    inside = placed.where(F.col("region").isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list("region")).alias("_regions"))
    uses = (
        documents.select(key, text).join(inside, key)
        .select("_regions", F.explode(words(F.col(text))).alias("term"))
        .groupBy("_regions", "term")
        .agg(F.count("*").alias("n"))
        .select(F.explode("_regions").alias("region"), "term", "n")
        .groupBy("region", "term")
        .agg(F.sum("n").alias("uses"))
    )
    named = region_names(weigh_terms(uses))
    return placed.join(named, "region", "left").select(
        key, "layer", F.coalesce("label", F.lit(UNLABELLED)).alias("label")
    )


def layer_table(labels: DataFrame, key: str, layers: int = len(LAYERS)) -> DataFrame:
    """One column per layer, label_layer_0 the coarsest."""
    return wide_labels(labels, layers, key)


def layer_summary(labels: DataFrame) -> DataFrame:
    """Distinct names and unlabelled share per layer."""
    return labels.groupBy("layer").agg(
        F.countDistinct("label").alias("names"),
        F.avg((F.col("label") == UNLABELLED).cast("double")).alias("unlabelled"),
    )
