"""Data expectations; each returns one row (expectation, violations)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _row(name: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("expectation"), "violations")


def unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """Key values that occur more than once."""
    return _row(name, df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1))


def same_keys(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """Keys that only one of two tables holds; replaces alignment by position."""
    only_left = left.select(key).join(right.select(key), key, "left_anti")
    only_right = right.select(key).join(left.select(key), key, "left_anti")
    return _row(name, only_left.unionByName(only_right))


def same_count(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Difference in row counts, for joins that must not fan out."""
    signed = left.select(F.lit(1).alias("d")).unionByName(right.select(F.lit(-1).alias("d")))
    return signed.agg(F.abs(F.coalesce(F.sum("d"), F.lit(0))).alias("violations")).select(
        F.lit(name).alias("expectation"), "violations"
    )


def layers_refine(labels: DataFrame, name: str) -> DataFrame:
    """1 if the finest layer of (layer, label) has fewer names than the coarsest."""
    per_layer = labels.groupBy("layer").agg(F.countDistinct("label").alias("names"))
    ends = per_layer.agg(F.min_by("names", "layer").alias("coarse"), F.max_by("names", "layer").alias("fine"))
    return ends.select(
        F.lit(name).alias("expectation"), (F.col("fine") < F.col("coarse")).cast("bigint").alias("violations")
    )


def layers_nest(clusters: DataFrame, key: str, name: str) -> DataFrame:
    """Clusters of (key, layer, cluster) whose rows lie in several clusters of the layer before, or in none."""
    inner = clusters.where(F.col("cluster").isNotNull() & (F.col("layer") > 0))
    outer = clusters.select(key, (F.col("layer") + 1).alias("layer"), F.col("cluster").alias("_outer"))
    held = inner.join(outer, [key, "layer"], "left").groupBy("layer", "cluster").agg(
        F.min("_outer").alias("low"), F.max("_outer").alias("high"), F.count_if(F.col("_outer").isNull()).alias("none")
    )
    return _row(name, held.where((F.col("none") > 0) | (F.col("low") != F.col("high"))))


def report(*expectations: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, expectations)


def enforce(expectations: DataFrame) -> None:
    """Raise on the first violated expectation."""
    broken = expectations.where(F.col("violations") > 0).take(1)
    if broken:
        raise ValueError(f"{broken[0]['expectation']}: {broken[0]['violations']} violations")
