"""Comparison of two rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlap(home: DataFrame, world: DataFrame, n: int, key: str = "qid") -> DataFrame:
    """Entities in both top-n lists, as a number and as a share of n."""
    both = (
        home.where(F.col("rank") <= n).select(key)
        .intersect(world.where(F.col("rank") <= n).select(key))
    )
    return both.agg(
        F.count("*").alias("shared"),
        (F.count("*") / F.lit(float(n))).alias("share"),
        (F.lit(n) - F.count("*")).alias("newcomers"),
    )


def newcomers(home: DataFrame, world: DataFrame, n: int, show: int = 25, key: str = "qid") -> DataFrame:
    """In the second top n but not in the first, best ranks first."""
    known = home.where(F.col("rank") <= n).select(key)
    return (
        world.where(F.col("rank") <= n)
        .join(known, key, "left_anti")
        .orderBy("rank")
        .limit(show)
    )


def leavers(home: DataFrame, world: DataFrame, n: int, show: int = 25, key: str = "qid") -> DataFrame:
    """In the first top n but below n in the second, best first ranks first."""
    known = home.where(F.col("rank") <= n).select(key, F.col("rank").alias("home_rank"))
    return (
        world.where(F.col("rank") > n)
        .join(known, key)
        .orderBy("home_rank", "rank")
        .limit(show)
    )
