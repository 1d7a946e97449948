"""Value counts, exact quantiles, coverage and balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.operators.ordering import number_rows, running_total


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, equal counts by value; at most k values."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    if k is None:
        return counts
    return counts.orderBy(F.col("n").desc(), F.col("value").asc()).limit(k)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Chance that two random rows share their label: the sum of squared shares."""
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count("*").alias("n"))
        .select(F.col("n").cast("double").alias("n"))  # squares of large counts leave the range of bigint
        .agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("chance"))
    )


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    """(probability, value) with linear interpolation, nulls skipped.

    Equal values are counted together first; the sorted values are then numbered
    and summed in parallel, so no task holds them all.
    """
    values = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    numbered = number_rows(values, [F.col("v").asc()])
    ordered = running_total(numbered, "n", "upto").withColumn("total", numbered.agg(F.sum("n")).scalar())
    wanted = []
    for p in probabilities:
        place = F.lit(float(p)) * (F.col("total") - 1)
        for side, index in (("low", F.floor(place)), ("high", F.ceil(place))):
            wanted.append(
                F.struct(
                    F.lit(float(p)).alias("p"), F.lit(side).alias("side"),
                    index.alias("index"), (place - F.floor(place)).alias("weight"),
                )
            )
    hits = F.filter(
        F.array(*wanted),
        lambda w: (w["index"] < F.col("upto")) & (w["index"] >= F.col("upto") - F.col("n")),
    )
    ends = ordered.select("v", F.explode(hits).alias("hit"))
    low = F.max(F.when(F.col("hit.side") == "low", F.col("v")))
    high = F.max(F.when(F.col("hit.side") == "high", F.col("v")))
    return ends.groupBy(F.col("hit.p").alias("probability")).agg(
        (low + (high - low) * F.max("hit.weight")).alias("value")
    )


def describe(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    """(statistic, value): count, mean, sample deviation, extremes and exact quantiles."""
    value = F.col(column).cast("double")
    moments = df.agg(
        F.count(column).cast("double").alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).unpivot([], ["count", "mean", "std", "min", "max"], "statistic", "value")
    percent = F.concat((F.col("probability") * 100).cast("int").cast("string"), F.lit("%"))
    quantiles = exact_quantiles(df, column, probabilities).select(percent.alias("statistic"), "value")
    return moments.unionByName(quantiles)


def decade_bounds(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Outer quantiles rounded outwards to whole decades."""
    q = exact_quantiles(df, column, [low, high])
    return q.agg(
        (F.floor(F.min("value") / 10) * 10).alias("low"), (F.ceil(F.max("value") / 10) * 10).alias("high")
    )


def coverage(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """(part, rows, hits, share) of named conditions, in one pass."""
    hits = [F.count_if(condition).alias(name) for name, condition in parts.items()]
    counted = df.agg(F.count("*").alias("rows"), *hits)
    return counted.unpivot(["rows"], list(parts), "part", "hits").withColumn(
        "share", F.when(F.col("rows") > 0, F.col("hits") / F.col("rows"))
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, values): exact distinct counts, null not counted."""
    counted = df.agg(*[F.countDistinct(c).alias(c) for c in columns])
    return counted.unpivot([], columns, "column", "values")
