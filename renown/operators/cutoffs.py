"""How far down a ranking to go: shares, cut-offs, samples and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.operators.ordering import running_total

# Fixed values of the cut-off report.
CANDIDATES = [10_000, 25_000, 50_000, 100_000]
SAMPLE_RANKS = [1, 100, 1_000, 5_000, 10_000, 25_000, 50_000, 75_000, 100_000]
SAMPLE_WIDTH = 8
CURVE_POINTS = 2_000
HISTOGRAM_BINS = 80


def cumulative_share(ranked: DataFrame, value: str = "total_views") -> DataFrame:
    """Add the share of all views captured by ranks 1..rank; null where nobody has views.

    A ranking made with ``running={"_running": value}`` is not shuffled again.
    """
    total = ranked.agg(F.sum(value)).scalar()
    summed = ranked if "_running" in ranked.columns else running_total(ranked, value, "_running")
    return summed.withColumn("share", F.try_divide(F.col("_running"), total)).drop("_running")


def candidate_cutoffs(ranked: DataFrame, candidates: list[int] = CANDIDATES) -> DataFrame:
    """Median views at each candidate rank and the share captured down to it."""
    return (
        cumulative_share(ranked)
        .where(F.col("rank").isin(candidates))
        .select(F.col("rank").alias("n"), F.col("median_views").alias("floor_views"), "share")
    )


def rank_samples(
    ranked: DataFrame, starts: list[int] = SAMPLE_RANKS, width: int = SAMPLE_WIDTH
) -> DataFrame:
    """``width`` consecutive ranks from each start; overlapping ranges repeat a row."""
    begins = F.filter(
        F.array(*[F.lit(s).cast("bigint") for s in starts]),
        lambda s: (F.col("rank") >= s) & (F.col("rank") < s + width),
    )
    return ranked.withColumn("start", F.explode(begins))


def rank_curve(ranked: DataFrame, points: int = CURVE_POINTS) -> DataFrame:
    """The rows at about ``points`` log-spaced ranks, both ends included."""
    n = ranked.agg(F.max("rank")).scalar()
    step = F.col("id") / F.lit(points - 1.0)
    picked = (
        ranked.sparkSession.range(points)
        .select(
            F.when(F.col("id") == points - 1, n)
            .otherwise(F.floor(F.pow(n.cast("double"), step)))
            .cast("bigint")
            .alias("rank")
        )
        .distinct()
    )
    return ranked.join(F.broadcast(picked), "rank", "left_semi")  # at most ``points`` rows


def fame_histogram(ranked: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over log10 of the median views, floored at one half."""
    logs = ranked.select(F.log10(F.greatest(F.col("median_views"), F.lit(0.5))).alias("x"))
    span = logs.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    place = F.floor((F.col("x") - lo) / (hi - lo) * bins)
    # all values equal: one bin; the maximum belongs to the last bin
    bin_no = F.when(hi > lo, F.least(place, F.lit(bins - 1))).otherwise(0)
    return logs.groupBy(bin_no.cast("int").alias("bin")).agg(
        F.count("*").alias("entities"), F.min("x").alias("x_min"), F.max("x").alias("x_max")
    )


def zero_median(ranked: DataFrame) -> DataFrame:
    """Entities seen in less than half of the months, and entities never seen."""
    return ranked.agg(
        F.count("*").alias("entities"),
        F.count_if(F.col("median_views") == 0).alias("median_zero"),
        F.count_if(F.col("total_views") == 0).alias("never_seen"),
    )
