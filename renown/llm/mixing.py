"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

The mix keeps the token distribution as close as possible (in relative entropy) to the
corpus while the tokens of each source meet its target. The convex dual has one
multiplier per source; its solution tilts the rate of every document exponentially,
rate = exp(multiplier of its source). Newton steps on the dual run as Spark
aggregates over per-source sums. The rates are then rounded into whole copies by
systematic rounding along the documents of a source in order of size, which keeps the
words taken within one document of the source's target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renown.operators.ordering import number_rows
from renown.session import stage

WORD = r"[^\x20\x09-\x0D]+"
_SOURCE = ("_null", "_source")
# start of the systematic rounding inside a unit step
_PHASE = 0.381966


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_rate: float = 2.0
) -> DataFrame:
    """Add ``target`` to rows (_null, _source, source_size).

    Sources in code point order, null last, take the weights in turn and share
    ``share`` of all sizes. No target exceeds ``max_rate`` times its source; the excess
    goes to the others by weight until none is above. In order of size per weight the
    capped sources come first, so the common level is found from two running sums.
    The windows see one row per source.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(Window.orderBy(*_SOURCE)) - 1
    weighted = sources.withColumn("_weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))))
    order = Window.orderBy(F.col("source_size") / F.col("_weight"), *_SOURCE)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    cap = max_rate * F.col("source_size")
    every = Window.partitionBy()
    level = (
        (F.sum("source_size").over(every) * share - F.coalesce(F.sum(cap).over(earlier), F.lit(0.0)))
        / F.sum("_weight").over(later)
    )
    fits = F.col("_level") * F.col("_weight") <= cap
    return (
        weighted.withColumn("_level", level)
        .withColumn("_level", F.min(F.when(fits, F.struct(F.col("source_size") / F.col("_weight"), *_SOURCE, "_level"))).over(every)["_level"])
        .withColumn("target", F.coalesce(F.least(cap, F.col("_level") * F.col("_weight")), cap))
        .drop("_level", "_weight")
    )


def dual_multipliers(sources: DataFrame, max_steps: int = 40, tolerance: float = 1e-14) -> DataFrame:
    """Newton steps on the dual, from rows with source_size and target.

    Per source the slope of the dual is size * exp(m) - target and its curvature
    size * exp(m); steps from the right of the optimum fall to it monotonically.
    Sources without tokens keep a null multiplier. Each step is written, so the plan
    does not grow with the number of steps.
    """
    mass = F.col("source_size") * F.exp("multiplier")
    at = stage(
        sources.withColumn("multiplier", F.when(F.col("source_size") > 0, F.lit(1.0))), "mixing-dual"
    )
    for _ in range(max_steps):
        moved = at.withColumn("_step", (mass - F.col("target")) / mass)
        at = stage(moved.withColumn("multiplier", F.col("multiplier") - F.col("_step")), "mixing-dual")
        if (at.agg(F.max(F.abs("_step"))).first()[0] or 0.0) < tolerance:
            break
        at = at.drop("_step")
    return at.drop("_step")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    max_rate: float = 2.0,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """How often each document goes into the mix.

    Columns: ``record`` (struct of the ``carry`` columns, default all), ``size`` (words),
    ``source_size``, ``target`` (of its source), ``rate``, ``copies`` and ``taken``
    (size * copies). A null text has size 0; documents without words take the rate of
    their source; a source without words has target 0 and rate 0. A null source is a
    source of its own. Repeated rows are separate documents. An empty table gives no rows.

    A source of any size is one run of range partitions, never one task, and only slim
    rows travel unless ``carry`` asks for more.
    """
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(
        F.struct(*[F.col(c) for c in (carry or docs.columns)]).alias("record"),
        words.alias("size"),
        F.col(source).isNull().alias("_null"),
        F.coalesce(F.col(source), F.lit("")).alias("_source"),
        F.col(key).alias("_key"),
        F.xxhash64(F.col(text)).alias("_tie"),
    )
    order = [F.col("size").asc(), F.col("_key").asc_nulls_last(), F.col("_tie").asc()]
    ranked = number_rows(rows, order, "_rank", within=_SOURCE)
    sizes = ranked.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    duals = dual_multipliers(source_targets(sizes, weights, share, max_rate))
    rates = duals.withColumn("rate", F.coalesce(F.least(F.exp("multiplier"), F.lit(max_rate)), F.lit(0.0)))
    passed = lambda rank: F.floor(rank * F.col("rate") + F.lit(_PHASE))
    return (
        ranked.join(rates, list(_SOURCE))
        .withColumn("copies", (passed(F.col("_rank")) - passed(F.col("_rank") - 1)).cast("int"))
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select("record", "size", "source_size", "target", "rate", "copies", "taken")
    )
