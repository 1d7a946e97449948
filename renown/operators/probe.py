"""Stratified split, linear probe and exact ROC area."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.operators import erasure
from renown.operators.ordering import number_rows, running_total
from renown.session import stage

# Fixed values of the probe protocol.
TEST_SHARE, SEED, INVERSE_PENALTY, MAX_ITERATIONS = 0.2, 42, 1.0, 2000


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Add ``is_test``: an exact share of each class, chosen by a hash of key and seed."""
    mixed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    numbered = number_rows(
        df.where(F.col(label).isNotNull()).withColumn("_mix", mixed),
        [F.col("_mix").asc(), F.col(key).asc()], "_place", within=(label,),
    )
    sizes = numbered.groupBy(label).agg(F.count("*").alias("_n"))
    return (
        numbered.join(sizes, label)
        .withColumn("is_test", F.col("_place") <= F.round(F.col("_n") * test_share))
        .drop("_mix", "_place", "_n")
    )


def roc_auc(scored: DataFrame, score: str, positive: str) -> DataFrame:
    """One row: the exact area under the ROC curve; equal scores count one half.

    Rows are counted per score first, then summed along the sorted scores in parallel.
    """
    hit = F.col(positive).cast("boolean")
    per_score = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")
    )
    numbered = number_rows(per_score, [F.col("score").asc()])
    below = running_total(numbered, "neg", "upto")
    wins = F.col("pos") * (F.col("upto") - F.col("neg") + F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return below.agg(F.when(pairs > 0, F.sum(wins) / pairs).alias("auc"))


def probe_auc(
    df: DataFrame, key: str, vector: str, concept: str, method: str = "raw", seed: int = SEED
) -> DataFrame:
    """Held-out area of a linear probe after an erasure.

    The split comes first and the eraser sees the training rows only. Fitted on
    all rows, its class gap would be zero over both parts together, hence
    opposite in them, and the held-out area would fall below chance.
    """
    return probe_split(split_vectors(df, key, vector, concept, seed), key, vector, concept, method)


def split_vectors(df: DataFrame, key: str, vector: str, concept: str, seed: int = SEED) -> DataFrame:
    """The labelled rows with ``is_test``, written once for all probes."""
    return stage(stratified_split(df.select(key, vector, concept), key, concept, seed=seed), "probe")


def probe_split(rows: DataFrame, key: str, vector: str, concept: str, method: str) -> DataFrame:
    """(variant, auc) of a probe on rows that are split already."""
    train = rows.where(~F.col("is_test"))
    if method == "raw":
        cleaned = rows
    else:
        fit = {"centroid": erasure.fit_centroid, "leace": erasure.fit_leace}[method]
        cleaned = erasure.erase(rows, vector, fit(train, vector, concept), as_float=False)
    weights, intercept, _ = fit_probe(cleaned.where(~F.col("is_test")), vector, concept)
    scored = cleaned.where(F.col("is_test")).select(
        margin(F.col(vector), weights, intercept).alias("score"), F.col(concept).cast("boolean").alias("hit")
    )
    return roc_auc(scored, "score", "hit").select(F.lit(method).alias("variant"), "auc")


def fit_probe(training: DataFrame, vector: str, concept: str, tolerance: float = 1e-6) -> tuple[list[float], float, float]:
    """Weights, intercept and penalty of the logistic probe."""
    rows = training.select(
        F.col(concept).cast("double").alias("y"), array_to_vector(F.col(vector).cast("array<double>")).alias("features")
    )
    penalty = 1.0 / (INVERSE_PENALTY * rows.count())
    model = LogisticRegression(
        labelCol="y", maxIter=MAX_ITERATIONS, regParam=penalty, elasticNetParam=0.0, standardization=False, tol=tolerance,
    ).fit(rows)
    return model.coefficients.toArray().tolist(), float(model.intercept), penalty


def margin(vector: Column, weights: list[float], intercept: float) -> Column:
    """The score before the logistic curve, as a plain expression; it orders rows as the probability does."""
    products = F.zip_with(vector.cast("array<double>"), F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w)
    return F.aggregate(products, F.lit(intercept), lambda total, x: total + x)


def certificate(training: DataFrame, vector: str, concept: str, weights: list[float], intercept: float, penalty: float) -> DataFrame:
    """(pos, gradient) of the penalised loss at given weights; position -1 is the intercept.

    The loss is convex, so the weights are the optimum exactly where all gradients are zero.
    """
    error = 1 / (1 + F.exp(-margin(F.col(vector), weights, intercept))) - F.col(concept).cast("double")
    rows = training.select(error.alias("error"), F.concat(F.array(F.lit(1.0)), F.col(vector).cast("array<double>")).alias("x"))
    cells = rows.select("error", F.posexplode("x").alias("place", "x"))
    weight = F.get(F.array(F.lit(0.0), *[F.lit(w) for w in weights]), F.col("place"))
    return cells.groupBy("place").agg(F.avg(F.col("error") * F.col("x")).alias("loss")).select(
        (F.col("place") - 1).alias("pos"), (F.col("loss") + penalty * weight).alias("gradient")
    )
