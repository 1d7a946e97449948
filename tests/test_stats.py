import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from renown.operators import cutoffs, rosters, stats


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=500), np.full(300, 0.25)])
    frame = pd.DataFrame({"x": values, "k": rng.integers(0, 4, 800).astype(str)})
    return frame, spark.createDataFrame(frame).unionByName(
        spark.createDataFrame([(None, None)], "x double, k string")
    )


def test_quantiles_match_numpy(numbers):
    frame, df = numbers
    probabilities = [0.0, 0.01, 0.1, 0.333, 0.5, 0.9, 0.99, 1.0]
    got = {r["probability"]: r["value"] for r in stats.exact_quantiles(df, "x", probabilities).collect()}
    for p in probabilities:
        assert got[p] == pytest.approx(np.quantile(frame["x"], p), abs=1e-12)


def test_describe_matches_pandas(numbers):
    frame, df = numbers
    got = {r["statistic"]: r["value"] for r in stats.describe(df, "x", [0.1, 0.25, 0.5, 0.75, 0.9]).collect()}
    expected = frame["x"].describe(percentiles=[0.1, 0.25, 0.5, 0.75, 0.9])
    assert set(got) == set(expected.index)
    for name, value in expected.items():
        assert got[name] == pytest.approx(value)


def test_decade_bounds(spark):
    df = spark.createDataFrame([(y,) for y in range(1904, 2008)] + [(None,)], "y int")
    assert tuple(stats.decade_bounds(df, "y").first()) == (1900, 2010)


def test_balance_counts_and_coverage(numbers):
    frame, df = numbers
    shares = frame["k"].value_counts(normalize=True)
    assert stats.class_balance(df, "k").first()[0] == pytest.approx((shares**2).sum())
    counts = stats.value_counts(df, "k", 2).collect()
    assert [r["n"] for r in counts] == list(frame["k"].value_counts().head(2))
    row = stats.coverage(df, {"known": F.col("x").isNotNull()}).first()
    assert (row["rows"], row["hits"]) == (801, 800)


def ranked(spark, medians):
    rows = [(i + 1, f"Q{i}", f"t{i}", float(m), int(m * 12), 12) for i, m in enumerate(medians)]
    return spark.createDataFrame(
        rows, "rank long, qid string, title string, median_views double, total_views long, n_months int"
    )


def test_shares_and_samples(spark):
    medians = sorted(np.random.default_rng(5).integers(0, 1000, 300), reverse=True)
    df = ranked(spark, medians)
    got = cutoffs.cumulative_share(df).orderBy("rank").toPandas()
    total = np.array([int(m * 12) for m in medians])
    np.testing.assert_allclose(got["share"], total.cumsum() / total.sum())
    cut = cutoffs.candidate_cutoffs(df, [10, 300, 999]).orderBy("n").collect()
    assert [(r["n"], r["floor_views"]) for r in cut] == [(10, medians[9]), (300, medians[299])]
    assert cut[1]["share"] == 1.0
    sample = cutoffs.rank_samples(df, [1, 5, 298]).orderBy("start", "rank").collect()
    assert [(r["start"], r["rank"]) for r in sample] == (
        [(1, i) for i in range(1, 9)] + [(5, i) for i in range(5, 13)] + [(298, i) for i in range(298, 301)]
    )
    curve = [r["rank"] for r in cutoffs.rank_curve(df, 50).orderBy("rank").collect()]
    assert curve[0] == 1 and curve[-1] == 300 and len(curve) == len(set(curve)) <= 50


def test_histogram(spark):
    df = ranked(spark, [1000, 100, 100, 10, 1, 0, 0])
    got = {r["bin"]: r["entities"] for r in cutoffs.fame_histogram(df, 4).collect()}
    logs = np.log10(np.maximum([1000, 100, 100, 10, 1, 0, 0], 0.5))
    counts, _ = np.histogram(logs, bins=4)
    assert got == {i: c for i, c in enumerate(counts) if c}
    same = cutoffs.fame_histogram(ranked(spark, [5, 5]), 4).collect()
    assert [(r["bin"], r["entities"]) for r in same] == [(0, 2)]
    assert tuple(cutoffs.zero_median(df).first()) == (7, 2, 2)


def test_roster_comparison(spark):
    home, world = ranked(spark, [9, 8, 7, 6]), ranked(spark, [9, 8, 7, 6]).withColumn("rank", 5 - F.col("rank"))
    assert tuple(rosters.overlap(home, world, 3).first()) == (2, pytest.approx(2 / 3), 1)
    assert [r["qid"] for r in rosters.newcomers(home, world, 2).collect()] == ["Q3", "Q2"]
    assert [(r["qid"], r["home_rank"], r["rank"]) for r in rosters.leavers(home, world, 2).collect()] == [
        ("Q0", 1, 4), ("Q1", 2, 3),
    ]


def test_balance_of_very_large_classes(spark):
    """Counts beyond the root of the largest bigint."""
    n = F.lit(4_000_000_000).cast("double")
    assert spark.range(1).select(n * n).first()[0] == 1.6e19
    assert stats.class_balance(spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string"), "k").first()[0] == 5 / 9


def test_shares_without_any_views(spark):
    ranked = spark.createDataFrame([(1, 0), (2, 0)], "rank long, total_views long")
    assert [r["share"] for r in cutoffs.cumulative_share(ranked).collect()] == [None, None]
