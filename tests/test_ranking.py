import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from renown.operators import ranking, redirects
from renown.operators.ordering import number_rows, running_total
from renown.plans import attention

MONTHS = [f"2025-{m:02d}" for m in range(1, 13)]
ROSTER = "pageid long, title string, qid string"
VIEWS = "month string, title string, views long"
REDIRECTS = "source_title string, target_title string"


def rank(spark, roster, views, hops=()):
    return attention.rank_home(
        spark.createDataFrame(views, VIEWS),
        spark.createDataFrame(roster, ROSTER),
        spark.createDataFrame(list(hops), REDIRECTS),
        MONTHS,
    )


def test_rename_in_the_window_is_one_entity(spark):
    views = [(m, "Old_name", 10) for m in MONTHS[:6]] + [(m, "New_name", 20) for m in MONTHS[6:]]
    row = rank(spark, [(1, "New name", "Q1")], views, [("Old_name", "New_name")]).first()
    assert (row["n_months"], row["median_views"], row["total_views"]) == (12, 15.0, 180)


def test_titles_that_differ_by_case_stay_apart(spark):
    views = [(m, "Tequila", 1000) for m in MONTHS] + [(m, "TeQuila", 3) for m in MONTHS]
    row = rank(spark, [(1, "TeQuila", "Q1")], views).first()
    assert row["total_views"] == 36


def test_stale_roster_rows_leave(spark):
    ranked = rank(
        spark, [(1, "Merged", "Q1"), (2, "Event", "Q2")], [(MONTHS[0], "Merged", 5)], [("Merged", "Event")]
    )
    assert [(r["title"], r["total_views"]) for r in ranked.collect()] == [("Event", 5)]


def test_never_seen_and_ties(spark):
    roster = [(3, "c", None), (1, "a", None), (2, "b", None)]
    ranked = rank(spark, roster, [(m, "c", 1) for m in MONTHS[:3]])
    got = {r["title"]: (r["rank"], r["median_views"], r["median_present"], r["n_months"]) for r in ranked.collect()}
    assert got == {"c": (1, 0.0, 1.0, 3), "a": (2, 0.0, 0.0, 0), "b": (3, 0.0, 0.0, 0)}


def test_ties_keep_the_crawl_order(spark):
    roster = spark.createDataFrame([(9, "first", None, 0, 0), (3, "second", None, 0, 1), (5, "third", None, 1, 0)],
                                   f"{ROSTER}, line_no int, pos int")
    views = spark.createDataFrame([(m, t, 7) for m in MONTHS for t in ("first", "second", "third")], VIEWS)
    hops = spark.createDataFrame([], REDIRECTS)
    ranked = attention.rank_home(views, roster, hops, MONTHS, ("line_no", "pos"))
    assert [r["title"] for r in ranked.orderBy("rank").collect()] == ["first", "second", "third"]
    top = attention.top_home(views, roster, hops, MONTHS, 2, ("line_no", "pos"))
    assert [(r["rank"], r["title"]) for r in top.orderBy("rank").collect()] == [(1, "first"), (2, "second")]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_a_repeated_title_is_an_error(spark):
    with pytest.raises(ValueError, match="roster titles are unique"):
        rank(spark, [(1, "a", None), (2, "a", None)], [(MONTHS[0], "a", 5)])


def test_only_available_months_count(spark):
    views = spark.createDataFrame([(1, "2025-01", 4), (1, "2025-02", 8)], "entity long, month string, views long")
    for months, median in [(["2025-01", "2025-02"], 6.0), (["2025-01", "2025-02", "2025-03"], 4.0), (["2025-02"], 8.0)]:
        row = ranking.fame_metrics(ranking.monthly_matrix(views, months), months).first()
        assert row["median_views"] == median


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(1)
    matrix = rng.integers(0, 6, size=(200, 12)) * rng.integers(0, 2, size=(200, 12))
    rows = [(i, m, int(v)) for i, r in enumerate(matrix) for m, v in zip(MONTHS, r) if v]
    views = spark.createDataFrame(rows, "entity long, month string, views long")
    entities = spark.range(200).withColumnRenamed("id", "entity")
    columns = [ranking.month_column(m) for m in MONTHS]
    filled = entities.join(ranking.monthly_matrix(views, MONTHS), "entity", "left").na.fill(0, columns)
    got = ranking.rank_by_fame(ranking.fame_metrics(filled, MONTHS), "entity").toPandas().sort_values("entity")
    np.testing.assert_array_equal(got["median_views"], np.median(matrix, axis=1))
    np.testing.assert_array_equal(got["total_views"], matrix.sum(axis=1))
    np.testing.assert_array_equal(got["max_views"], matrix.max(axis=1))
    np.testing.assert_array_equal(got["n_months"], (matrix > 0).sum(axis=1))
    present = [np.median(r[r > 0]) if (r > 0).any() else 0 for r in matrix]
    np.testing.assert_array_equal(got["median_present"], present)
    frame = pd.DataFrame({"m": np.median(matrix, axis=1), "t": matrix.sum(axis=1)})
    order = frame.sort_values(["m", "t"], ascending=False, kind="mergesort").index
    assert list(got.sort_values("rank")["entity"]) == list(order)


def test_lookup_equals_resolution(spark):
    roster = spark.createDataFrame([(1, "A b", "Q1"), (2, "C", "Q2")], ROSTER)
    hops = spark.createDataFrame([("x", "A_b"), ("y", "Nowhere"), ("z", "C")], REDIRECTS)
    views = spark.createDataFrame([("m", t, 1) for t in ("A_b", "x", "y", "z", "C", "a_b")], VIEWS)
    folded = views.join(redirects.home_lookup(roster, hops), "title").groupBy("pageid").agg(F.sum("views").alias("v"))
    resolved = (
        redirects.resolve_titles(views, hops).join(roster, "title").groupBy("pageid").agg(F.sum("views").alias("v"))
    )
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, resolved.collect())) == [(1, 2), (2, 2)]


def test_sitelink_beats_redirect_and_last_sitelink_wins(spark):
    links = spark.createDataFrame(
        [(1, 10, "enwiki", "A"), (2, 11, "enwiki", "A"), (3, 12, "enwiki", "B"), (4, 13, "dewiki", "A")],
        "row_id long, item long, site string, title string",
    )
    hops = spark.createDataFrame([("B", "A"), ("alias", "A"), ("lost", "Nowhere")], REDIRECTS)
    got = {(r["site"], r["title"]): r["item"] for r in redirects.site_lookup(links, hops).collect()}
    assert got == {("enwiki", "A"): 11, ("enwiki", "B"): 12, ("enwiki", "alias"): 11, ("dewiki", "A"): 13}


def test_global_metrics(spark):
    rows = [
        (1, "de", "2025-01", 10), (1, "en", "2025-02", 10), (1, "fr", "2025-02", 3),
        (2, "fr", "2025-01", 5), (3, "en", "2025-01", 0),
    ]
    views = spark.createDataFrame(rows, "item long, lang string, month string, views long")
    got = {r["item"]: r for r in ranking.global_metrics(views, ["2025-01", "2025-02"]).collect()}
    assert (got[1]["top_lang"], got[1]["median_views"], got[1]["total_views"]) == ("de", 11.5, 23)
    assert got[1]["english_share"] == pytest.approx(10 / 23, abs=1e-7)
    assert (got[2]["top_lang"], got[2]["english_share"]) == ("fr", 0.0)
    assert (got[3]["total_views"], got[3]["english_share"]) == (0, 0.0)


def test_repeated_qid_fans_out(spark):
    metrics = spark.createDataFrame([(1, 5.0, 10)], "item long, median_views double, total_views long")
    home = spark.createDataFrame(
        [("Q1", 7, "a", 1, 5.0), ("Q1", 8, "b", 2, 4.0), (None, 9, "c", 3, 1.0)],
        "qid string, pageid long, title string, rank long, median_views double",
    )
    got = ranking.global_ranking(metrics, home).orderBy("rank").collect()
    assert [(r["rank"], r["title"], r["enwiki_rank"]) for r in got] == [(1, "a", 1), (2, "b", 2)]


@pytest.mark.parametrize("hot", [0, 1])
def test_number_rows_and_running_total(spark, hot):
    # a third of the rows share one sort value, or all rows one group
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("v"),
        (F.lit(0) if hot else F.col("id") % 5).alias("g"),
    )
    pdf = df.toPandas()
    numbered = number_rows(df, [F.col("v").desc(), F.col("id").asc()])
    got = numbered.toPandas().sort_values("rank")
    assert list(got["rank"]) == list(range(1, 3001))
    assert list(got["id"]) == list(pdf.sort_values(["v", "id"], ascending=[False, True])["id"])
    summed = running_total(numbered, "v", "upto").toPandas().sort_values("rank")
    assert list(summed["upto"]) == list(got["v"].cumsum())
    once = number_rows(df, [F.col("v").desc(), F.col("id").asc()], running={"upto": "v"})
    assert list(once.toPandas().sort_values("rank")["upto"]) == list(got["v"].cumsum())
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Exchange hashpartitioning" not in plan
    within = number_rows(df, [F.col("v").asc(), F.col("id").asc()], within=("g",)).toPandas()
    expected = pdf.sort_values(["v", "id"]).groupby("g").cumcount() + 1
    assert dict(zip(within["id"], within["rank"])) == dict(zip(pdf.loc[expected.index, "id"], expected))
