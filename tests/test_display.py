from html import escape
from urllib.parse import quote

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from renown.functions import display as D
from renown.functions import texts as X
from renown.operators import facets


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


TEXT = st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=30)
CHECKS = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@CHECKS
@given(st.lists(TEXT, min_size=20, max_size=60))
def test_escape_and_url_match_python(spark, values):
    assert apply(spark, D.escape_html, values) == [escape(v) for v in values]
    expected = [D.ARTICLE_PREFIX + quote(v.replace(" ", "_")) for v in values]
    assert apply(spark, D.article_url, values) == expected


def test_title_case(spark):
    values = ["singer-songwriter", "FILM director", "they're bill's", "2nd élan", "", "x"]
    assert apply(spark, D.title_case, values) == [v.title() for v in values]


def test_views_label(spark):
    values = [0.0, 0.5, 1.5, 2.5, 999.5, 1234.0, 9999.4, 9999.5, 10000.0, 10500.0, 11500.0, 12345.5, 1e7]
    expected = [f"{v / 1000:.0f}k" if v >= 10_000 else f"{v:,.0f}" for v in values]
    assert apply(spark, D.views_label, values, "double") == expected


def test_born_label_and_excerpt(spark):
    assert apply(spark, D.born_label, [1990, None], "int") == ["b. 1990", "b. ?"]
    assert apply(spark, D.excerpt, ["<" + "x" * 500, None]) == ["&lt;" + "x" * 479, ""]


def test_embed_text_and_label_document(spark):
    rows = [
        (0, "T", "d", "l" * 40), (1, "T", " d ", " " + "l" * 39 + "\n"), (2, "T", None, None), (3, "T", "  ", "x"),
        (4, "T", "d", "y" * 3000),
    ]
    df = spark.createDataFrame(rows, "i int, t string, d string, l string").orderBy("i")
    columns = F.col("t"), F.col("d"), F.col("l")
    got = df.select(X.embed_text(*columns), X.label_document(*columns)).collect()
    assert [r[0] for r in got] == ["l" * 40, "T. d", "T", "T", "y" * 3000]
    assert [r[1] for r in got][:4] == [
        "T -- d\n" + "l" * 40, "T --  d \n " + "l" * 39 + "\n", "T", "T --   \nx",
    ]
    assert len(got[4][1]) == 2000


def test_top_or_other_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "aabbccd"] + [(None,)], "v string")
    got = [r["v"] for r in facets.top_or_other(df, "v", 2).collect()]
    assert sorted(got) == ["Other"] * 4 + ["a", "a", "b", "b"]
    legend = [r["value"] for r in facets.legend(facets.top_or_other(df, "v", 2), "v").collect()]
    assert legend == ["a", "b", "Other"]


def test_map_features_edge_cases(spark):
    texts = spark.createDataFrame(
        [(1, "A", 1, 0.0, 5, 5, None, None, None), (2, "B", 2, 0.0, 0, 0, "x", "d", "t")],
        "pageid long, title string, rank long, median_views double, total_views long, max_views long, "
        "lead string, description string, thumb_url string",
    )
    rows = spark.createDataFrame(
        [(1, "Q1", 1990, "female", ["Peru"], ["actor-singer"])],
        "pageid long, qid string, birth_year int, gender string, citizenships array<string>, occupations array<string>",
    )
    labels = spark.createDataFrame([(1, 0, "top"), (1, 10, "deep"), (1, 2, "mid")], "pageid long, layer int, label string")
    wide = facets.wide_labels(labels, 11)
    got = {r["pageid"]: r for r in facets.map_features(texts, rows, wide).collect()}
    assert got[1]["occupation"] == "Actor-Singer" and got[1]["gender"] == "Female"
    assert got[2]["occupation"] == got[2]["citizenship"] == got[2]["gender"] == "Unknown"
    assert got[1]["marker_size"] == got[2]["marker_size"] == 2.5  # equal views
    assert got[1]["label_layer_10"] == "deep" and got[2]["label_layer_0"] == "Unlabelled"
    assert wide.columns[-1] == "label_layer_10"
    assert abs(got[1]["volatility"] - 0.69897) < 1e-4 and got[2]["volatility"] == 0.0


def test_map_has_points_and_bounds_and_raises_on_broken_joins(spark):
    texts = spark.range(1, 5).selectExpr(
        "id AS pageid", "concat('T', id) AS title", "id AS rank", "1.5D AS median_views", "3L AS total_views", "2L AS max_views",
        "string(NULL) AS lead", "string(NULL) AS description", "string(NULL) AS thumb_url",
    )
    rows = spark.range(1, 4).selectExpr(
        "id AS pageid", "'Q' AS qid", "int(1950 + 7 * id) AS birth_year", "string(NULL) AS gender",
        "array('Peru') AS citizenships", "array('poet') AS occupations",
    )
    points = spark.range(1, 5).selectExpr("id AS pageid", "id / 2D AS x", "-id / 2D AS y")
    got = {r["pageid"]: r for r in facets.map_features(texts, rows, points=points).collect()}
    assert (got[3]["x"], got[3]["y"]) == (1.5, -1.5) and {(r["birth_low"], r["birth_high"]) for r in got.values()} == {(1950, 1980)}
    nobody = facets.map_features(texts, rows.limit(0), points=points).collect()
    assert len(nobody) == 4 and {(r["birth_low"], r["birth_high"]) for r in nobody} == {(None, None)}
    with pytest.raises(ValueError, match="has a point"):
        facets.map_features(texts, rows, points=points.where("pageid < 4"))
    with pytest.raises(ValueError, match="has a point"):
        facets.map_features(texts.where("pageid < 4"), rows, points=points)
    with pytest.raises(ValueError, match="once"):
        facets.map_features(texts, rows.unionByName(rows.where("pageid = 2")), points=points)
    upside_down = spark.range(1, 5).selectExpr("id AS pageid", "string(id) AS label_layer_0", "'one' AS label_layer_1")
    with pytest.raises(ValueError, match="finer layers"):
        facets.map_features(texts, rows, upside_down, points)
