"""Work that must be done once per row, or spread over tasks, on larger tables."""

import numpy as np
from pyspark.sql import functions as F

from renown.operators import bloom, facets, neighbours, ranking, regions
from renown.plans import attention
from renown.sources import dumps
from workload import attention as workload_attention
from workload import cutoffs, roles


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_key_test_works_on_finished_titles(spark):
    text = ['zh-yue.wikipedia "a\\"b" 1 desktop 5 A1', "zh-yue.wikipedia c 1 desktop 2 A1", "en.wikipedia c 1 desktop 3 A1"]
    lines = spark.createDataFrame([(t, "01") for t in text], "value string, month string")
    keys = spark.createDataFrame([("zh_yuewiki", 'a"b'), ("enwiki", "c")], "site string, title string")
    views = dumps.all_site_views(lines, wanted=bloom.key_filter(keys, "site", "title"))
    assert {("zh-yue", 'a"b', 5, "zh_yuewiki"), ("en", "c", 3, "enwiki")} <= {tuple(r) for r in views.select("lang", "title", "views", "site").collect()}
    tests = [line for line in plan(views).splitlines() if "Filter" in line and "xxhash64" in line]
    assert tests and not any("replace(" in line or "substring" in line for line in tests)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_titles_of_all_editions_are_shuffled_once(spark):
    text = ["en.wikipedia a 1 desktop 5 A1", "en.wikipedia a 1 mobile-web 2 A1", "en.wikipedia b 1 desktop 3 A1"]
    text += ["gsw.wikipedia a 1 desktop 4 A1", "als.wikipedia a 1 desktop 1 A1", "en.wikipedia other 1 desktop 9 A1"]
    lines = spark.createDataFrame([(t, m) for t in text for m in ("01", None)], "value string, month string")
    crawled = spark.createDataFrame([("Q1",), (None,)], "qid string")
    links = spark.createDataFrame([(1, 1, "enwiki", "a"), (2, 1, "alswiki", "a"), (3, 2, "enwiki", "other")], "row_id long, item long, site string, title string")
    hops = spark.createDataFrame([("b", "a")], "source_title string, target_title string")
    views = attention.item_views(lines, crawled, links, hops)
    expected = {(1, lang, m, n) for lang, n in (("en", 10), ("gsw", 4), ("als", 1)) for m in ("01", None)}
    shuffles = [line for line in physical(views).splitlines() if "Exchange hashpartitioning" in line and "title" in line]
    assert len(shuffles) == 2 and all("hashpartitioning(site" in line for line in shuffles)
    assert {tuple(r) for r in views.collect()} == expected


def test_sums_per_language_and_item_share_a_shuffle(spark):
    views = spark.createDataFrame([(1, "en", "01", 2), (1, "de", "01", 3)], "item long, lang string, month string, views long")
    assert physical(ranking.global_metrics(views, ["01", "02"])).count("Exchange hashpartitioning") == 1


def test_views_by_language_are_summed_by_month_before_they_are_shuffled(spark):
    text = ["en.wikipedia a 1 desktop 5 A1", "en.wikipedia a 1 mobile-web 2 A1", "en.wikipedia b 1 desktop 3 A1", "gsw.wikipedia a 1 desktop 4 A1"]
    lines = spark.createDataFrame([(t, m) for t in text for m in ("01", "02", "03", None)], "value string, month string")
    crawled = spark.createDataFrame([("Q1",), (None,)], "qid string")
    links = spark.createDataFrame([(1, 1, "enwiki", "a"), (2, 1, "alswiki", "a")], "row_id long, item long, site string, title string")
    hops = spark.createDataFrame([("b", "a")], "source_title string, target_title string")
    parts = [attention.item_views(lines, crawled, links, hops, summed) for summed in (True, False)]
    summed, raw = (ranking.global_metrics(views, ["01", "02"], summed=summed) for summed, views in zip((True, False), parts))
    moved = [line.split("ENSURE")[0] for line in physical(raw).splitlines() if "Exchange hashpartitioning(" in line]
    assert sum("lang#" in line for line in moved) == 1 and not any("month#" in line for line in moved)
    assert [tuple(r) for r in raw.collect()] == [tuple(r) for r in summed.collect()]
    assert (raw.first()["total_views"], raw.first()["top_lang"], parts[1].count()) == (28, "en", 16)


def test_the_registered_rankings_shuffle_no_sums_by_month(spark, tables, monkeypatch):
    seen, real = [], ranking.global_metrics
    monkeypatch.setattr(ranking, "global_metrics", lambda views, *a, **k: seen.append(views) or real(views, *a, **k))
    cutoffs.top_world(spark, tables), cutoffs.both_rankings(spark, tables), workload_attention.global_ranked(spark, tables)
    assert len(seen) == 3 and not any("Aggregate" in plan(views).split("Join")[0] for views in seen)


def test_parts_are_dealt_over_tasks_before_they_become_sitelinks(spark, tmp_path):
    rows = [(i, f"part {i}", "SMALL") for i in range(200)] + [(None, "none", "SMALL"), (3, None, "SMALL")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    links = roles.sitelinks(spark, str(tmp_path))
    assert links.count() == len(rows) * len(roles.SITES)
    held = links.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(held) >= 4 and max(r["count"] for r in held) < links.count() / 2


def test_only_near_pairs_are_scored():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(600, 16)) + 1000.0
    gaps = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(gaps, np.inf)
    limit = np.sort(gaps, axis=1)[:, 4]
    ids = np.arange(600)
    where, to, score = neighbours._below(points, ids, limit, ids, points, (points**2).sum(axis=1), False)
    assert {(a, b) for a, b in zip(where, to)} >= {(a, b) for a, b in zip(*np.nonzero(gaps < limit[:, None] * (1 - 1e-9)))}
    assert len(where) < 600 * 6 and np.allclose(score, gaps[where, to])


def test_a_place_that_is_no_number_hides_no_other():
    points, ids = np.array([[0.0, 0.0], [1.0, 0.0], [np.nan, 0.0], [np.inf, 0.0]]), np.arange(4)
    found = neighbours._below(points, ids, np.full(4, np.inf), ids, points, (points**2).sum(axis=1), False)
    assert {(int(a), int(b)) for a, b in zip(*found[:2])} == {(0, 1), (1, 0)}


def test_blocks_read_a_tile_once_per_strip(spark, monkeypatch):
    """Tiles travel with strips, not with pairs of tiles: each block of strips answers a row at most k times."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(400, 12))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    monkeypatch.setattr(neighbours, "STRIPS", 3)
    found = neighbours._search(df, 5, False, 16).cache()
    assert found.groupBy("id").count().agg(F.max("count")).first()[0] <= 5 * 5
    gaps = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(gaps, np.inf)
    near = neighbours.nearest(df, "id", "v", 5, tile_rows=16)
    got = {(r["id"], r["place"]): r["neighbour"] for r in near.collect()}
    assert got == {(i, j + 1): int(n) for i in range(400) for j, n in enumerate(np.argsort(gaps[i])[:5])}


def test_claims_are_parsed_once_for_all_facets(spark):
    documents = spark.createDataFrame([("Q1", '{"P21":[{"rank":"normal","mainsnak":{"datavalue":{"value":{"id":"G1"}}}}]}'), ("Q2", "{}")], "qid string, claims string")
    labels = spark.createDataFrame([("G1", "one")], "id string, label string")
    resolved = facets.resolve_ids(facets.claim_records(documents), labels, "qid")
    assert "from_json" not in plan(resolved)
    assert {(r["qid"], tuple(r["gender_qids"])) for r in resolved.collect()} == {("Q1", ("one",)), ("Q2", ())}


def test_words_are_counted_by_sets_of_regions(spark, monkeypatch):
    """Not by document, whose counts would all be shuffled."""
    seen = {}
    weigh = regions.weigh_terms
    monkeypatch.setattr(regions, "weigh_terms", lambda uses: seen.setdefault("uses", uses) and weigh(uses))
    documents = spark.createDataFrame([(1, "red red sea"), (2, "blue sea"), (3, None), (None, "lost"), (2, "sky")], "pageid long, text string")
    clusters = spark.createDataFrame([(1, 0, 0), (1, 1, 5), (2, 0, 0), (2, 1, None), (3, 0, 0), (3, 1, 5), (2, 0, 0)], "pageid long, layer int, cluster int")
    labels = regions.label_regions(clusters, documents, "pageid", "text")
    assert labels.count() == clusters.count()
    grouped = [line for line in plan(seen["uses"]).splitlines() if "Aggregate" in line and "term" in line]
    assert grouped and not any("pageid" in line for line in grouped)
    # a repeated document and its repeated place count as often as they meet
    assert {tuple(r) for r in seen["uses"].collect()} == {
        ("0-0", "red", 2), ("0-0", "sea", 3), ("0-0", "blue", 2), ("0-0", "sky", 2), ("1-5", "red", 2), ("1-5", "sea", 1),
    }
