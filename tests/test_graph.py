import numpy as np
import pytest
from pyspark.sql import functions as F

from renown.operators import density, graph, neighbours
from tests.test_vectors import brute, frame


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_graph_search_recalls_nine_tenths(spark, metric):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(900, 16))
    points[200:260] = points[0]
    ids = rng.permutation(5000)[:900]
    df = frame(spark, ids, points).unionByName(spark.createDataFrame([(9000, None)], "id long, v array<double>"))
    got = {(r["id"], r["neighbour"], r["place"]) for r in graph.knn_graph(df, "id", "v", 8, metric).collect()}
    expected = brute(ids, points, 8, metric)
    # equal vectors tie by key in both, so most places agree as well
    assert len(got) == len(expected)
    assert len({(a, b) for a, b, _ in got} & {(a, b) for a, b, _ in expected}) >= 0.9 * len(expected)


def test_graph_scores_are_those_of_the_exact_search(spark):
    df = frame(spark, np.arange(60), np.random.default_rng(4).normal(size=(60, 3)))
    for metric in ("euclidean", "cosine"):
        exact = {(r["id"], r["place"]): (r["neighbour"], round(r["score"], 9)) for r in neighbours.nearest(df, "id", "v", 4, metric).collect()}
        got = {(r["id"], r["place"]): (r["neighbour"], round(r["score"], 9)) for r in graph.knn_graph(df, "id", "v", 4, metric).collect()}
        assert got == exact


def test_graph_of_floats_in_small_batches_is_the_exact_one(spark):
    points = np.random.default_rng(6).normal(size=(50, 3)).astype("f4")
    df = frame(spark, np.arange(50), points.astype("f8")).select("id", F.col("v").cast("array<float>").alias("v"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for metric in ("euclidean", "cosine"):
            got = {(r["id"], r["neighbour"], r["place"]) for r in graph.knn_graph(df, "id", "v", 4, metric).collect()}
            assert got == set(brute(np.arange(50), points.astype("f8"), 4, metric))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_graph_moves_only_lists_that_hold_something_new(spark, monkeypatch):
    moved, meet = [], graph._meet

    def counted(members, *rest):
        moved.append(members.count())
        return meet(members, *rest)

    monkeypatch.setattr(graph, "_meet", counted)
    df = frame(spark, np.arange(600), np.random.default_rng(7).normal(size=(600, 8)))
    graph.knn_graph(df, "id", "v", 4).count()
    rounds = moved[graph.DIRECTIONS :]
    assert len(rounds) > 1 and rounds[-1] < rounds[0] / 2


def test_graph_of_few_or_no_rows(spark):
    df = frame(spark, np.arange(2), np.eye(2))
    assert sorted((r["id"], r["neighbour"]) for r in graph.knn_graph(df, "id", "v", 5).collect()) == [(0, 1), (1, 0)]
    assert graph.knn_graph(df.where("id < 0"), "id", "v", 5).count() == 0
    with pytest.raises(ValueError):
        graph.knn_graph(df, "id", "v", 5, "manhattan")


def walk(pairs, n):
    w = np.zeros((n, n))
    for a, b, x in pairs:
        w[a, b] = w[b, a] = x
    half = np.sqrt(w.sum(axis=1))
    values, vectors = np.linalg.eigh((np.eye(n) + w / half[:, None] / half[None, :]) / 2)
    return values[::-1], vectors[:, ::-1] / (half / np.sqrt((half**2).sum()))[:, None]


def axes_of(spark, pairs, n):
    edges = spark.createDataFrame(pairs, "id long, neighbour long, w double")
    placed, values = graph.graph_axes(graph.undirected(edges, "id", weight=F.col("w")))
    rows = {r["id"]: r["axis"] for r in placed.collect()}
    return np.array([rows[i] for i in range(n)]), values


def test_axes_of_a_path_match_numpy(spark):
    rng = np.random.default_rng(5)
    pairs = [(i, i + 1, float(rng.uniform(0.5, 2))) for i in range(24)]
    got, found = axes_of(spark, pairs, 25)
    values, vectors = walk(pairs, 25)
    assert np.allclose(found, values[1:3], atol=1e-9)
    for j in range(2):
        axis = vectors[:, j + 1] * np.sign(vectors[:, j + 1] @ got[:, j])
        assert np.allclose(got[:, j], axis, atol=1e-4)


def test_axes_of_a_ring_span_the_same_plane(spark):
    pairs = [(i, (i + 1) % 13, 1.0) for i in range(13)]
    got, found = axes_of(spark, pairs, 13)
    values, vectors = walk(pairs, 13)
    assert np.allclose(found, values[1:3], atol=1e-9)
    plane = vectors[:, 1:3]
    assert np.allclose(got @ got.T, plane @ plane.T, atol=1e-4)
    # a ring again: all points have one distance from the middle
    assert np.allclose((got**2).sum(axis=1), 2, atol=1e-4)


def test_axes_need_enough_nodes_and_convergence(spark):
    links = graph.undirected(spark.createDataFrame([(1, 2), (2, 2)], "id long, neighbour long"), "id")
    with pytest.raises(ValueError):
        graph.graph_axes(links)
    path = spark.range(300).select("id", (F.col("id") + 1).alias("neighbour"))
    with pytest.raises(RuntimeError):
        graph.graph_axes(graph.undirected(path, "id"), columns=6, restarts=1)


def flood(counts, least):
    """Brute force: smallest cell of each connected group."""
    left, found = {c for c, n in counts.items() if n >= least}, {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            c = todo.pop()
            group.append(c)
            near = {o for o in left if abs(o[0] - c[0]) <= 1 and abs(o[1] - c[1]) <= 1}
            left -= near
            todo += near
        found |= {c: min(group) for c in group}
    return found


def test_regions_match_flooding_and_nest(spark):
    rng = np.random.default_rng(6)
    points = np.vstack([rng.normal(size=(300, 2)), rng.normal(size=(200, 2)) / 2 + [5, 5], rng.uniform(-4, 8, size=(100, 2))])
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(points)] + [(900, None, 1.0), (901, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    shares = [0.9, 0.5, 0.2]
    box = (-4.0, -4.0, 8.0, 8.0)
    got = {(r["id"], r["layer"]): r["cluster"] for r in density.density_layers(df, "id", bins=24, shares=shares, box=box).collect()}
    cell = {i: tuple(int(min(23, max(0, np.floor((v + 4) / 12 * 24)))) for v in p) for i, p in enumerate(points)}
    counts = {}
    for c in cell.values():
        counts[c] = counts.get(c, 0) + 1
    for layer, share in enumerate(shares):
        least = max(n for n in set(counts.values()) if sum(m for m in counts.values() if m >= n) >= share * len(points))
        region = flood(counts, least)
        for i, c in cell.items():
            own = region.get(c)
            assert got[i, layer] == (None if own is None else own[0] * 2**32 + own[1])
        assert got[900, layer] is None and got[901, layer] is None
    outer = {}
    for i in cell:
        for layer in (1, 2):
            if got[i, layer] is not None:
                assert got[i, layer - 1] is not None
                assert outer.setdefault((layer, got[i, layer]), got[i, layer - 1]) == got[i, layer - 1]


def test_a_snake_of_cells_is_one_region(spark):
    snake = [(0, r) for r in range(60)] + [(1, 59)] + [(2, r) for r in range(60)] + [(3, 0)] + [(4, r) for r in range(60)]
    cells = spark.createDataFrame([(a * 2**32 + b, 3) for a, b in snake] + [(9 * 2**32, 3)], "_cell long, n long")
    regions = density.cell_regions(cells, [1.0])
    tree = {r["region"]: (r["parent"], r["cells"], r["points"]) for r in density.region_tree(regions).collect()}
    assert tree == {0: (None, 182, 546), 9 * 2**32: (None, 1, 3)}


def test_density_of_odd_tables(spark):
    empty = spark.createDataFrame([], "id long, x double, y double")
    assert density.density_layers(empty, "id").count() == 0
    one = spark.createDataFrame([(1, 2.0, 2.0), (2, 2.0, 2.0)], "id long, x double, y double")
    assert {r["cluster"] for r in density.density_layers(one, "id").collect()} == {0}
    with pytest.raises(ValueError):
        density.density_layers(one, "id", shares=[0.3, 0.6])
