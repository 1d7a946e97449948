import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from renown.operators import erasure, layout, neighbours, probe, regions


def brute(ids, points, k, metric):
    if metric == "cosine":
        unit = points / np.linalg.norm(points, axis=1, keepdims=True)
        score = -np.round(unit @ unit.T, 12)
    else:
        score = ((points[:, None, :] - points[None, :, :]) ** 2).sum(-1)
    out = set()
    for i, own in enumerate(ids):
        order = [j for j in np.lexsort((ids, score[i])) if j != i][:k]
        out |= {(int(own), int(ids[j]), place + 1) for place, j in enumerate(order)}
    return out


def frame(spark, ids, points):
    return spark.createDataFrame(pd.DataFrame({"id": ids, "v": list(points.tolist())}))


@pytest.mark.parametrize("shape", ["spread", "third equal", "far groups", "few"])
def test_neighbours_equal_brute_force_in_the_plane(spark, shape):
    rng = np.random.default_rng(7)
    points = np.round(rng.normal(size=(400, 2)) * 5, 1)
    if shape == "third equal":
        points[:140] = [1.0, 2.0]
    elif shape == "far groups":
        points[:5] += 1e4
        points[200:] -= 1e3
    elif shape == "few":
        points = points[:4]
    ids = rng.permutation(len(points) * 3)[: len(points)]
    got = neighbours.nearest(frame(spark, ids, points), "id", "v", 6, tile_rows=40)
    assert {(r["id"], r["neighbour"], r["place"]) for r in got.collect()} == brute(ids, points, 6, "euclidean")


def test_cosine_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(150, 20))
    points[100:120] = points[0]
    ids = np.arange(150)
    df = frame(spark, ids, points).unionByName(
        spark.createDataFrame([(900, [0.0] * 20), (901, None)], "id long, v array<double>")
    )
    got = neighbours.nearest(df, "id", "v", 5, "cosine", tile_rows=30)
    assert {(r["id"], r["neighbour"], r["place"]) for r in got.collect()} == brute(ids, points, 5, "cosine")


def test_plane_search_prunes(spark):
    rng = np.random.default_rng(9)
    points = rng.uniform(size=(4000, 2))
    df = frame(spark, np.arange(4000), points)
    got = neighbours.nearest(df, "id", "v", 5, tile_rows=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan
    assert got.count() == 20_000


def test_purity(spark):
    near = spark.createDataFrame([(1, 2), (1, 3), (2, 1), (3, 9)], "id long, neighbour long")
    labels = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (9, None)], "id long, label string")
    assert neighbours.label_purity(near, labels, "id", "label").first()[0] == pytest.approx(3 / 4)


@pytest.fixture(scope="module")
def concept(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 600)
    x = rng.normal(size=(600, 16)) @ rng.normal(size=(16, 16)) + np.outer(y, rng.normal(size=16))
    known = rng.uniform(size=600) < 0.9
    pdf = pd.DataFrame({"id": np.arange(600), "v": list(x), "y": [bool(b) if k else None for b, k in zip(y, known)]})
    df = spark.createDataFrame(
        [(int(i), [float(t) for t in v], b) for i, v, b in pdf.itertuples(index=False)],
        "id long, v array<double>, y boolean",
    )
    return x, y, known, df


def matrix_of(df):
    return np.stack([np.asarray(r["v"]) for r in df.orderBy("id").collect()])


def test_centroid_erasure(concept):
    x, y, known, df = concept
    fitted = erasure.fit_centroid(df, "v", "y")
    gap = x[known & (y == 1)].mean(0) - x[known & (y == 0)].mean(0)
    d = gap / np.linalg.norm(gap)
    erased = erasure.erase(df, "v", fitted, as_float=False)
    got = matrix_of(erased)
    np.testing.assert_allclose(got, x - np.outer(x @ d, d), atol=1e-10)
    again = matrix_of(erasure.erase(erased, "v", fitted, as_float=False))
    np.testing.assert_allclose(again, got, atol=1e-12)


def test_leace_matches_the_whitened_projection(concept):
    x, y, known, df = concept
    fitted = erasure.fit_leace(df, "v", "y")
    got = matrix_of(erasure.erase(df, "v", fitted, as_float=False))
    # the general closed form
    a, z = x[known], y[known].astype(float)
    mean = a.mean(0)
    values, axes = np.linalg.eigh(np.cov(a.T, bias=True))
    whiten, colour = axes @ np.diag(values**-0.5) @ axes.T, axes @ np.diag(values**0.5) @ axes.T
    direction = whiten @ ((a - mean).T @ (z - z.mean()) / len(z))
    projector = np.outer(direction, direction) / (direction @ direction)
    expected = x - (x - mean) @ (colour @ projector @ whiten).T
    np.testing.assert_allclose(got, expected, atol=1e-8)
    gap = got[known & (y == 1)].mean(0) - got[known & (y == 0)].mean(0)
    assert np.abs(gap).max() < 1e-12
    np.testing.assert_allclose(matrix_of(erasure.erase(erasure.erase(df, "v", fitted, False), "v", fitted, False)), got, atol=1e-10)


def test_leace_with_fewer_rows_than_dimensions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=30).tolist(), i % 2 == 0) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y boolean")
    got = matrix_of(erasure.erase(df, "v", erasure.fit_leace(df, "v", "y"), False))
    gap = got[::2].mean(0) - got[1::2].mean(0)
    assert np.abs(gap).max() < 1e-8


def test_erase_keeps_types_and_nulls(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, None, "b")], "id long, v array<float>, t string")
    fitted = erasure.Erasure(np.array([1.0, 0.0]), np.array([1.0, 0.0]), 0.0)
    out = erasure.erase(df, "v", fitted)
    assert out.dtypes == df.dtypes
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, [0.0, 2.0], "a"), (2, None, "b")]


def test_split_is_exact_per_class(concept):
    *_, df = concept
    split = probe.stratified_split(df.select("id", "y"), "id", "y").groupBy("y").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("t")
    ).collect()
    assert len(split) == 2
    for r in split:
        assert r["t"] == int(r["n"] * 0.2 + 0.5)


def auc(score, hit):
    wins = (score[hit][:, None] > score[~hit][None, :]) + 0.5 * (score[hit][:, None] == score[~hit][None, :])
    return wins.mean()


def test_auc_with_ties(spark):
    rng = np.random.default_rng(4)
    score, hit = rng.integers(0, 9, 500) / 8, rng.uniform(size=500) < 0.3
    df = spark.createDataFrame(pd.DataFrame({"s": score, "h": hit}))
    assert probe.roc_auc(df, "s", "h").first()[0] == pytest.approx(auc(score, hit))
    assert probe.roc_auc(df.where("h"), "s", "h").first()[0] is None


def test_probe_sees_the_concept_only_before_erasure(concept):
    *_, df = concept
    areas = {m: probe.probe_auc(df, "id", "v", "y", m).first()["auc"] for m in ("raw", "centroid", "leace")}
    assert areas["raw"] > 0.75
    assert 0.25 < areas["leace"] < 0.75


def test_layout_is_the_main_plane_with_fixed_signs(concept):
    x, *_, df = concept
    got = layout.layout(df, "id", "v").orderBy("id").toPandas()
    values, axes = np.linalg.eigh(np.cov(x.T))
    for column, axis in zip("xy", axes[:, ::-1].T[:2]):
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        np.testing.assert_allclose(got[column], x @ axis, rtol=1e-4, atol=1e-4)


def test_encoders(spark):
    df = spark.createDataFrame([(i, "word " * (i + 1)) for i in range(250)], "id long, text string")

    def encoder(texts):
        assert len(texts) <= 96
        return np.array([[len(t), 1.0] for t in texts])

    got = layout.encode_with(df, "id", "text", encoder).toPandas().sort_values("id")
    assert [v[0] for v in got["embedding"]] == [5.0 * (i + 1) for i in range(250)]
    docs = spark.createDataFrame([(1, "Red apple"), (2, "red  APPLE!"), (3, "blue sky")], "id long, text string")
    vectors = {r["id"]: np.array(r["embedding"]) for r in layout.encode_hashed(docs, "id", "text", 64).collect()}
    np.testing.assert_allclose(vectors[1], vectors[2])
    assert np.linalg.norm(vectors[3]) == pytest.approx(1.0, abs=1e-6)


def test_regions(spark):
    rng = np.random.default_rng(6)
    corners = np.array([[0, 0], [0, 9], [9, 0], [9, 9]])
    which = rng.integers(0, 4, 300)
    places = corners[which] + rng.normal(size=(300, 2)) * 0.3
    words = ["alpha", "beta", "gamma", "delta"]
    coords = spark.createDataFrame(pd.DataFrame({"id": range(300), "x": places[:, 0], "y": places[:, 1]}))
    docs = spark.createDataFrame([(i, f"common {words[w]}") for i, w in enumerate(which)], "id long, text string")
    clusters = regions.cluster_layers(coords, "id", [4, 8])
    labels = regions.label_regions(clusters, docs, "id", "text")
    coarse = labels.where("layer = 0").toPandas().set_index("id")["label"]
    named = coarse[coarse != "Unlabelled"]
    assert 0.85 <= len(named) / 300 <= 0.95
    assert all(label.split(" / ")[0] == words[which[i]] for i, label in named.items())
    wide = regions.layer_table(labels, "id", 2)
    assert wide.columns == ["id", "label_layer_0", "label_layer_1"] and wide.count() == 300
    summary = {r["layer"]: r for r in regions.layer_summary(labels).collect()}
    assert summary[0]["names"] == 5
    best = regions.exemplars(clusters.where("layer = 0"), "cluster", "id", 2)
    assert best.count() == 8
    with pytest.raises(ValueError):
        regions.cluster_layers(coords, "id", [3])


def test_equal_class_means_erase_nothing(spark):
    df = spark.createDataFrame([([1.0, 2.0], c) for c in (True, False, True, False)], "v array<double>, c boolean")
    erased = erasure.erase(df, "v", erasure.fit_centroid(df, "v", "c"), as_float=False)
    assert {tuple(r["v"]) for r in erased.collect()} == {(1.0, 2.0)}


def test_region_edge_is_the_exact_quantile(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"id": range(500), "layer": 0, "cluster": rng.integers(0, 3, 500), "distance": np.round(rng.exponential(size=500), 2)})
    got = {r["id"]: r["cluster"] for r in regions.within_edge(spark.createDataFrame(frame), "id").collect()}
    edge = frame.groupby("cluster")["distance"].transform(lambda d: np.quantile(d, 0.9))
    assert {i for i, c in got.items() if c is None} == set(frame["id"][frame["distance"] > edge + 1e-12])


def test_moments_merge_to_those_of_all_rows():
    rng = np.random.default_rng(4)
    matrix, labels = rng.normal(1000, 1, (60, 3)), np.array(list("aab" * 20), object)
    whole = erasure.Moments.of(labels, matrix)
    parts = [erasure.Moments.of(labels[k : k + 7], matrix[k : k + 7]) for k in range(0, 60, 7)]
    total = parts[0]
    for part in parts[1:]:
        total = total.merge(erasure.Moments.from_row(part.to_row().to_pylist()[0]))
    assert total.n == whole.n and np.allclose(total.mean, whole.mean) and np.allclose(total.square, whole.square)
    assert all(np.allclose(total.classes[c][1], whole.classes[c][1]) and total.classes[c][0] == whole.classes[c][0] for c in "ab")


def test_erasure_of_many_classes_equalises_their_means(spark):
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 4, 300)
    matrix = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + np.eye(6)[labels] * 3
    matrix[:, 5] = 2.0  # a constant column
    rows = [(int(i), matrix[i].tolist(), None if i % 50 == 0 else f"c{labels[i]}") for i in range(300)]
    df = spark.createDataFrame([*rows, (300, None, "c1")], "id long, v array<double>, c string")
    fitted = erasure.fit_leace_classes(df, "v", "c")
    assert np.shape(fitted.out) == (3, 6)
    cleaned = np.array([r["v"] for r in erasure.erase(df.where("c is not null and v is not null"), "v", fitted, as_float=False).orderBy("id").collect()])
    kept = [i for i in range(300) if i % 50]
    means = np.stack([cleaned[labels[kept] == c].mean(0) for c in range(4)])
    assert np.allclose(means, means[0]) and not np.allclose(cleaned.std(0)[:5], 0)
    two = df.withColumn("b", F.col("c") == "c0")
    one, many = erasure.fit_leace(two, "v", "b"), erasure.fit_leace_classes(two, "v", "b")
    assert np.allclose(one.apply_to(matrix), many.apply_to(matrix))
    alone = erasure.fit_leace_classes(df.where("c = 'c2'"), "v", "c")
    assert np.allclose(alone.apply_to(matrix), matrix)


def test_moments_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(50).selectExpr("array(cast(id as double), cast(id * id as double)) as v", "id % 3 as c").write.parquet(path)
    plan = erasure.moment_rows(spark.read.parquet(path), "v", "c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert erasure.moments(spark.read.parquet(path), "v", "c").n == 50


def test_certificate_is_zero_only_at_the_optimum(spark):
    rng = np.random.default_rng(6)
    rows = [(rng.normal(size=3).tolist(), bool(rng.random() < 0.5)) for _ in range(80)]
    df = spark.createDataFrame(rows, "v array<double>, y boolean")
    weights, intercept, penalty = probe.fit_probe(df, "v", "y", tolerance=1e-12)
    best = [abs(r["gradient"]) for r in probe.certificate(df, "v", "y", weights, intercept, penalty).collect()]
    off = [abs(r["gradient"]) for r in probe.certificate(df, "v", "y", [w + 0.1 for w in weights], intercept, penalty).collect()]
    assert len(best) == 4 and max(best) < 1e-5 < max(off)
