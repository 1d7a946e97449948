"""Registered queries on vectors, regions and ingestion."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.operators import density, erasure, graph, layout, neighbours, probe, regions
from renown.plans import erasure_report, region_map
from renown.session import stage
from workload import roles
from workload.roles import with_

K = 15


def concept_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with a planted two-class concept; label 0 stands for rows without a class."""
    return roles.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("label") != 0, F.col("embedding")[0] > 0).alias("concept")
    )


def _cells(df: DataFrame) -> DataFrame:
    return df.select("vec_id", F.posexplode("embedding").alias("pos", "value")).select(
        "vec_id", "pos", F.round(F.col("value").cast("double"), 6).alias("value")
    )


def centroid_erase(spark: SparkSession, sf: str) -> DataFrame:
    df = concept_vectors(spark, sf)
    fitted = erasure.fit_centroid(df, "embedding", "concept")
    return _cells(erasure.erase(df, "embedding", fitted, as_float=False))


def leace_erase(spark: SparkSession, sf: str) -> DataFrame:
    df = concept_vectors(spark, sf)
    fitted = erasure.fit_leace(df, "embedding", "concept")
    return _cells(erasure.erase(df, "embedding", fitted, as_float=False))


def leace_class_gap(spark: SparkSession, sf: str) -> DataFrame:
    """Difference of the class means per dimension after the erasure: zero."""
    df = concept_vectors(spark, sf)
    fitted = erasure.fit_leace(df, "embedding", "concept")
    cells = erasure.erase(df, "embedding", fitted, as_float=False).select(
        "concept", F.posexplode("embedding").alias("pos", "value")
    )
    gap = F.avg(F.when(F.col("concept"), F.col("value"))) - F.avg(F.when(~F.col("concept"), F.col("value")))
    return cells.groupBy("pos").agg((F.round(F.abs(gap), 9) + 0.0).alias("gap"))


def leace_plane(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in the plane of balance and nation, without what tells one market segment from the rest."""
    df = roles.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.array(F.col("c_acctbal").cast("double"), F.col("c_nationkey").cast("double")).alias("xy"),
        (F.col("c_mktsegment") == "BUILDING").alias("concept"),
    )
    erased = erasure.erase(df, "xy", erasure.fit_leace(df, "xy", "concept"), as_float=False)
    return erased.select("id", F.round(F.col("xy")[0], 4).alias("x"), F.round(F.col("xy")[1], 4).alias("y"))


def leace_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in three dimensions without what tells three groups of market segments apart."""
    df = roles.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.array(F.col("c_acctbal").cast("double"), F.col("c_nationkey").cast("double"), (F.col("c_custkey") * 7919 % 1000).cast("double")).alias("xyz"),
        F.when(F.col("c_mktsegment") == "BUILDING", "a").when(F.col("c_mktsegment") == "MACHINERY", "b").otherwise("c").alias("concept"),
    )
    erased = erasure.erase(df, "xyz", erasure.fit_leace_classes(df, "xyz", "concept"), as_float=False)
    return erased.select("id", *[F.round(F.col("xyz")[k], 3).alias(n) for k, n in enumerate("xyz")])


def probe_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """Gradient of the penalised loss at the fitted probe, per dimension: zero."""
    df = concept_vectors(spark, sf).where("concept is not null")
    weights, intercept, penalty = probe.fit_probe(df, "embedding", "concept", tolerance=1e-12)
    found = probe.certificate(df, "embedding", "concept", weights, intercept, penalty)
    return found.select("pos", (F.round(F.abs("gradient"), 4) + 0.0).alias("gradient"))


def knn_cosine(spark: SparkSession, sf: str) -> DataFrame:
    near = neighbours.nearest(concept_vectors(spark, sf), "vec_id", "embedding", K, "cosine")
    return near.select("vec_id", "neighbour", "place", F.round("score", 6).alias("score"))


def plane(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in the plane of rounded balance and nation; many share a point."""
    return roles.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.array(F.floor(F.col("c_acctbal") / 100).cast("double"), F.col("c_nationkey").cast("double")).alias("xy"),
        "c_mktsegment",
    )


def knn_plane(spark: SparkSession, sf: str) -> DataFrame:
    near = neighbours.nearest(plane(spark, sf), "id", "xy", K, tile_rows=512)
    return near.select("id", "neighbour", "place", F.round("score", 6).alias("score"))


def knn_purity(spark: SparkSession, sf: str) -> DataFrame:
    df = concept_vectors(spark, sf)
    labelled = df.where(F.col("concept").isNotNull())
    near = neighbours.nearest(labelled, "vec_id", "embedding", K)
    return neighbours.label_purity(near, labelled, "vec_id", "concept").select(F.round("purity", 6).alias("purity"))


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    df = concept_vectors(spark, sf).select("vec_id", "concept")
    return probe.stratified_split(df, "vec_id", "concept")


def auc_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Area of the quantity as a score of returned lines, with many equal scores."""
    lines = roles.table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("score"), (F.col("l_returnflag") == "R").alias("hit")
    )
    return probe.roc_auc(lines, "score", "hit").select(F.round("auc", 9).alias("auc"))


def erasure_summary(spark: SparkSession, sf: str) -> DataFrame:
    return erasure_report.report(concept_vectors(spark, sf), "vec_id", "embedding", "concept", K)


def pca_layout(spark: SparkSession, sf: str) -> DataFrame:
    return layout.layout(concept_vectors(spark, sf), "vec_id", "embedding")


def text_vectors(spark: SparkSession, sf: str) -> DataFrame:
    docs = roles.table(spark, sf, "documents").select(F.col("doc_id").alias("pageid"), "text")
    return layout.encode_hashed(docs, "pageid", "text")


def region_terms(spark: SparkSession, sf: str) -> DataFrame:
    terms = regions.region_terms(roles.table(spark, sf, "documents"), "source", "text")
    return terms.select("region", "place", "term", F.round("weight", 9).alias("weight"))


def region_names(spark: SparkSession, sf: str) -> DataFrame:
    docs = roles.table(spark, sf, "documents")
    return regions.region_names(regions.region_terms(docs, "source", "text"))


def region_exemplars(spark: SparkSession, sf: str) -> DataFrame:
    """Customers nearest to the mean balance of their nation."""
    customer = roles.table(spark, sf, "customer")
    mean = customer.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("mean"))
    placed = customer.join(mean, "c_nationkey").withColumn(
        "distance", F.round(F.abs(F.col("c_acctbal") - F.col("mean")), 6)
    )
    return regions.exemplars(placed, "c_nationkey", "c_custkey")


def region_edge(spark: SparkSession, sf: str) -> DataFrame:
    """Customers beyond nine tenths of their nation's distances from its mean balance lose their nation."""
    customer = roles.table(spark, sf, "customer")
    mean = customer.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("mean"))
    placed = customer.join(mean, "c_nationkey").select(
        "c_custkey", F.lit(0).alias("layer"), F.col("c_nationkey").alias("cluster"),
        F.round(F.abs(F.col("c_acctbal") - F.col("mean")), 6).alias("distance"),
    )
    return regions.within_edge(placed, "c_custkey").select("c_custkey", "cluster", "distance")


def region_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to vectors, layout, clusters, names and one label column per layer."""
    docs = roles.table(spark, sf, "documents").select(F.col("doc_id").alias("pageid"), "text")
    return regions.layer_table(region_map.label_layers(docs, "pageid", "text", 256), "pageid")


def text_vector_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The hashed vectors place by place, without their zeros."""
    cells = text_vectors(spark, sf).select("pageid", F.posexplode("embedding").alias("pos", "value"))
    return cells.where("value <> 0").select("pageid", "pos", F.round(F.col("value").cast("double"), 5).alias("value"))


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_counts(texts: list[str]) -> np.ndarray:
    """A small encoder: uses of each letter."""
    return np.array([[t.count(c) for c in LETTERS] for t in texts], dtype=np.float32).reshape(len(texts), len(LETTERS))


def encoded_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents through an encoder of matrices, place by place."""
    docs = roles.table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cells = layout.encode_with(docs, "doc_id", "text", letter_counts).select("doc_id", F.posexplode("embedding").alias("pos", "value"))
    return cells.select("doc_id", "pos", F.col("value").cast("bigint").alias("value"))


def knn_graph(spark: SparkSession, sf: str) -> DataFrame:
    near = graph.knn_graph(concept_vectors(spark, sf), "vec_id", "embedding", K, "cosine")
    return near.select("vec_id", "neighbour", "place", F.round("score", 6).alias("score"))


def trade_links(spark: SparkSession, sf: str) -> DataFrame:
    """Nations linked by the lines that customers of one order from suppliers of the other."""
    customer = roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    supplier = roles.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("neighbour"))
    orders = roles.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = roles.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").join(orders, "l_orderkey")
    traded = lines.join(supplier, "l_suppkey").join(customer, "o_custkey").groupBy("nation", "neighbour").agg(F.count("*").alias("n"))
    return graph.undirected(traded, "nation", weight=F.col("n"))


def graph_axes(spark: SparkSession, sf: str) -> DataFrame:
    """What a step of the walk over trade changes on the axes beside their eigenvalues: nothing."""
    links = stage(trade_links(spark, sf), "trade")
    placed, values = graph.graph_axes(links)
    placed = stage(placed, "trade-axes")
    ends = placed.select(F.col("id").alias("other"), F.col("axis").alias("_to"))
    flow = [F.sum(F.col("weight") * F.col("_to")[j]) / F.sum("weight") for j in range(2)]
    walked = placed.join(links.join(ends, "other").groupBy("id").agg(F.array(*flow).alias("_flow")), "id")
    gaps = [(F.round(F.abs((F.col("axis")[j] + F.col("_flow")[j]) / 2 - F.col("axis")[j] * values[j]), 5) + 0.0).alias(f"gap_{j}") for j in range(2)]
    return walked.select("id", *gaps)


# the plane of balance and nation in 25 x 25 cells
_BOX, _BINS, _SHARES = (-1000.0, 0.0, 10000.0, 25.0), 25, [0.9, 0.5, 0.2]


def _places(spark: SparkSession, sf: str) -> DataFrame:
    return roles.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("double").alias("x"), F.col("c_nationkey").cast("double").alias("y")
    )


def density_layers(spark: SparkSession, sf: str) -> DataFrame:
    return density.density_layers(_places(spark, sf), "id", bins=_BINS, shares=_SHARES, box=_BOX)


def density_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Regions with the region of the layer before that holds them."""
    placed = density.grid(_places(spark, sf), bins=_BINS, box=_BOX).where("_cell is not null")
    cells = placed.groupBy("_cell").agg(F.count("*").alias("n"))
    return density.region_tree(density.cell_regions(cells, _SHARES))


def nested_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to vectors, layout, nested regions, names and one label column per layer."""
    docs = roles.table(spark, sf, "documents").select(F.col("doc_id").alias("pageid"), "text")
    return regions.layer_table(region_map.label_nested(docs, "pageid", "text", 256, bins=32), "pageid")


QUERIES = {
    "text_vector_cells": text_vector_cells,
    "encoded_texts": encoded_texts,
    "knn_graph": knn_graph,
    "graph_axes": graph_axes,
    "density_layers": density_layers,
    "density_tree": density_tree,
    "nested_layers": nested_layers,
    "centroid_erase": centroid_erase,
    "leace_erase": leace_erase,
    "leace_class_gap": leace_class_gap,
    "leace_plane": leace_plane,
    "leace_classes": leace_classes,
    "probe_gradient": probe_gradient,
    "knn_cosine": knn_cosine,
    "knn_plane": knn_plane,
    "knn_purity": knn_purity,
    "stratified_split": stratified_split,
    "auc_exact": auc_exact,
    "erasure_summary": erasure_summary,
    "pca_layout": pca_layout,
    "text_vectors": text_vectors,
    "region_terms": region_terms,
    "region_names": region_names,
    "region_exemplars": region_exemplars,
    "region_layers": region_layers,
    "region_edge": region_edge,
}

VECTORS = """vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, CASE WHEN label <> 0 THEN embedding[1] > 0 END AS concept FROM embeddings)"""
_TERMS = r"""tokens AS (
  SELECT source AS region, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS term
  FROM documents WHERE source IS NOT NULL),
uses AS (SELECT region, term, count(*) AS uses FROM tokens GROUP BY 1, 2),
per_region AS (SELECT region, sum(uses) AS words FROM uses GROUP BY 1),
overall AS (SELECT term, sum(uses) AS all_uses FROM uses GROUP BY 1),
weighted AS (
  SELECT region, term, round(uses / words * ln(1 + (SELECT avg(words) FROM per_region) / all_uses), 12) AS weight
  FROM uses JOIN per_region USING (region) JOIN overall USING (term)),
terms AS (
  SELECT region, row_number() OVER (PARTITION BY region ORDER BY weight DESC, term)::INT AS place, term, weight
  FROM weighted QUALIFY place <= 3)"""

_DENSITY = """places AS (
  SELECT c_custkey AS id, least(24, greatest(0, floor((c_acctbal::DOUBLE + 1000.0::DOUBLE) / 11000.0::DOUBLE * 25)))::BIGINT AS cx,
         least(24, greatest(0, floor(c_nationkey::DOUBLE / 25.0::DOUBLE * 25)))::BIGINT AS cy FROM customer),
cells AS (SELECT cx, cy, cx * 4294967296 + cy AS cell, count(*) AS n FROM places WHERE cx IS NOT NULL AND cy IS NOT NULL GROUP BY 1, 2),
mass AS (SELECT n, sum(sum(n)) OVER (ORDER BY n DESC) AS mass FROM cells GROUP BY n),
least_ AS (SELECT layer, max(n) AS least FROM mass, (VALUES (0, 0.9), (1, 0.5), (2, 0.2)) s(layer, share)
  WHERE mass >= share::DOUBLE * (SELECT sum(n) FROM cells) GROUP BY layer),
nodes AS (SELECT layer, cx, cy, cell, n FROM cells JOIN least_ ON n >= least),
links AS (SELECT a.layer, a.cell AS a, b.cell AS b FROM nodes a JOIN nodes b
  ON a.layer = b.layer AND abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1),
reach AS (SELECT layer, cell, cell AS seen FROM nodes
  UNION SELECT r.layer, l.b, r.seen FROM reach r JOIN links l ON l.layer = r.layer AND l.a = r.cell),
regions AS (SELECT layer, cell, min(seen) AS region FROM reach GROUP BY 1, 2)"""

ORACLES = {
    "text_vector_cells": r"""WITH tokens AS (
          SELECT doc_id AS pageid, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS w FROM documents),
        tf AS (SELECT pageid, (('0x' || substr(md5(w), 1, 15))::BIGINT % 1024)::INT AS pos, count(*) AS n FROM tokens GROUP BY 1, 2),
        df AS (SELECT pos, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY 1),
        weighted AS (SELECT pageid, pos, n * idf AS w FROM tf JOIN df USING (pos))
        SELECT pageid, pos, round((w / sqrt(sum(w * w) OVER (PARTITION BY pageid)))::FLOAT::DOUBLE, 5) AS value FROM weighted WHERE w <> 0""",
    "encoded_texts": f"""SELECT doc_id, pos::INT AS pos, length(t) - length(replace(t, substr('{LETTERS}', pos + 1, 1), '')) AS value
        FROM (SELECT doc_id, coalesce(text, '') AS t, unnest(range({len(LETTERS)})) AS pos FROM documents)""",
    "graph_axes": "SELECT n_nationkey AS id, 0.0::DOUBLE AS gap_0, 0.0::DOUBLE AS gap_1 FROM nation",
    "density_layers": f"""WITH RECURSIVE {_DENSITY}
        SELECT id, layer, region AS cluster FROM (SELECT *, unnest([0, 1, 2]) AS layer, cx * 4294967296 + cy AS cell FROM places)
        LEFT JOIN regions USING (layer, cell)""",
    "density_tree": f"""WITH RECURSIVE {_DENSITY}
        SELECT r.layer, r.region, min(p.region) AS parent, count(*) AS cells, sum(n.n)::BIGINT AS points
        FROM regions r JOIN nodes n USING (layer, cell) LEFT JOIN regions p ON p.layer = r.layer - 1 AND p.cell = r.cell GROUP BY 1, 2""",
    "centroid_erase": with_(VECTORS, """cells AS (
      SELECT vec_id, concept, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vectors),
    gap AS (SELECT pos, avg(x) FILTER (concept) - avg(x) FILTER (NOT concept) AS g FROM cells GROUP BY pos),
    unit AS (SELECT pos, g / sqrt((SELECT sum(g * g) FROM gap)) AS d FROM gap),
    along AS (SELECT vec_id, sum(x * d) AS p FROM cells JOIN unit USING (pos) GROUP BY vec_id)""",
        select="""SELECT vec_id, (pos - 1)::INT AS pos, round(x - p * d, 6) AS value
        FROM cells JOIN unit USING (pos) JOIN along USING (vec_id)"""),
    "leace_class_gap": """SELECT (pos - 1)::INT AS pos, 0.0::DOUBLE AS gap
        FROM (SELECT DISTINCT generate_subscripts(embedding, 1) AS pos FROM embeddings)""",
    "leace_plane": """WITH p AS (
          SELECT c_custkey AS id, c_acctbal::DOUBLE AS x, c_nationkey::DOUBLE AS y, c_mktsegment = 'BUILDING' AS t FROM customer),
        m AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS xx, var_samp(y) AS yy, covar_samp(x, y) AS xy,
                     avg(x) FILTER (t) - avg(x) FILTER (NOT t) AS cx, avg(y) FILTER (t) - avg(y) FILTER (NOT t) AS cy FROM p),
        w AS (SELECT *, yy * cx - xy * cy AS wx, xx * cy - xy * cx AS wy FROM m),
        f AS (SELECT id, x, y, cx, cy, (wx * (x - mx) + wy * (y - my)) / (wx * cx + wy * cy) AS s FROM p, w)
        SELECT id, round(x - s * cx, 4) AS x, round(y - s * cy, 4) AS y FROM f""",
    # two gaps of the class means span what goes; w is at right angles to both, and S w is the direction that stays
    "leace_classes": """WITH p AS (
          SELECT c_custkey AS id, c_acctbal::DOUBLE AS x, c_nationkey::DOUBLE AS y, (c_custkey * 7919 % 1000)::DOUBLE AS z,
            CASE c_mktsegment WHEN 'BUILDING' THEN 'a' WHEN 'MACHINERY' THEN 'b' ELSE 'c' END AS t FROM customer),
        m AS (SELECT avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_pop(x) AS xx, var_pop(y) AS yy, var_pop(z) AS zz,
            covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz,
            avg(x) FILTER (t = 'a') - avg(x) FILTER (t = 'c') AS gx, avg(y) FILTER (t = 'a') - avg(y) FILTER (t = 'c') AS gy, avg(z) FILTER (t = 'a') - avg(z) FILTER (t = 'c') AS gz,
            avg(x) FILTER (t = 'b') - avg(x) FILTER (t = 'c') AS hx, avg(y) FILTER (t = 'b') - avg(y) FILTER (t = 'c') AS hy, avg(z) FILTER (t = 'b') - avg(z) FILTER (t = 'c') AS hz FROM p),
        w AS (SELECT *, gy * hz - gz * hy AS wx, gz * hx - gx * hz AS wy, gx * hy - gy * hx AS wz FROM m),
        v AS (SELECT *, xx * wx + xy * wy + xz * wz AS vx, xy * wx + yy * wy + yz * wz AS vy, xz * wx + yz * wy + zz * wz AS vz FROM w),
        s AS (SELECT id, mx, my, mz, vx, vy, vz, (wx * (x - mx) + wy * (y - my) + wz * (z - mz)) / (wx * vx + wy * vy + wz * vz) AS along FROM p, v)
        SELECT id, round(mx + along * vx, 3) AS x, round(my + along * vy, 3) AS y, round(mz + along * vz, 3) AS z FROM s""",
    "probe_gradient": """SELECT (unnest(range(0, 1 + max(len(embedding)))) - 1)::INT AS pos, 0.0::DOUBLE AS gradient FROM embeddings""",
    "region_edge": """WITH d AS (
          SELECT c_custkey, c_nationkey, round(abs(c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_nationkey)), 6) AS distance FROM customer),
        l AS (SELECT c_nationkey, quantile_cont(distance, 0.9) AS edge FROM d GROUP BY 1)
        SELECT c_custkey, CASE WHEN distance <= edge THEN c_nationkey END AS cluster, distance FROM d JOIN l USING (c_nationkey)""",
    "knn_cosine": with_(VECTORS, select=f"""SELECT a.vec_id, b.vec_id AS neighbour,
        row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.vec_id)::INT AS place,
        round(list_cosine_similarity(a.v, b.v), 6) AS score
        FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id QUALIFY place <= {K}"""),
    "knn_plane": f"""WITH p AS (SELECT c_custkey AS id, floor(c_acctbal / 100) AS x, c_nationkey::DOUBLE AS y FROM customer)
        SELECT a.id, b.id AS neighbour,
        row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.id)::INT AS place,
        round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS score
        FROM p a JOIN p b ON a.id <> b.id QUALIFY place <= {K}""",
    "knn_purity": with_(VECTORS, select=f"""SELECT round(avg(same::INT), 6) AS purity FROM (
        SELECT a.concept = b.concept AS same,
          row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS place
        FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
        WHERE a.concept IS NOT NULL AND b.concept IS NOT NULL QUALIFY place <= {K})"""),
    "stratified_split": with_(VECTORS, select="""SELECT vec_id, concept,
        row_number() OVER (PARTITION BY concept ORDER BY md5('42:' || vec_id), vec_id)
          <= round(count(*) OVER (PARTITION BY concept) * 0.2) AS is_test
        FROM vectors WHERE concept IS NOT NULL"""),
    "auc_exact": """WITH s AS (SELECT l_quantity AS score, count(*) FILTER (l_returnflag = 'R') AS pos,
          count(*) FILTER (l_returnflag <> 'R') AS neg FROM lineitem GROUP BY 1),
        r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM s)
        SELECT round(sum(pos * (below + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)), 9) AS auc FROM r""",
    "region_terms": with_(_TERMS, select="SELECT region, place, term, round(weight, 9) AS weight FROM terms"),
    "region_names": with_(_TERMS, select="SELECT region, string_agg(term, ' / ' ORDER BY place) AS label FROM terms GROUP BY 1"),
    "region_exemplars": """SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY distance, c_custkey)::INT AS place,
        c_custkey, distance
        FROM (SELECT c_nationkey, c_custkey, round(abs(c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_nationkey)), 6) AS distance
              FROM customer) QUALIFY place <= 5""",
}
