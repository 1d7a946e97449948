from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from renown.llm import dimension_scan, queries


def exact(ids, vectors, asked, k):
    norm = np.linalg.norm(vectors, axis=1)
    found = {}
    for q in asked:
        at = int(np.flatnonzero(ids == q)[0])
        score = np.round(vectors @ vectors[at] / (norm * norm[at]), 12)
        order = [j for j in np.lexsort((ids, -score)) if j != at][:k]
        found[int(q)] = [(int(ids[j]), float(score[j])) for j in order]
    return found


def result(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found.setdefault(r["query_id"], [])) + 1
        found[r["query_id"]].append((r["vec_id"], round(r["score"], 12)))
    return found


def table(spark, ids, vectors):
    return spark.createDataFrame(pd.DataFrame({"vec_id": ids, "embedding": list(vectors.tolist())}))


def test_recall_on_groups(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 32))
    vectors = centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 32))
    ids = rng.permutation(8000)[:4000]
    got = result(dimension_scan.search(table(spark, ids, vectors), F.col("vec_id") % 50 == 0))
    want = exact(ids, vectors, [i for i in ids if i % 50 == 0], 5)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_equal_vectors_are_one_entry(spark):
    vectors = np.concatenate([np.tile([1.0, 2.0, 3.0], (200, 1)), np.eye(3), [[2.0, 4.0, 6.0]]])
    ids = np.arange(len(vectors)) * 10
    got = result(dimension_scan.search(table(spark, ids, vectors), F.col("vec_id") % 50 == 0))
    want = exact(ids, vectors, [i for i in ids if i % 50 == 0], 5)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (None, [1.0, 0.0]), (8, [1.0, 2.0, 3.0]), (9, [1e-200, 1e-200]), (10, [1e200, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).withColumn("id", F.lit(1))
    got = result(dimension_scan.search(df, F.col("vec_id") >= 0))
    assert set(got) == {0, 1, 9, 10} and all(len(v) == 3 for v in got.values())
    assert dimension_scan.search(df.where("vec_id in (2, 4)"), F.col("vec_id") >= 0).count() == 0
    assert dimension_scan.search(df.limit(0), F.col("vec_id") >= 0).count() == 0


def test_scan_drops_only_far_candidates():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(2000, 64)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    kept = [dimension_scan.scan(q, vectors, 6, 2.1) for q in vectors[:50]]
    for q, at in zip(vectors[:50], kept):
        assert set(np.argsort(((vectors - q) ** 2).sum(1))[:6]) <= set(at.tolist())
    assert np.mean([len(at) for at in kept]) < 1000


def test_neighbour_query_recall(spark, tables):
    rows = spark.read.parquet(f"{tables}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    got = result(queries.op7_neighbours(spark, tables))
    want = exact(ids, vectors, [i for i in ids if i % 50 == 0], 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tables):
    docs, kept = spark.read.parquet(f"{tables}/documents.parquet"), {}
    kept["start"] = docs
    for name, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, tables), "test-stage")
        kept[name] = docs
    return {name: df.toPandas() for name, df in kept.items()}


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "sharding"]
    for name, frame in stages.items():
        assert list(frame.columns) == DOCUMENTS + (["shard", "slot"] if name == "sharding" else [])


def test_near_duplicate_stage_against_brute_force(stages):
    from test_llm_dedup import brute_components

    before = [(int(k), t) for k, t in zip(stages["toxicity"]["doc_id"], stages["toxicity"]["text"])]
    keep = {key for key, _, component in brute_components(before, 5, 80) if key == component}
    assert set(stages["near duplicates"]["doc_id"]) == keep


def test_decontamination_stage_against_brute_force(stages, spark, tables):
    def words(text):
        import re

        return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", text.translate({c: c + 32 for c in range(65, 91)}))

    items = [words(r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    seeds = {}
    for item in items:
        for at in range(len(item) - 11):
            for block in range(0, 12, 4):
                seeds.setdefault(tuple(item[at + block : at + block + 4]), []).append((block, item[at : at + 12]))
    clean = set()
    for key, text in zip(stages["near duplicates"]["doc_id"], stages["near duplicates"]["text"]):
        doc = words(text)
        bad = any(
            0 <= at - block and at - block + 12 <= len(doc) and sum(a == b for a, b in zip(doc[at - block : at - block + 12], window)) >= 10
            for at in range(len(doc) - 3) for block, window in seeds.get(tuple(doc[at : at + 4]), ())
        )
        if not bad:
            clean.add(key)
    assert set(stages["decontamination"]["doc_id"]) == clean


def test_mix_and_shards(stages):
    mixed, shards = stages["mixing"], stages["sharding"]
    assert set(mixed["doc_id"]) <= set(stages["decontamination"]["doc_id"])
    assert max(Counter(mixed["doc_id"]).values()) <= 2
    assert Counter(mixed["doc_id"]) == Counter(shards["doc_id"])
    sizes = shards.groupby("shard").size()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 1


def test_stages_take_odd_rows(spark, tables, odd_docs, no_docs):
    extra = odd_docs.select(*DOCUMENTS).withColumn("shard", F.lit("s")).withColumn("record", F.lit("r"))
    for name, function in corpus_pipeline.STAGES:
        rows = function(spark, extra, tables).collect()
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in odd_docs.collect()}
        if name == "near duplicates":
            # each repeated or copied text once; texts without words all stay
            assert Counter(r["doc_id"] for r in rows) == Counter([1, 4, 5, 6, 7, 9, 10, 12, None])
        if name == "toxicity":
            assert len(rows) == odd_docs.count()
        assert function(spark, no_docs, tables).count() == 0
