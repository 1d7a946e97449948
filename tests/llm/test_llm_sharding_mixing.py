import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from renown.llm import mixing, queries, sharding


def test_shards_hold_every_row_once(spark, odd_docs):
    clash = odd_docs.withColumn("shard", F.lit("x")).withColumn("slot", F.lit(1)).withColumn("record", F.lit(2))
    rows = sharding.shard(clash, 4, bucket_bytes=1000).collect()
    want = Counter((r["doc_id"], r["text"]) for r in odd_docs.collect())
    assert Counter((r["record"]["doc_id"], r["record"]["text"]) for r in rows) == want
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(4))
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    assert rows[0]["record"]["shard"] == "x"


def test_shards_of_nothing(no_docs):
    assert sharding.shard(no_docs, 3).count() == 0


def test_order_is_random_and_repeatable(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    first, again = ({r["record"]["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(docs, 8, bucket_bytes=4000).collect()} for _ in range(2))
    assert first == again
    mean = sum(k for k, (s, _) in first.items() if s == 0) / 500
    assert 1700 < mean < 2300  # about five standard errors around the middle
    rises = sum(first[k][1] < first[k + 1][1] for k in range(3999))
    assert 0.45 < rises / 3999 < 0.55


def test_sharding_query(spark, tables):
    rows = queries.op1_sharding(spark, tables).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_mix_meets_targets(odd_docs):
    rows = mixing.mix(odd_docs.withColumn("copies", F.lit("kept"))).collect()
    assert len(rows) == odd_docs.count()
    by_source = {}
    for r in rows:
        assert 0 <= r["copies"] <= 2 and r["taken"] == r["size"] * r["copies"] and r["record"]["copies"] == "kept"
        entry = by_source.setdefault(r["record"]["source"], [r["source_size"], r["target"], 0, 0])
        entry[2] += r["taken"]
        entry[3] = max(entry[3], r["size"])
    total = sum(size for size, *_ in by_source.values())
    assert sum(target for _, target, *_ in by_source.values()) == pytest.approx(1.5 * total)
    for size, target, taken, longest in by_source.values():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= longest
    assert set(by_source) == {"a", "b", "c", None}


def test_mix_spreads_over_many_documents(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (1 + F.col("id") % 50).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
    )
    rows = mixing.mix(docs).groupBy("record.source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 50 for r in rows)


def test_mix_without_tokens(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2
