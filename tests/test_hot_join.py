from statistics import median

import pytest
from pyspark.sql import functions as F

from renown.operators import facets, redirects
from renown.operators.hot_join import hot_keys, join_spread


@pytest.fixture
def plain(spark):
    """Shuffles as they are dealt: no broadcasts, no splitting or merging at run time."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def skewed(spark, n=40_000):
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 5003).cast("bigint")
    return spark.range(n).select(F.col("id").alias("row"), key.alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_key_with_half_the_rows_is_spread(plain, how):
    large, small = skewed(plain), plain.range(4000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    small = small.union(small.where("k in (7, 8)").withColumn("v", F.lit(-1)))  # repeated keys match twice
    joined = join_spread(large, small, ["k"], how)
    assert joined.columns == large.join(small, ["k"], how).columns
    assert joined.exceptAll(large.join(small, ["k"], how)).isEmpty() and large.join(small, ["k"], how).exceptAll(joined).isEmpty()
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * median(sizes)


def test_no_hot_key_empty_tables_and_other_joins(plain):
    even = plain.range(4000).select(F.col("id").alias("k"))
    assert hot_keys(even, "k").isEmpty() and hot_keys(even.limit(0), "k").isEmpty()
    assert join_spread(even, even, ["k"]).count() == 4000
    assert join_spread(skewed(plain), even.limit(0), ["k"], "left").count() == 40_000
    with pytest.raises(ValueError, match="once per salt"):
        join_spread(even, even, ["k"], "outer")


def test_labels_and_lookup_with_a_hot_key(plain):
    ids = lambda c: F.array(F.when(F.col("id") % 2 == 0, "Q5").otherwise(F.concat(F.lit("Q"), F.col("id"))), F.lit(c))
    records = plain.range(3000).select(F.col("id").cast("string").alias("qid"), *[ids(f).alias(f) for f in facets.ID_FIELDS])
    labels = plain.createDataFrame([("Q5", "five"), ("Q7", "seven")], "id string, label string")
    got = {r["qid"]: list(r[facets.ID_FIELDS[0]]) for r in facets.resolve_ids(records, labels, "qid").collect()}
    first = lambda i: "five" if i % 2 == 0 or i == 5 else "seven" if i == 7 else f"Q{i}"
    assert got == {str(i): [first(i), facets.ID_FIELDS[0]] for i in range(3000)}

    links = plain.range(50).select(F.lit("enwiki").alias("site"), F.concat(F.lit("T"), F.col("id")).alias("title"), F.col("id").alias("item"))
    target = F.when(F.col("id") % 2 == 0, "T3").otherwise(F.concat(F.lit("T"), F.col("id") % 60))
    hops = plain.range(2000).select(F.concat(F.lit("S"), F.col("id")).alias("source_title"), target.alias("target_title"))
    found = {r["title"]: r["item"] for r in redirects.site_lookup(links, hops).collect()}
    expected = {f"T{i}": i for i in range(50)} | {f"S{i}": 3 if i % 2 == 0 else i % 60 for i in range(2000) if i % 2 == 0 or i % 60 < 50}
    assert found == expected
