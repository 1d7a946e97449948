"""Uniform shards by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters records over buckets of a memory-sized volume by a seeded hash.
Pass two shuffles each bucket with Fisher-Yates (``functions.shuffle``) and lays the
buckets end to end, which makes one random order of all records. Shards are equal
runs of that order, so a bucket feeds one or two shards and is written where it was
shuffled: the texts cross the network once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown.session import scratch_path

_GROUP = 1024


def _offsets(counts: DataFrame) -> DataFrame:
    """Records ahead of each bucket; groups of buckets first, so no window sees all buckets."""
    grouped = counts.withColumn("_group", F.expr(f"_bucket div {_GROUP}"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = grouped.groupBy("_group").agg(F.sum("_n").alias("_sum"))
    starts = starts.select("_group", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        grouped.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(starts, "_group")
        .select("_bucket", (F.col("_base") + F.col("_inside")).alias("_before"))
    )


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus one; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def shard(
    docs: DataFrame,
    n_shards: int,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    bucket_bytes: int = 8 << 20,
    path: str | None = None,
) -> DataFrame:
    """Write ``docs`` in random order into ``n_shards`` folders ``shard=K`` and read them back.

    Columns: ``record`` (the whole input row as a struct, so no input name can clash),
    ``slot`` (gapless from 0 inside the shard) and ``shard``. Shard sizes in rows differ
    by one at most. ``path`` is the target (default: a new scratch folder).

    Null keys and null or empty texts are records like others; a bucket is chosen by key
    and text together, so a frequent key, null or text spreads as long as the other differs.
    Rows that repeat key and text share a bucket. A record larger than a bucket makes a
    bucket of its size. An empty table gives no rows.
    """
    spark = docs.sparkSession
    size = record_size(F.col(text))
    n, total = docs.agg(F.count(F.lit(1)), F.sum(size)).first()
    buckets = max(1, math.ceil((total or 0) / bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text)), F.lit(buckets))
    rows = docs.select(
        bucket.alias("_bucket"), F.xxhash64(F.lit(seed + 1), F.col(key), F.col(text)).alias("_tie"), F.struct("*").alias("record")
    )
    # the sort makes the shuffle start from the same array however the rows arrived
    shuffled = rows.groupBy("_bucket").agg(
        F.shuffle(F.sort_array(F.collect_list(F.struct("_tie", "record"))), seed).alias("_rows")
    )
    counts = docs.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    placed = (
        shuffled.join(_offsets(counts), "_bucket")
        .select("_before", F.posexplode("_rows").alias("_pos", "_row"))
        .select((F.col("_before") + F.col("_pos")).cast("bigint").alias("_at"), F.col("_row.record").alias("record"))
        .withColumn("shard", F.expr(f"cast((_at * {n_shards}) div {max(n, 1)} as int)"))
        .withColumn("slot", F.expr(f"_at - (shard * {n}L + {n_shards - 1}) div {n_shards}"))
        .select("record", "slot", "shard")
    )
    path = path or scratch_path(spark, "shards")
    placed.write.partitionBy("shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)
