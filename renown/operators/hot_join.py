"""Joins in which a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pieces a partition's share of rows is cut into, and bounds of the counters (fixed values).
PIECES, MAX_HOT, MAX_COUNTERS = 4, 4096, 1 << 20
_HASH, _SALT, _SALTS = "_key_hash", "_salt", "_salts"


def hot_keys(df: DataFrame, *keys: str, parts: int | None = None) -> DataFrame:
    """Hashes of the keys that hold more than a quarter of a partition's even share, and how many pieces each makes.

    A sketch of frequent items per task counts them and the sketches merge, so one pass and bounded
    memory suffice; at most 4,096 rows come out. An estimate that is off only moves the line between hot and other keys.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = min(PIECES * parts, MAX_HOT)
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(most), F.lit(min(16 * most, MAX_COUNTERS)))
    counted = df.agg(F.count(F.lit(1)).alias("rows"), top.alias("top")).first()
    pieces = [(t["item"], -(-t["count"] * PIECES * parts // counted["rows"])) for t in counted["top"]]
    return spark.createDataFrame([p for p in pieces if p[1] > 1], f"{_HASH} bigint, {_SALTS} bigint")


def join_spread(large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", parts: int | None = None) -> DataFrame:
    """``large.join(small, keys, how)`` with hot keys of ``large`` dealt over many tasks; ``how`` is inner or left.

    Rows of a hot key get one of its salts, and the rows of ``small`` with that key are repeated once per salt; all other
    keys join as ever, in the same shuffle. The salt is a hash of the row, so a task that runs again deals alike; rows of a
    hot key that are equal in all columns stay together. Null keys match nothing and are dealt the same way.
    Pass a written ``large``: it is read once more for the counting. Its columns must be hashable (no maps).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"{how} joins can't be spread: rows of the small side would count once per salt")
    hot = hot_keys(large, *keys, parts=parts)
    if hot.isEmpty():
        return large.join(small, keys, how)
    # at most MAX_HOT rows
    salts = F.coalesce(_SALTS, F.lit(1).cast("bigint"))
    dealt = large.withColumn(_HASH, F.xxhash64(*keys)).join(F.broadcast(hot), _HASH, "left")
    dealt = dealt.withColumn(_SALT, F.pmod(F.xxhash64(F.lit("salt"), *[F.col(f"`{c}`") for c in large.columns]), salts)).drop(_HASH, _SALTS)
    repeated = small.withColumn(_HASH, F.xxhash64(*keys)).join(F.broadcast(hot), _HASH, "left")
    repeated = repeated.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop(_HASH, _SALTS)
    return dealt.join(repeated, [*keys, _SALT], how).drop(_SALT)
