"""A Bloom filter over the keys of a small table, tested before a large one is shuffled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Filter words of 64 bits: keys a word is made for, and the most words (16 MB).
KEYS_PER_WORD, MAX_WORDS = 4, 1 << 21


def _word(keys: list[Column], words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(words)).cast("int")


def _mask(keys: list[Column]) -> Column:
    """Four of 64 bits, from four runs of six bits of a second hash."""
    name = F.xxhash64(F.lit(2), *keys)
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftright(name, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def key_filter(table: DataFrame, *columns: str) -> Callable[..., Column]:
    """A test that holds for every key of ``table`` and for about one in a hundred others.

    Every task adds its keys to the words it meets, the words are merged by OR, and the filter
    reaches the tasks as one scalar of at most 16 MB whatever the size of the table; a table with more
    than eight million keys makes the test weaker, never wrong. A key with a null never joins: the test is as for any
    other value. ``table`` is read twice, so pass a written one.
    """
    keys = [F.col(c) for c in columns]
    words = min(MAX_WORDS, max(1, -(-table.count() // KEYS_PER_WORD)))
    set_ = table.select(_word(keys, words).alias("word"), _mask(keys).alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    all_ = table.sparkSession.range(words).select(F.col("id").cast("int").alias("word"))
    dense = all_.join(set_, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "mask")))
    filter_ = dense.agg(F.transform(ordered, lambda w: w["mask"]).alias("words")).scalar()

    def may_hold(*values: Column) -> Column:
        mask = _mask(list(values))
        return F.get(filter_, _word(list(values), words)).bitwiseAND(mask) == mask

    return may_hold
