"""Row numbers and running totals over a whole table without a one-task window."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from renown.session import stage

# monotonically_increasing_id() keeps the partition above bit 33, the row below.
_ROW_BITS = 33


def number_rows(
    df: DataFrame,
    order: list[Column],
    name: str = "rank",
    within: tuple[str, ...] = (),
    running: dict[str, str] | None = None,
) -> DataFrame:
    """Number rows 1..n in the given order, or 1..n inside each ``within`` group.

    Rows are range-partitioned on (group, order), sorted and written once; a
    row's number is its place in its partition plus the number of rows of its
    group in earlier partitions. No partition holds more than its share, however
    large a group is. The order must be total (end it with a unique key), and
    group keys must not be null. ``running`` names running totals over the whole
    order and the columns they add up; they come from the same pass.
    """
    keys = [F.col(c).asc() for c in within] + list(order)
    if within and running:
        raise ValueError("running totals go over the whole order, not over groups")
    slotted = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_slot", F.monotonically_increasing_id())
    placed = stage(_carried(slotted, running or {}), "ordered").withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    if not within:
        return _offset(placed, name, list(running or {}))
    starts = placed.groupBy("_part", *within).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_slot").alias("_first")
    )
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        "_part", *within, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    number = F.col("_slot") - F.col("_first") + F.col("_before") + 1
    return (
        placed.join(starts, ["_part", *within])
        .withColumn(name, number.cast("bigint"))
        .drop("_part", "_slot", "_first", "_before")
    )


def _carried(df: DataFrame, running: dict[str, str]) -> DataFrame:
    """Add running totals inside each partition, in the order of its rows; nulls add nothing."""
    if not running:
        return df
    sums = df.select(*[F.sum(c).alias(n) for n, c in running.items()]).schema
    schema = T.StructType([*df.schema.fields, *sums.fields])
    arrow = to_arrow_schema(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = {n: pa.scalar(0).cast(arrow.field(n).type) for n in running}
        for batch in batches:
            columns = list(batch.columns)
            for n, c in running.items():
                values = batch.column(c).cast(arrow.field(n).type).fill_null(carry[n].as_py() * 0)
                total = pc.cumulative_sum_checked(values, start=carry[n])
                columns.append(total)
                carry[n] = total[-1] if len(total) else carry[n]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *running])

    return df.mapInArrow(run, schema)


def _offset(placed: DataFrame, name: str, totals: list[str]) -> DataFrame:
    """Row numbers and totals over all partitions.

    One row per range partition reaches the driver, as many as the shuffle has partitions; what
    comes before each goes back as a table of that size.
    """
    last = F.max_by(F.struct(*totals), "_slot") if totals else F.lit(None)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_slot").alias("_first"), last.alias("_last")).orderBy("_part").collect()
    rows, before, summed = [], 0, [0] * len(totals)
    for part in parts:
        rows.append((part["_part"], part["_first"], before, *summed))
        before += part["_n"]
        summed = [a + b for a, b in zip(summed, part["_last"] or ())]
    fields = [T.StructField(c, T.LongType()) for c in ("_part", "_first", "_before")]
    fields += [T.StructField(f"_from_{t}", placed.schema[t].dataType) for t in totals]
    starts = placed.sparkSession.createDataFrame(rows, T.StructType(fields))
    number = F.col("_slot") - F.col("_first") + F.col("_before") + 1
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumns({name: number.cast("bigint"), **{t: F.col(t) + F.col(f"_from_{t}") for t in totals}})
        .drop("_part", "_slot", "_first", "_before", *[f"_from_{t}" for t in totals])
    )


def running_total(df: DataFrame, value: str, name: str, rank: str = "rank") -> DataFrame:
    """Running sum of ``value`` by a unique ``rank``.

    The rows are range-partitioned once; each partition adds up its own and starts from the total
    of the earlier ones. Where the ranks are made by ``number_rows``, its ``running`` saves that.
    """
    return number_rows(df, [F.col(rank).asc()], "_number", running={name: value}).drop("_number")
