"""Incremental ingestion of view dumps as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.sources import versions
from renown.sources.dumps import dump_month, home_views
from renown.sources.tables import path_exists


def ingest_arrivals(
    spark: SparkSession, arrivals: str, target: str, checkpoint: str, files_per_batch: int | None = None
) -> int:
    """Parse the dump files that arrived since the last call; returns the batches run.

    Each micro-batch writes its own sums under (month, batch). A batch that is
    run again after a failure replaces what it wrote, and two files of the same
    month in different batches both count, so every line counts exactly once.
    ``arrivals`` is a glob of files named after their month.
    """
    _refuse_lost_state(spark, target, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        sums = home_views(batch).withColumn("batch", F.lit(batch_id))
        (
            sums.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("month", "batch")
            .parquet(target)
        )

    return _run(spark, arrivals, checkpoint, files_per_batch, write)


def ingest_versioned(
    spark: SparkSession, arrivals: str, root: str, checkpoint: str, files_per_batch: int | None = None
) -> int:
    """As ``ingest_arrivals``, into a versioned table: every micro-batch is one version of ``root``.

    The version remembers the batch number, so a batch that is run again after a failure counts once, also
    when ``versions.compact`` has merged its folders meanwhile. Read it with ``versioned_views``.
    """
    _refuse_lost_state(spark, root, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        versions.commit(home_views(batch), root, append=True, writer="arrivals", batch=batch_id)

    return _run(spark, arrivals, checkpoint, files_per_batch, write)


def versioned_views(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """(month, title, views) of the newest version; folders of unread months are not opened."""
    return versions.read(spark, root, months).groupBy("month", "title").agg(F.sum("views").alias("views"))


def _refuse_lost_state(spark: SparkSession, target: str, checkpoint: str) -> None:
    if path_exists(spark, target) and not path_exists(spark, checkpoint):
        # batch numbers would start again and meet sums that are there
        raise ValueError(f"{target} holds views, but their checkpoint {checkpoint} is gone")


def _run(
    spark: SparkSession, arrivals: str, checkpoint: str, files_per_batch: int | None, write: Callable[[DataFrame, int], None]
) -> int:
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(arrivals).select("value", dump_month(F.col("_metadata.file_path")).alias("month"))
    run = []

    def counted(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        run.append(batch_id)

    query = (
        lines.writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(run)


def ingested_views(spark: SparkSession, target: str, months: list[str] | None = None) -> DataFrame:
    """(month, title, views) over all batches; unread months are pruned."""
    stored = spark.read.schema("title string, views bigint, month string, batch bigint").parquet(target)
    if months is not None:
        stored = stored.where(F.col("month").isin(months))
    return stored.groupBy("month", "title").agg(F.sum("views").alias("views"))
