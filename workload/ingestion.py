"""Registered queries on verified writes and incremental ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.session import scratch_path
from renown.sources import tables, versions
from renown.streaming import ingest
from workload import roles
from workload.roles import MONTHS, with_


def arrival_files(spark: SparkSession, sf: str, root: str, finished: bool) -> None:
    """Write the dump lines of finished or of all other orders as files named after 2001 months."""
    lines = (
        roles.derived_lines(spark, sf, finished)
        .select("value", F.concat(F.lit("pageviews-2001"), "month", F.lit("-user")).alias("dump"))
    )
    lines.write.mode("append").partitionBy("dump").text(root)


def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals that share months, ingested by two runs."""
    root = scratch_path(spark, "arrivals")
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-state")
    for finished in (True, False):
        arrival_files(spark, sf, root, finished)
        ingest.ingest_arrivals(spark, f"{root}/*/*.txt", target, checkpoint)
    return ingest.ingested_views(spark, target).withColumn("month", F.substring("month", 6, 2))


def versioned_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals as versions of one table, its months merged to one folder each in between and at the end."""
    arrived, root, checkpoint = (scratch_path(spark, name) for name in ("arrivals", "versions", "version-state"))
    for finished in (True, False):
        arrival_files(spark, sf, arrived, finished)
        ingest.ingest_versioned(spark, f"{arrived}/*/*.txt", root, checkpoint)
        versions.compact(spark, root)
    versions.vacuum(spark, root)
    return ingest.versioned_views(spark, root).withColumn("month", F.substring("month", 6, 2))


def month_table(spark: SparkSession, sf: str) -> DataFrame:
    """Months written one by one as they are missing, then read back with pruning."""
    root = scratch_path(spark, "months")
    views = roles.title_views(spark, sf)
    tables.write_months(views.where(F.col("month") <= "06"), root)
    missing = tables.missing_months(spark, root, MONTHS)
    tables.write_months(views.where(F.col("month").isin(missing)), root)
    return tables.read_months(spark, root, MONTHS).select("month", "title", "views")


def verified_table(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors written with a check of rows and keys, then read back value by value."""
    path = scratch_path(spark, "verified")
    tables.write_verified(roles.table(spark, sf, "embeddings").select("vec_id", "embedding"), path)
    cells = spark.read.parquet(path).select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return cells.withColumn("value", F.round(F.col("value").cast("double"), 6))


QUERIES = {
    "incremental_ingest": incremental_ingest,
    "versioned_ingest": versioned_ingest,
    "month_table": month_table,
    "verified_table": verified_table,
}
_INGESTED = with_(
    roles.EDITIONS, roles.GOOD_LINES,
    select="SELECT month, title, sum(views)::BIGINT AS views FROM good_lines WHERE lang = 'en' GROUP BY 1, 2",
)
ORACLES = {
    "incremental_ingest": _INGESTED,
    "versioned_ingest": _INGESTED,
    "month_table": with_(roles.TITLE_VIEWS, select="SELECT month, title, views FROM title_views"),
    "verified_table": """SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INT AS pos,
        round(unnest(embedding)::DOUBLE, 6) AS value FROM embeddings""",
}
