"""Crawl batches and keyed checkpoints in JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRAWL_BATCH = T.StructType(
    [
        T.StructField(
            "pages",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("title", T.StringType()),
                        T.StructField("pageid", T.LongType()),
                        T.StructField("qid", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("continue", T.MapType(T.StringType(), T.StringType())),
    ]
)
TEXT_RECORD = T.StructType(
    [
        T.StructField("pageid", T.LongType()),
        T.StructField("extract", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("thumb_url", T.StringType()),
    ]
)
CLAIMS_RECORD = T.StructType(
    [
        T.StructField("qid", T.StringType()),
        T.StructField("birth_year", T.IntegerType()),
        T.StructField("occupation_qids", T.ArrayType(T.StringType())),
        T.StructField("citizenship_qids", T.ArrayType(T.StringType())),
        T.StructField("gender_qids", T.ArrayType(T.StringType())),
    ]
)


# a broken line is an error: parsed leniently it would vanish
_STRICT = {"mode": "FAILFAST"}


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with an ordinal that grows along each file.

    The ordinal is (file, start of the split, place in the split), so it needs
    no pass through one task.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("place"),
        ).alias("line_no"),
    )


def crawl_pages(lines: DataFrame) -> DataFrame:
    """One row per page of each crawl batch with its crawl order (line_no, pos)."""
    batch = F.from_json("value", CRAWL_BATCH, _STRICT)
    return (
        lines.select("line_no", F.posexplode(batch["pages"]).alias("pos", "page"))
        .select("line_no", "pos", "page.title", "page.pageid", "page.qid")
    )


def crawl_finished(lines: DataFrame) -> DataFrame:
    """One row: number of batches, and whether the last one has no continuation."""
    batch = F.from_json("value", CRAWL_BATCH, _STRICT)
    return lines.agg(
        F.count("*").alias("batches"),
        F.max_by(batch["continue"].isNull(), "line_no").alias("finished"),
    )


def first_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the given order, with its order columns; summed up before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(key).agg(best.alias("_row")).select(key, "_row.*")


def last_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key in the given order."""
    rest = [c for c in rows.columns if c != key and c not in order]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(key).agg(best.alias("_row")).select(key, "_row.*")


def roster_from_crawl(lines: DataFrame) -> DataFrame:
    """Roster of a crawl: overlapping batches repeat pages, the first occurrence stays.

    ``line_no`` and ``pos`` keep the crawl order, which breaks ties of the rankings.
    """
    return first_per_key(crawl_pages(lines), "pageid", ["line_no", "pos"])


def latest_records(lines: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Checkpoint records; the last record of a key wins."""
    records = lines.select("line_no", F.from_json("value", schema, _STRICT).alias("record")).select(
        "line_no", "record.*"
    )
    return last_per_key(records.where(F.col(key).isNotNull()), key, ["line_no"])


def pending_keys(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``wanted`` with a non-null key that the checkpoint doesn't hold yet."""
    return wanted.where(F.col(key).isNotNull()).join(done.select(key), key, "left_anti")
