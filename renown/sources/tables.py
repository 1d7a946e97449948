"""Verified and resumable table writers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType


def _path_and_fs(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    location, fs = _path_and_fs(spark, path)
    return fs.exists(location)


def _content(columns: list[str], maps: frozenset[str] = frozenset()) -> list[Column]:
    """Row count and a hash of the rows with all their values.

    The hashes of the rows are added up, so order and partitions don't matter, while a changed value,
    a doubled row and a lost row all show. Nulls enter by their own flags.
    """
    values = [F.array_sort(F.map_entries(F.col(f"`{c}`"))) if c in maps else F.col(f"`{c}`") for c in columns]
    row = F.xxhash64(*values, *[v.isNull() for v in values])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("row_hash")]


def _content_of(df: DataFrame) -> list[Column]:
    return _content(df.columns, frozenset(f.name for f in df.schema.fields if isinstance(f.dataType, MapType)))


def write_verified(df: DataFrame, path: str) -> int:
    """Write beside ``path``, compare with what was sent, then swap; returns the row count.

    The row count and a hash of all rows are observed while ``df`` is written, so its plan runs once. A repeated task can count twice, so a difference is
    settled by evaluating ``df`` before it is called an error. The old table is moved
    aside, the new one takes its place, and only then is the old one deleted; if the
    move fails the old table is moved back. A failed write leaves nothing behind.
    """
    spark = df.sparkSession
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    new, fs = _path_and_fs(spark, staging)
    target, _ = _path_and_fs(spark, path)
    aside, _ = _path_and_fs(spark, f"{path}.previous-{uuid.uuid4().hex}")
    content = _content_of(df)
    try:
        sent = Observation()
        df.observe(sent, *content).write.parquet(staging)
        found = spark.read.parquet(staging).agg(*content).first().asDict()
        if sent.get != found and df.agg(*content).first().asDict() != found:
            raise RuntimeError(f"{path}: what was written is not what was sent")
        replaced = fs.exists(target)
        if replaced and not fs.rename(target, aside):
            raise RuntimeError(f"could not move {path} aside")
        if not _moved(fs, new, target):
            if replaced:
                fs.rename(aside, target)
            raise RuntimeError(f"could not move {staging} to {path}")
    except Exception:
        fs.delete(new, True)
        raise
    if replaced:
        fs.delete(aside, True)
    return found["rows"]


def _moved(fs, source, target) -> bool:
    """Rename; an error counts as a failure, so that the caller can undo its own step."""
    try:
        return fs.rename(source, target)
    except Exception:
        return False


def write_months(df: DataFrame, root: str, month: str = "month") -> None:
    """Replace only the months present in ``df``; the other months stay untouched."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month)
        .parquet(root)
    )


def missing_months(spark: SparkSession, root: str, months: list[str], month: str = "month") -> list[str]:
    """Months of the window that have no partition yet."""
    return [m for m in months if not path_exists(spark, f"{root}/{month}={m}")]


def read_months(spark: SparkSession, root: str, months: list[str], month: str = "month") -> DataFrame:
    """The available months of the window; partition pruning skips all others."""
    stored = spark.read.parquet(root).schema
    # month names stay text: type inference would turn "01" or "2025" into numbers
    fields = [StructField(month, StringType()) if f.name == month else f for f in stored.fields]
    return spark.read.schema(StructType(fields)).parquet(root).where(F.col(month).isin(months))


def hash60(column: Column) -> Column:
    """60 bits of the md5 of a value's text form, the same on every engine."""
    digest = F.md5(column.cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def fingerprint(df: DataFrame, key: str, **labels: str) -> DataFrame:
    """One row that changes with the key set or with any label (model, variant, size)."""
    return df.agg(
        F.count(key).alias("keys"),
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.bit_xor(hash60(F.col(key))).alias("key_hash"),
        *[F.lit(v).alias(k) for k, v in labels.items()],
    )


def is_stale(df: DataFrame, stored: DataFrame, key: str, **labels: str) -> bool:
    """Whether a stored fingerprint no longer describes ``df``."""
    return fingerprint(df, key, **labels).exceptAll(stored).isEmpty() is False
