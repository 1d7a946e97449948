"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_scope: ContextVar[str] = ContextVar("scope", default="")


def local_session(cores: str = "*", app: str = "renown", **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder shared by all executors that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own, because a
    machine-local folder is lost together with its machine.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by the whole cluster")
        root = tempfile.mkdtemp(prefix="renown-scratch-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder."""
    return f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/renown-{spark.sparkContext.applicationId}{_scope.get()}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Staged tables of the block are deleted at its end; results have to be written before."""
    token = _scope.set(f"{_scope.get()}/scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, _folder(spark))
        _scope.reset(token)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and go on from the written table.

    This cuts the lineage, survives the loss of executors and lets later scans
    prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application has staged."""
    _delete(spark, f"{scratch_root(spark)}/renown-{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
