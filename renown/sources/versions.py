"""Monthly tables in versions: data folders that never change, and one manifest per version.

A manifest names the folders of each month. It is written after all data, under the next number,
and a reader takes the newest one that is whole, so a writer that dies at any step
leaves the version before. No folder is renamed, which object stores can't do at once. Two writers
that take the same number: the second fails to create it, and lays its change over the newer version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from renown.sources.tables import _path_and_fs

_BATCH, _ATTEMPTS = "_batch", 20


@dataclass
class Version:
    """``folders``: data folders of each month; ``applied``: last batch number of each writer."""

    number: int = 0
    month: str = "month"
    schema: dict | None = None
    folders: dict[str, list[str]] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    path, fs = _path_and_fs(spark, f"{root}/manifests")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))), reverse=True)


def _load(spark: SparkSession, root: str, number: int) -> Version | None:
    """A version, or nothing where its manifest was not written to the end."""
    path, _ = _path_and_fs(spark, f"{root}/manifests/{number:012d}.json")
    text = "".join(r[0] for r in spark.read.text(path.toString(), wholetext=True).collect())  # one line per month and folder
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return Version(**found)


def current(spark: SparkSession, root: str) -> Version:
    """The newest whole version; number 0 and empty where there is none."""
    return next((v for n in _numbers(spark, root) if (v := _load(spark, root, n))), Version())


def _publish(spark: SparkSession, root: str, version: Version) -> bool:
    """Create the manifest; false if another writer has taken the number."""
    path, fs = _path_and_fs(spark, f"{root}/manifests/{version.number:012d}.json")
    if fs.exists(path):
        return False
    try:
        out = fs.create(path, False)
    except Exception as error:
        if fs.exists(path):
            return False
        raise error
    try:
        out.write(bytearray(json.dumps(vars(version)).encode()))
    finally:
        out.close()
    return True


def _commit(spark: SparkSession, root: str, change: Callable[[Version], Version | None]) -> int:
    for _ in range(_ATTEMPTS):
        # a broken manifest keeps its number, so the next one is beyond all that exist
        newest, taken = current(spark, root), max(_numbers(spark, root), default=0)
        new = change(newest)
        if new is None:
            return newest.number
        new.number = taken + 1
        if _publish(spark, root, new):
            return new.number
    raise RuntimeError(f"{root}: other writers took the next version {_ATTEMPTS} times")


def _write(df: DataFrame, root: str, month: str) -> dict[str, str]:
    """Write a new data folder; returns its subfolder for each month, relative to the root."""
    name = f"data/{_BATCH}={uuid.uuid4().hex}"
    df.write.partitionBy(month).parquet(f"{root}/{name}")
    path, fs = _path_and_fs(df.sparkSession, f"{root}/{name}")
    found = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    if f"{month}=__HIVE_DEFAULT_PARTITION__" in found:
        fs.delete(path, True)
        raise ValueError(f"{root}: a row without a {month} belongs nowhere")
    return {f.split("=", 1)[1]: f"{name}/{f}" for f in found if f.startswith(f"{month}=")}


def commit(df: DataFrame, root: str, month: str = "month", append: bool = False, writer: str | None = None, batch: int = 0) -> int:
    """Replace the months of ``df``, or add to them, as one new version; returns its number.

    A ``writer`` numbers its batches from 0 upwards; a batch that was committed before is left out, so a
    retry counts once. Other months stay as they are. An empty ``df`` gives a version without new rows.
    """
    spark = df.sparkSession
    if writer is not None and current(spark, root).applied.get(writer, -1) >= batch:
        return current(spark, root).number
    stored = StructType([f for f in df.schema.fields if f.name != month])
    written = _write(df, root, month)

    def change(old: Version) -> Version | None:
        if writer is not None and old.applied.get(writer, -1) >= batch:
            return None
        if old.schema is not None and StructType.fromJson(old.schema).simpleString() != stored.simpleString():
            raise ValueError(f"{root} holds {StructType.fromJson(old.schema).simpleString()}, not {stored.simpleString()}")
        added = {m: (old.folders.get(m, []) if append else []) + [f] for m, f in written.items()}
        applied = old.applied if writer is None else old.applied | {writer: batch}
        return Version(0, month, stored.jsonValue(), old.folders | added, applied)

    return _commit(spark, root, change)


def read(spark: SparkSession, root: str, months: list[str] | None = None, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the newest; folders of other months are not opened."""
    found = current(spark, root) if version is None else _load(spark, root, version)
    if found is None or found.schema is None:
        raise ValueError(f"{root} holds no such version")
    return _rows(spark, root, found, found.folders if months is None else [m for m in months if m in found.folders])


def _rows(spark: SparkSession, root: str, version: Version, months) -> DataFrame:
    fields = StructType.fromJson(version.schema).fields + [StructField(version.month, StringType())]
    paths = [f"{root}/{f}" for m in months for f in version.folders[m]]
    if not paths:
        return spark.createDataFrame([], StructType(fields))
    schema = StructType([*fields, StructField(_BATCH, StringType())])
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*paths).drop(_BATCH)


def compact(spark: SparkSession, root: str, file_rows: int = 10_000_000) -> int:
    """Rewrite the months of more than one folder as one folder each; returns the version that holds.

    Rows are dealt by month and a salt in shares of about ``file_rows``, so one large month is many files and
    tasks. Folders that arrive meanwhile are kept beside the compacted ones. A month that was replaced meanwhile keeps its replacement.
    """
    old = current(spark, root)
    many = [m for m, f in old.folders.items() if len(f) > 1]
    if not many:
        return old.number
    rows = _rows(spark, root, old, many)
    sizes = rows.groupBy(old.month).count().withColumn("_files", F.ceil(F.col("count") / file_rows)).drop("count")
    salt = F.pmod(F.monotonically_increasing_id(), F.col("_files"))  # spreads equal rows too
    dealt = rows.join(F.broadcast(sizes), old.month).withColumn("_salt", salt).repartition(old.month, "_salt")  # one size a month
    written = _write(dealt.drop("_files", "_salt"), root, old.month)

    def change(now: Version) -> Version | None:
        folders = dict(now.folders)
        for m in many:
            merged = set(old.folders[m])
            if merged <= set(now.folders.get(m, [])):
                folders[m] = [written[m]] + [f for f in now.folders[m] if f not in merged]
        return Version(0, now.month, now.schema, folders, now.applied)

    return _commit(spark, root, change)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete month folders that none of the last ``keep`` versions names; returns how many.

    Run it while nobody writes: the folder of a writer that has not committed looks like that of a dead one.
    """
    kept = [v for n in _numbers(spark, root) if (v := _load(spark, root, n))][:keep]
    named = {f for v in kept for folders in v.folders.values() for f in folders}
    data, fs = _path_and_fs(spark, f"{root}/data")
    if not fs.exists(data):
        return 0
    gone = 0
    for batch in fs.listStatus(data):
        left = [s.getPath() for s in fs.listStatus(batch.getPath()) if s.isDirectory()]
        old = [p for p in left if f"data/{batch.getPath().getName()}/{p.getName()}" not in named]
        gone += len(old)
        for path in [batch.getPath()] if len(old) == len(left) else old:
            fs.delete(path, True)
    return gone
