import pytest
from pyspark.sql import functions as F

from renown.operators import bloom
from renown.sources import versions


def months(spark, rows):
    return spark.createDataFrame(rows, "title string, views long, month string")


def state(df):
    return sorted((r["month"], r["title"], r["views"]) for r in df.collect())


def test_replace_append_and_retry(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.commit(months(spark, [("a", 1, "01"), ("b", 2, "02")]), root) == 1
    assert versions.commit(months(spark, [("c", 3, "02")]), root) == 2  # the month is replaced
    assert state(versions.read(spark, root)) == [("01", "a", 1), ("02", "c", 3)]
    assert state(versions.read(spark, root, version=1)) == [("01", "a", 1), ("02", "b", 2)]
    for batch in (0, 0, 1, 0):  # repeated batches count once
        versions.commit(months(spark, [("d", 4 + batch, "02")]), root, append=True, writer="w", batch=batch)
    assert state(versions.read(spark, root, ["02", "09"])) == [("02", "c", 3), ("02", "d", 4), ("02", "d", 5)]
    assert versions.read(spark, root, ["09"]).count() == 0
    with pytest.raises(ValueError, match="belongs nowhere"):
        versions.commit(months(spark, [("e", 1, None)]), root)
    with pytest.raises(ValueError, match="holds"):
        versions.commit(months(spark, [("e", 1, "01")]).withColumn("views", F.col("views").cast("string")), root)
    assert versions.current(spark, root).number == 4


def test_a_writer_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    versions.commit(months(spark, [("a", 1, "01")]), root)
    before = state(versions.read(spark, root))
    with monkeypatch.context() as m:  # after the data, before the manifest
        m.setattr(versions, "_publish", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            versions.commit(months(spark, [("b", 2, "01")]), root)
    assert state(versions.read(spark, root)) == before
    whole = (tmp_path / "t/manifests/000000000001.json").read_text()
    (tmp_path / "t/manifests/000000000002.json").write_text(whole[: len(whole) // 2])  # within the manifest
    assert state(versions.read(spark, root)) == before
    assert versions.commit(months(spark, [("c", 3, "01")]), root) == 3
    assert state(versions.read(spark, root)) == [("01", "c", 3)]
    assert versions.vacuum(spark, root, keep=1) == 2  # the dead writer's folder and the replaced month
    assert state(versions.read(spark, root)) == [("01", "c", 3)]


def test_two_writers_of_one_number_both_count(spark, tmp_path, monkeypatch):
    root, publish = str(tmp_path / "t"), versions._publish
    versions.commit(months(spark, [("a", 1, "01")]), root)
    other = []

    def late(session, where, version):
        if not other:
            other.append(1)
            versions.commit(months(spark, [("b", 2, "01")]), root, append=True)
        return publish(session, where, version)

    monkeypatch.setattr(versions, "_publish", late)
    assert versions.commit(months(spark, [("c", 3, "01")]), root, append=True) == 3
    assert state(versions.read(spark, root)) == [("01", "a", 1), ("01", "b", 2), ("01", "c", 3)]


def test_compaction_keeps_what_arrives_meanwhile(spark, tmp_path, monkeypatch):
    root, write = str(tmp_path / "t"), versions._write
    for i in range(4):
        versions.commit(months(spark, [("same", 1, "01"), (f"t{i}", i, "02"), ("x", i, "03")]), root, append=True)
    versions.commit(months(spark, [("only", 9, "04")]), root)
    untouched = versions.current(spark, root).folders["04"]

    def slow(df, where, month):
        written = write(df, where, month)
        monkeypatch.setattr(versions, "_write", write)
        versions.commit(months(spark, [("late", 7, "02")]), root, append=True)
        versions.commit(months(spark, [("new", 8, "03")]), root)
        return written

    monkeypatch.setattr(versions, "_write", slow)
    versions.compact(spark, root, file_rows=2)
    now = versions.current(spark, root).folders
    assert [len(now[m]) for m in ("01", "02", "03", "04")] == [1, 2, 1, 1] and now["04"] == untouched
    files = (tmp_path / "t" / now["01"][0]).glob("*.parquet")
    assert 1 <= len(list(files)) <= 2  # four equal rows in two shares, which one task may write
    expected = [("01", "same", 1)] * 4 + [("02", "late", 7)] + [("02", f"t{i}", i) for i in range(4)]
    assert state(versions.read(spark, root)) == expected + [("03", "new", 8), ("04", "only", 9)]
    versions.vacuum(spark, root, keep=1)
    assert state(versions.read(spark, root)) == expected + [("03", "new", 8), ("04", "only", 9)]


def test_key_filter_passes_every_key_and_few_others(spark):
    keys = spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % 7).alias("site"), F.col("id").cast("string").alias("title"))
    may_hold = bloom.key_filter(keys, "site", "title")
    assert keys.where(may_hold(F.col("site"), F.col("title"))).count() == 3000
    others = spark.range(20000).select(F.lit("s0").alias("site"), (F.col("id") + 10**6).cast("string").alias("title"))
    assert others.where(may_hold(F.col("site"), F.col("title"))).count() < 600
    assert others.where(bloom.key_filter(keys.limit(0), "site", "title")(F.col("site"), F.col("title"))).count() == 0
