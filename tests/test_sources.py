import json

import pytest
from pyspark.sql import functions as F

from renown import session
from renown.operators import expect
from renown.sources import crawl, dumps, tables
from renown.streaming import ingest


def test_crawl_keeps_the_first_occurrence(spark, tmp_path):
    batches = [
        {"pages": [{"title": "A", "pageid": 1, "qid": "Q1"}, {"title": "B", "pageid": 2, "qid": None}], "continue": {"c": "1"}},
        {"pages": [{"title": "B again", "pageid": 2, "qid": "Q2"}, {"title": "C", "pageid": 3, "qid": "Q3"}], "continue": None},
    ]
    (tmp_path / "roster.jsonl").write_text("".join(json.dumps(b) + "\n" for b in batches))
    lines = crawl.read_json_lines(spark, str(tmp_path))
    roster = crawl.roster_from_crawl(lines)
    got = {r["pageid"]: (r["title"], r["qid"]) for r in roster.collect()}
    assert [r["pageid"] for r in roster.orderBy("line_no", "pos").collect()] == [1, 2, 3]
    assert got == {1: ("A", "Q1"), 2: ("B", None), 3: ("C", "Q3")}
    assert tuple(crawl.crawl_finished(lines).first()) == (2, True)


def test_last_record_wins_and_rest_is_pending(spark, tmp_path):
    records = [
        {"pageid": 1, "extract": "old", "description": "d"}, {"pageid": 2, "extract": "x"},
        {"pageid": 1, "extract": "new", "description": None},
    ]
    (tmp_path / "texts.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))
    latest = crawl.latest_records(crawl.read_json_lines(spark, str(tmp_path)), crawl.TEXT_RECORD, "pageid")
    assert {tuple(r)[:3] for r in latest.select("pageid", "extract", "description").collect()} == {
        (1, "new", None), (2, "x", None),
    }
    wanted = spark.createDataFrame([(1,), (3,), (None,)], "pageid long")
    assert [r[0] for r in crawl.pending_keys(wanted, latest, "pageid").collect()] == [3]


def test_lines_keep_their_order_across_splits(spark, tmp_path):
    path = tmp_path / "one.jsonl"
    path.write_text("".join(f'{{"pageid": {i % 7}, "extract": "{i}"}}\n' for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = crawl.read_json_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 3
        latest = crawl.latest_records(lines, crawl.TEXT_RECORD, "pageid").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(int(r["extract"]) for r in latest) == list(range(4993, 5000))


def test_verified_write_leaves_no_stray_files(spark, tmp_path):
    df = spark.range(5).select("id", F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("v"))
    path = tmp_path / "out"
    assert tables.write_verified(df, str(path)) == 5
    assert tables.write_verified(df.where("id > 2"), str(path)) == 2  # replaces the table
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["out"]
    stored = spark.read.parquet(str(path))
    assert stored.agg(F.sum("id")).first()[0] == 7 and stored.dtypes[1] == ("v", "array<float>")


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_verified(spark.range(3), path)
    with pytest.raises(Exception):
        tables.write_verified(spark.range(3).select(F.raise_error(F.lit("boom")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["out"]


class FailingMoves:
    """A file system that renames a number of times and then no more, but for the way back."""

    def __init__(self, fs, allowed):
        self.fs, self.allowed = fs, allowed

    def rename(self, source, target):
        if source.getName().startswith("out.previous"):
            return self.fs.rename(source, target)
        self.allowed -= 1
        return self.allowed >= 0 and self.fs.rename(source, target)

    def __getattr__(self, name):
        return getattr(self.fs, name)


@pytest.mark.parametrize("allowed", [0, 1])
def test_failed_move_keeps_the_old_table(spark, tmp_path, monkeypatch, allowed):
    path = str(tmp_path / "out")
    tables.write_verified(spark.range(3), path)
    plain, failing = tables._path_and_fs, []

    def broken(session, at):
        location, fs = plain(session, at)
        failing.append(failing[0] if failing else FailingMoves(fs, allowed))
        return location, failing[0]

    monkeypatch.setattr(tables, "_path_and_fs", broken)
    with pytest.raises(RuntimeError, match="could not move"):
        tables.write_verified(spark.range(9), path)
    monkeypatch.undo()
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["out"]


def test_verified_write_runs_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(50).mapInArrow(count, "id long")
    assert tables.write_verified(df, str(tmp_path / "out")) == 50
    assert seen.value == 50


def test_broken_json_is_an_error(spark):
    lines = spark.createDataFrame([(1, '{"pageid": 1, "extract": "cut o')], "line_no int, value string")
    with pytest.raises(Exception, match="(?i)malformed"):
        crawl.latest_records(lines, crawl.TEXT_RECORD, "pageid").collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        crawl.roster_from_crawl(lines).collect()


def test_months_are_written_once_each(spark, tmp_path):
    root, months = str(tmp_path / "months"), ["01", "02", "03"]
    rows = spark.createDataFrame([("01", "a", 1), ("02", "a", 2)], "month string, title string, views long")
    assert tables.missing_months(spark, root, months) == months
    tables.write_months(rows, root)
    assert tables.missing_months(spark, root, months) == ["03"]
    tables.write_months(rows.where("month = '02'").withColumn("views", F.lit(9).cast("long")), root)
    read = tables.read_months(spark, root, months)
    assert {tuple(r) for r in read.select("month", "views").collect()} == {("01", 1), ("02", 9)}
    plan = tables.read_months(spark, root, ["02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [(month" in plan


def _content(df):
    return df.agg(*tables._content_of(df)).first()


def test_content_of_a_table_shows_every_change(spark):
    rows = [(1, "a", {"x": 1}), (2, None, {"y": 2, "z": 3}), (2, None, {"y": 2, "z": 3}), (3, "c", None)]
    content = lambda r: _content(spark.createDataFrame(r, "k int, v string, m map<string,int>"))
    same = content(rows[::-1])
    assert content(rows) == same
    for other in (rows[:-1], [*rows, rows[0]], [(1, "b", {"x": 1}), *rows[1:]], [(1, None, {"x": 1}), *rows[1:]], [rows[0], (3, "c", None), (3, "c", None), rows[3]]):
        assert content(other) != same


def test_fingerprint(spark, tmp_path):
    ids = spark.range(10)
    stored = tables.fingerprint(ids, "id", model="a")
    assert not tables.is_stale(ids, stored, "id", model="a")
    assert tables.is_stale(ids, stored, "id", model="b")
    assert tables.is_stale(ids.where("id <> 5"), stored, "id", model="a")
    assert tables.is_stale(ids.select(F.when(F.col("id") == 5, 4).otherwise(F.col("id")).alias("id")), stored, "id", model="a")


def test_expectations(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a")], "id long, t string")
    right = spark.createDataFrame([(2, "b"), (3, "c")], "id long, t string")
    report = expect.report(
        expect.unique(left, "t", "u"), expect.same_keys(left, right, "id", "k"), expect.same_count(left, right, "c"),
        expect.layers_refine(
            spark.createDataFrame([(2, "x"), (2, "y"), (10, "z")], "layer int, label string"), "layers"
        ),
    )
    assert {tuple(r) for r in report.collect()} == {("u", 1), ("k", 2), ("c", 0), ("layers", 1)}
    with pytest.raises(ValueError, match="u: 1"):
        expect.enforce(report)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_staged_tables_end_with_their_scope(spark):
    with session.scratch_scope(spark):
        outer = session.stage(spark.range(3), "outer")
        with session.scratch_scope(spark):
            path = session.stage(spark.range(4), "inner").inputFiles()[0]
            assert tables.path_exists(spark, path)
        assert not tables.path_exists(spark, path)
        assert outer.count() == 3
        kept = outer.inputFiles()[0]
    assert not tables.path_exists(spark, kept)


LINE = "en.wikipedia {} 1 desktop {} A1\n"


def test_incremental_equals_batch(spark, tmp_path):
    arrivals, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    arrivals.mkdir()
    glob = f"{arrivals}/*"
    (arrivals / "pageviews-202507-user.txt").write_text(LINE.format("A", 5) + LINE.format("B", 1) + "de.wikipedia A 1 d 9 A\n")
    assert ingest.ingest_arrivals(spark, glob, target, state) == 1
    assert ingest.ingest_arrivals(spark, glob, target, state) == 0
    # a second file of a month already seen, and a new month
    (arrivals / "pageviews-202507-user-2.txt").write_text(LINE.format("A", 7))
    (arrivals / "pageviews-202508-user.txt").write_text(LINE.format("A", 2))
    assert ingest.ingest_arrivals(spark, glob, target, state, files_per_batch=1) == 2
    got = sorted(map(tuple, ingest.ingested_views(spark, target).collect()))
    batch = dumps.home_views(dumps.read_view_lines(spark, glob)).select("month", "title", "views")
    assert got == sorted(map(tuple, batch.collect())) == [("2025-07", "A", 12), ("2025-07", "B", 1), ("2025-08", "A", 2)]
    assert ingest.ingested_views(spark, target, ["2025-08"]).count() == 1
    # without its checkpoint the batches would be numbered anew and replace what is there
    with pytest.raises(ValueError, match="checkpoint"):
        ingest.ingest_arrivals(spark, glob, target, str(tmp_path / "lost"))
