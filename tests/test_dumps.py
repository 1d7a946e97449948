import bz2
import gzip

import pytest
from pyspark.sql import functions as F

from renown.operators.redirects import redirect_map
from renown.sources import dumps

PAGES = (
    "INSERT INTO `page` VALUES (501,0,'Old_harbour',1,0,0.7,'w'),(502,0,'River_delta',0,0,0.2,'w'),"
    r"(503,3,'Side_note',0,0,0.4,'w'),(504,0,'Land\'s_End',0,0,0.9,'w');"
)
TARGETS = (
    "INSERT INTO `redirect` VALUES (501,0,'New_harbour','',''),(777,12,'Help_desk','',''),"
    r"(505,0,'Land\'s_End','','');"
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_pages(spark):
    got = {tuple(r) for r in dumps.parse_pages(lines(spark, PAGES, "-- comment")).collect()}
    assert got == {
        (501, 0, "Old_harbour", True),
        (502, 0, "River_delta", False),
        (503, 3, "Side_note", False),
        (504, 0, "Land's_End", False),
    }


def test_redirects(spark):
    got = {tuple(r) for r in dumps.parse_redirects(lines(spark, TARGETS)).collect()}
    assert got == {(501, 0, "New_harbour"), (777, 12, "Help_desk"), (505, 0, "Land's_End")}


def test_redirect_map_keeps_article_namespace(spark):
    pages = dumps.parse_pages(lines(spark, PAGES))
    targets = dumps.parse_redirects(lines(spark, TARGETS))
    assert [tuple(r) for r in redirect_map(pages, targets).collect()] == [("Old_harbour", "New_harbour")]


def test_redirect_map_drops_empty_and_self(spark):
    pages = spark.createDataFrame(
        [(1, 0, "a", True), (2, 0, "b", True), (3, 0, "c", True), (4, 0, "", True)],
        "page_id long, namespace int, title string, is_redirect boolean",
    )
    targets = spark.createDataFrame(
        [(1, 0, "a"), (2, 0, ""), (3, 0, "z"), (3, 0, "y"), (4, 0, "x")],
        "page_id long, namespace int, target string",
    )
    assert [tuple(r) for r in redirect_map(pages, targets).collect()] == [("c", "y")]


def test_very_long_titles_do_not_overflow(spark):
    title = "x" * 20_000 + "\\'" * 2_000
    line = f"INSERT INTO `page` VALUES (1,0,'{title}',0,0.5),(2,0,'short',1,0.5);"
    got = dumps.parse_pages(lines(spark, line)).orderBy("page_id").collect()
    assert [len(r["title"]) for r in got] == [22_000, 5]


def test_sitelinks(spark):
    line = (
        "INSERT INTO `wb_items_per_site` VALUES (1,811,'enwiki','River delta'),(2,811,'commonswiki','River delta'),"
        r"(3,812,'dewiki','Land\'s End'),(4,813,'enwiki','Elsewhere');"
    )
    links = dumps.parse_sitelinks(lines(spark, line))
    roster = spark.createDataFrame([(1, "Q811"), (2, "Q812"), (3, None)], "pageid long, qid string")
    got = {tuple(r) for r in dumps.roster_sitelinks(links, roster).select("qid", "site", "title").collect()}
    assert got == {("Q811", "enwiki", "River_delta"), ("Q812", "dewiki", "Land's_End")}


RAW = rb"""en.wikipedia River_delta 502 desktop 40 B2
en.wikipedia River_delta 502 mobile-app 15 B2
en.wikipedia "The_\"Blue\"_Hour" 7 desktop 6 B1
en.wikipedia The_"Blue"_Hour 7 desktop 3 B1
en.wikipedia Too_short 502 40
en.wikipedia No_number 7 desktop many B2
en.m.wikipedia River_delta 502 desktop 800 B2
en.wikivoyage River_delta 502 desktop 800 B2
en.wikipediaold River_delta 502 desktop 800 B2
en.wikipedia Bro?ken 9 desktop 8 B1
zh-yue.wikipedia River_delta 7 desktop 5 B1
EN.wikipedia River_delta 7 desktop 700 B1
en.wikipedia Nobody 7 desktop 0 B1
en.wikipedia Next~line 7 desktop 2 B1
""".replace(b"?", b"\xff\xe2\x82").replace(b"~", "\x85".encode())


def write_dump(folder, month="202507", raw=RAW):
    path = folder / f"pageviews-{month}-user.bz2"
    path.write_bytes(bz2.compress(raw))
    return str(path)


def test_home_views_from_bz2(spark, tmp_path):
    got = dumps.home_views(dumps.read_view_lines(spark, write_dump(tmp_path)))
    assert {tuple(r) for r in got.select("month", "title", "views").collect()} == {
        ("2025-07", "River_delta", 55),
        ("2025-07", 'The_"Blue"_Hour', 9),
        ("2025-07", b"Bro\xff\xe2\x82ken".decode("utf-8", errors="replace"), 8),
        ("2025-07", "Nobody", 0),
        ("2025-07", "Next\x85line", 2),
    }


def test_a_dump_without_a_month_is_an_error(spark, tmp_path):
    path = tmp_path / "views-july.txt"
    path.write_bytes(RAW)
    with pytest.raises(Exception, match="no month in the file name"):
        dumps.home_views(dumps.read_view_lines(spark, str(path))).collect()


def test_all_site_views(spark, tmp_path):
    got = dumps.all_site_views(dumps.read_view_lines(spark, write_dump(tmp_path)))
    by_site = {(r["lang"], r["site"], r["title"]): r["views"] for r in got.collect()}
    assert by_site[("en", "enwiki", "River_delta")] == 55
    assert by_site[("zh-yue", "zh_yuewiki", "River_delta")] == 5
    assert {k[0] for k in by_site} == {"en", "zh-yue"}


def test_sql_lines_from_gz(spark, tmp_path):
    path = tmp_path / "enwiki-latest-page.sql.gz"
    path.write_bytes(gzip.compress(f"-- head\n{PAGES}\nUNLOCK TABLES;\n".encode()))
    read = dumps.read_sql_lines(spark, str(path))
    assert dumps.parse_pages(read).count() == 4


def test_parser_plan_splits_each_line_once(spark):
    df = dumps.home_views(spark.range(3).select(F.col("id").cast("string").alias("value"), F.lit("m").alias("month")))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
