"""View dumps and SQL dumps as DataFrames.

Every parser takes a DataFrame with a ``value`` column of raw lines, so it
serves batch files, streams and derived lines alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.functions.titles import (
    is_language_site,
    item_number,
    repair_utf8,
    site_of_wiki,
    underscored,
    unescape_sql,
    unquote_dump_title,
)

# Line prefix of the home wiki, form of all wikis, month in a dump's file name.
HOME_WIKI = "en.wikipedia"
ANY_WIKI = r"^[a-z-]+\.wikipedia "
DUMP_MONTH = r"pageviews-(\d{4})(\d{2})-"

# A quoted SQL string. The quantifiers are possessive: the plain form recurses
# once per character and overflows the stack on long titles.
_SQL_TEXT = r"'([^'\\]*+(?:\\.[^'\\]*+)*+)'"
PAGE_TUPLE = r"(?d)\((\d+),(-?\d+)," + _SQL_TEXT + r",([01]),"
REDIRECT_TUPLE = r"(?d)\((\d+),(-?\d+)," + _SQL_TEXT
SITELINK_TUPLE = r"(?d)\((\d+),(\d+)," + _SQL_TEXT + "," + _SQL_TEXT + r"\)"


def dump_month(file_name: Column) -> Column:
    """``YYYY-MM`` from a dump's file name; any other name is an error, as its views would be lost."""
    month = F.concat_ws(
        "-",
        F.regexp_extract(file_name, DUMP_MONTH, 1),
        F.regexp_extract(file_name, DUMP_MONTH, 2),
    )
    unknown = F.raise_error(F.concat(F.lit("no month in the file name "), file_name))
    return F.when(file_name.rlike(DUMP_MONTH), month).otherwise(unknown)


def read_view_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of monthly view dumps with their month. bz2 files are split between tasks."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", dump_month(F.col("_metadata.file_name")).alias("month"))


def read_sql_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an SQL dump. One gz file is one task, so lines spread right after the scan."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.where(F.col("value").startswith("INSERT INTO")).repartition(F.xxhash64("value"))


def _fields(lines: DataFrame) -> DataFrame:
    """Split at single spaces; drop lines without an integer in the fifth field.

    Taking the parts out of a generator splits each line once. A plain column
    would be copied into every filter and join condition pushed below it.
    """
    parts = F.split(repair_utf8(F.col("value")), " ", -1)
    keep = [c for c in lines.columns if c != "value"]
    return (
        lines.select(*keep, F.explode(F.array(parts)).alias("_parts"))
        .withColumn("views", F.get("_parts", F.lit(4)).try_cast("bigint"))
        .where(F.col("views").isNotNull())
        .select(
            *keep,
            F.substring_index(F.get("_parts", F.lit(0)), ".", 1).alias("lang"),
            unquote_dump_title(F.get("_parts", F.lit(1))).alias("title"),
            "views",
        )
    )


def home_views(lines: DataFrame, keys: tuple[str, ...] = ("month",), wiki: str = HOME_WIKI) -> DataFrame:
    """Views per title of one wiki, all access types and spellings of a title together."""
    kept = lines.where(F.col("value").startswith(wiki + " "))
    return _fields(kept).groupBy(*keys, "title").agg(F.sum("views").alias("views"))


def all_site_views(
    lines: DataFrame,
    keys: tuple[str, ...] = ("month",),
    wanted: Callable[[Column, Column], Column] | None = None,
    summed: bool = True,
) -> DataFrame:
    """Views per (site, title) of every language edition, one row per title unless ``summed`` is false.

    ``wanted`` may rule out titles by (site, title) before they are summed and shuffled. Without the sums a
    title keeps a row per line, for a join whose result is summed: its titles are shuffled once, not twice.
    """
    kept = _fields(lines.where(F.col("value").rlike(ANY_WIKI)))
    if wanted is not None:
        # out of a generator again, or the test would work out site and title once per use it makes of them
        named = F.struct("lang", "title", "views", site_of_wiki(F.col("lang")).alias("site"))
        kept = kept.select(*keys, F.explode(F.array(named)).alias("_named"))
        kept = kept.where(wanted(F.col("_named.site"), F.col("_named.title"))).select(*keys, "_named.*")
    if summed:
        kept = kept.groupBy(*keys, "lang", "title").agg(F.sum("views").alias("views"))
    elif wanted is not None:
        return kept
    return kept.withColumn("site", site_of_wiki(F.col("lang")))


def _tuples(lines: DataFrame, pattern: str) -> DataFrame:
    inserts = lines.where(F.col("value").startswith("INSERT INTO"))
    found = F.regexp_extract_all(repair_utf8(F.col("value")), F.lit(pattern), F.lit(0))
    return inserts.select(F.explode(found).alias("tuple"))


def _group(pattern: str, index: int) -> Column:
    return F.regexp_extract("tuple", pattern, index)


def parse_pages(lines: DataFrame) -> DataFrame:
    """All pages of a ``page`` dump: page_id, namespace, title, is_redirect."""
    return _tuples(lines, PAGE_TUPLE).select(
        _group(PAGE_TUPLE, 1).cast("bigint").alias("page_id"),
        _group(PAGE_TUPLE, 2).cast("int").alias("namespace"),
        unescape_sql(_group(PAGE_TUPLE, 3)).alias("title"),
        (_group(PAGE_TUPLE, 4) == "1").alias("is_redirect"),
    )


def parse_redirects(lines: DataFrame) -> DataFrame:
    """All rows of a ``redirect`` dump: page_id, namespace, target."""
    return _tuples(lines, REDIRECT_TUPLE).select(
        _group(REDIRECT_TUPLE, 1).cast("bigint").alias("page_id"),
        _group(REDIRECT_TUPLE, 2).cast("int").alias("namespace"),
        unescape_sql(_group(REDIRECT_TUPLE, 3)).alias("target"),
    )


def parse_sitelinks(lines: DataFrame) -> DataFrame:
    """All rows of a ``wb_items_per_site`` dump: row_id, item, site, title (underscored)."""
    return _tuples(lines, SITELINK_TUPLE).select(
        _group(SITELINK_TUPLE, 1).cast("bigint").alias("row_id"),
        _group(SITELINK_TUPLE, 2).cast("bigint").alias("item"),
        unescape_sql(_group(SITELINK_TUPLE, 3)).alias("site"),
        underscored(unescape_sql(_group(SITELINK_TUPLE, 4))).alias("title"),
    )


def roster_sitelinks(sitelinks: DataFrame, roster: DataFrame) -> DataFrame:
    """Sitelinks of language editions whose item belongs to the roster."""
    items = roster.where(F.col("qid").isNotNull()).select(item_number(F.col("qid")).alias("item"))
    return (
        sitelinks.where(is_language_site(F.col("site")))
        .join(items, "item", "left_semi")
        .withColumn("qid", F.concat(F.lit("Q"), F.col("item").cast("string")))
    )
