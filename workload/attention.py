"""Registered queries on dumps, redirects and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.operators import ranking
from renown.operators import redirects as redirect_ops
from renown.plans import attention
from renown.session import scratch_path
from renown.sources import dumps, tables
from workload import roles
from workload.roles import MONTHS, with_

TOP_N = 100
ABSENT = "03"


def dump_parse(spark: SparkSession, sf: str) -> DataFrame:
    return dumps.home_views(roles.dump_lines(spark, sf))


def dump_invalid_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Dump lines whose underscores arrive as the first two bytes of a three-byte character."""
    cut = F.unhex(F.lit("E282")).cast("string")
    path = scratch_path(spark, "invalid")
    lines = roles.derived_lines(spark, sf).withColumn("value", F.replace("value", F.lit("_"), cut))
    lines.write.partitionBy("month").text(path)
    read = spark.read.schema("value string, month string").text(path)
    return dumps.home_views(read)


def item_views(spark: SparkSession, sf: str, summed: bool = True) -> DataFrame:
    return attention.item_views(
        roles.dump_lines(spark, sf),
        roles.crawled(spark, sf),
        roles.sitelinks(spark, sf),
        roles.redirects(spark, sf),
        summed,
    )


def sql_dump_redirects(spark: SparkSession, sf: str) -> DataFrame:
    pages = dumps.parse_pages(roles.page_dump(spark, sf))
    targets = dumps.parse_redirects(roles.redirect_dump(spark, sf))
    return redirect_ops.redirect_map(pages, targets)


def sql_dump_pages(spark: SparkSession, sf: str) -> DataFrame:
    return dumps.parse_pages(roles.page_dump(spark, sf))


def sql_dump_sitelinks(spark: SparkSession, sf: str) -> DataFrame:
    return dumps.roster_sitelinks(
        dumps.parse_sitelinks(roles.sitelink_dump(spark, sf)), roles.crawled(spark, sf)
    ).select("qid", "site", "title")


def site_lookup(spark: SparkSession, sf: str) -> DataFrame:
    links = dumps.roster_sitelinks(roles.sitelinks(spark, sf), roles.crawled(spark, sf))
    return redirect_ops.site_lookup(links, roles.redirects(spark, sf))


def stale_roster(spark: SparkSession, sf: str) -> DataFrame:
    return redirect_ops.drop_redirect_pages(roles.crawled(spark, sf), roles.redirects(spark, sf))


def redirect_resolve(spark: SparkSession, sf: str) -> DataFrame:
    resolved = redirect_ops.resolve_titles(roles.title_views(spark, sf), roles.redirects(spark, sf))
    roster = stale_roster(spark, sf).select("title")
    return (
        resolved.groupBy("title", "month")
        .agg(F.sum("views").alias("views"))
        .join(roster, "title", "left_semi")
    )


def monthly_matrix(spark: SparkSession, sf: str) -> DataFrame:
    roster, redirects = stale_roster(spark, sf), roles.redirects(spark, sf)
    lookup = redirect_ops.home_lookup(roster, redirects)
    credited = roles.title_views(spark, sf).join(lookup, "title")
    matrix = ranking.monthly_matrix(credited, MONTHS, ("pageid",))
    columns = [ranking.month_column(m) for m in MONTHS]
    return roster.select("pageid").join(matrix, "pageid", "left").na.fill(0, columns)


def home_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return attention.rank_home(
        roles.title_views(spark, sf), roles.crawled(spark, sf), roles.redirects(spark, sf), MONTHS
    )


HOME_COLUMNS = [
    "rank", "pageid", "title", "qid", "median_views", "total_views", "max_views", "n_months", "median_present",
]


def rank_median(spark: SparkSession, sf: str) -> DataFrame:
    return home_ranked(spark, sf).select(HOME_COLUMNS)


def rank_top(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred of the roster without ranking the rest."""
    first = attention.top_home(
        roles.title_views(spark, sf), roles.crawled(spark, sf), roles.redirects(spark, sf), MONTHS, TOP_N
    )
    return first.select(HOME_COLUMNS)


def rank_crawl_order(spark: SparkSession, sf: str) -> DataFrame:
    """Ties in an order of crawling that differs from the order of keys; views count once per month, so ties abound."""
    crawled = roles.crawled(spark, sf).withColumn("crawl_no", F.col("pageid") * 7919 % 1_000_003)
    views = roles.title_views(spark, sf).withColumn("views", F.lit(1).cast("bigint"))
    ranked = attention.rank_home(views, crawled, roles.redirects(spark, sf), MONTHS, ("crawl_no", "pageid"))
    return ranked.select("rank", "pageid", "median_views", "total_views")


def rank_available_months(spark: SparkSession, sf: str) -> DataFrame:
    """A window with a month that isn't stored: the others decide."""
    root = scratch_path(spark, "stored-months")
    tables.write_months(roles.title_views(spark, sf).where(F.col("month") != ABSENT), root)
    ranked = attention.rank_stored(spark, root, roles.crawled(spark, sf), roles.redirects(spark, sf), MONTHS)
    return ranked.select("rank", "pageid", "median_views", "total_views", "n_months")


def global_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return attention.rank_global(item_views(spark, sf, summed=False), home_ranked(spark, sf), MONTHS, summed=False)


GLOBAL_COLUMNS = [
    "rank", "item", "qid", "pageid", "title", "median_views", "total_views", "max_views", "n_months",
    "top_lang", "enwiki_rank", "enwiki_median",
]


def rank_global(spark: SparkSession, sf: str) -> DataFrame:
    share = F.round(F.col("english_share").cast("double"), 6).alias("english_share")
    return global_ranked(spark, sf).select(*GLOBAL_COLUMNS, share)


_LIST = ", ".join
_MATRIX = _LIST(f"sum(CASE WHEN month = '{m}' THEN views ELSE 0 END)::BIGINT AS views_{m}" for m in MONTHS)
_OWN = f"'O''' || replace({roles.PART_TITLE}, ' ', '_') || '\\'"

QUERIES = {
    "dump_parse": dump_parse,
    "dump_invalid_bytes": dump_invalid_bytes,
    "dump_parse_all_sites": item_views,
    "sql_dump_pages": sql_dump_pages,
    "sql_dump_redirects": sql_dump_redirects,
    "sql_dump_sitelinks": sql_dump_sitelinks,
    "site_lookup": site_lookup,
    "stale_roster": stale_roster,
    "redirect_resolve": redirect_resolve,
    "monthly_matrix": monthly_matrix,
    "rank_median": rank_median,
    "rank_global": rank_global,
    "rank_top": rank_top,
    "rank_crawl_order": rank_crawl_order,
    "rank_available_months": rank_available_months,
}

ORACLES = {
    "dump_parse": with_(
        roles.EDITIONS, roles.GOOD_LINES,
        select="SELECT month, title, sum(views)::BIGINT AS views FROM good_lines WHERE lang = 'en' GROUP BY 1, 2",
    ),
    "dump_invalid_bytes": with_(
        roles.EDITIONS, roles.GOOD_LINES,
        select="""SELECT month, replace(title, '_', chr(65533)) AS title, sum(views)::BIGINT AS views
        FROM good_lines WHERE lang = 'en' GROUP BY 1, 2""",
    ),
    "dump_parse_all_sites": with_(
        roles.CRAWLED, roles.REDIRECTS, roles.EDITIONS, roles.GOOD_LINES, roles.SITELINKS, roles.SITE_LOOKUP,
        select="SELECT item, lang, month, views FROM item_views",
    ),
    "sql_dump_pages": f"""SELECT p_partkey AS page_id, CASE p_type WHEN 'MEDIUM' THEN 1 ELSE 0 END AS namespace,
        {_OWN} AS title, p_type = 'PROMO' AS is_redirect FROM part""",
    "sql_dump_redirects": f"""SELECT {_OWN} AS source_title, 'L''' || p_brand AS target_title
        FROM part WHERE p_type = 'PROMO' AND p_size NOT IN (1, 2, 3)""",
    "sql_dump_sitelinks": with_(
        roles.SITELINKS, roles.CRAWLED,
        select="""SELECT 'Q' || item AS qid, site, title FROM sitelinks
        WHERE site NOT IN ('commonswiki', 'enwikiquote')
          AND 'Q' || item IN (SELECT qid FROM crawled WHERE qid IS NOT NULL)""",
    ),
    "site_lookup": with_(
        roles.CRAWLED, roles.REDIRECTS, roles.EDITIONS, roles.GOOD_LINES, roles.ROSTER_SITELINKS, roles.SITE_LOOKUP,
        select="SELECT site, title, item FROM site_lookup",
    ),
    "stale_roster": with_(roles.CRAWLED, roles.REDIRECTS, roles.ROSTER, select="SELECT * FROM roster"),
    "redirect_resolve": with_(
        *roles.HOME,
        select="SELECT title, month, views FROM credited WHERE title IN (SELECT title FROM roster)",
    ),
    "monthly_matrix": with_(*roles.HOME, select=f"SELECT pageid, {_MATRIX} FROM grid GROUP BY pageid"),
    "rank_median": with_(*roles.HOME, select=f"SELECT {_LIST(HOME_COLUMNS)} FROM home_ranked"),
    "rank_top": with_(*roles.HOME, select=f"SELECT {_LIST(HOME_COLUMNS)} FROM home_ranked WHERE rank <= {TOP_N}"),
    "rank_crawl_order": with_(
        roles.CRAWLED, roles.REDIRECTS, roles.ROSTER, roles.TITLE_VIEWS.replace("title_views AS", "all_views AS", 1),
        "title_views AS (SELECT title, month, 1::BIGINT AS views FROM all_views)", roles.HOME_GRID, roles.HOME_RANKED,
        select="""SELECT row_number() OVER (ORDER BY median_views DESC, total_views DESC, pageid * 7919 % 1000003, pageid) AS rank,
        pageid, median_views, total_views FROM home_metrics""",
    ),
    "rank_available_months": with_(
        *[part.replace(f"('{ABSENT}'), ", "") for part in roles.HOME],
        select="SELECT rank, pageid, median_views, total_views, n_months FROM home_ranked",
    ),
    "rank_global": with_(
        *roles.GLOBAL,
        select=f"SELECT {_LIST(GLOBAL_COLUMNS)}, round(english_share::DOUBLE, 6) AS english_share FROM global_ranked",
    ),
}
