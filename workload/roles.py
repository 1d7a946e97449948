"""Stand-in roles on the driver tables, in Spark and in SQL.

entity     part; LARGE parts have a title with double quotes
redirect   a PROMO part points at the first other part of its brand and size
views      lineitem; month = calendar month of the ship date, over all years
edition    region of the line's supplier; EUROPE is the home edition
cut-offs   customer and orders, whose months are sparse
texts      documents; claims: orders; vectors: embeddings
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.functions.titles import escape_sql, quote_dump_title, underscored
from renown.session import scratch_path

MONTHS = [f"{m:02d}" for m in range(1, 13)]
WIKI_OF_REGION = {
    "EUROPE": "en",
    "AMERICA": "gsw",
    "ASIA": "zh-yue",
    "AFRICA": "be-tarask",
    "MIDDLE EAST": "de",
}
# sites of the derived sitelinks; the last two are no language editions
SITES = ["enwiki", "alswiki", "zh_yuewiki", "be_x_oldwiki", "dewiki", "commonswiki", "enwikiquote"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows of a file of few splits over all tasks, by number, as their bytes say little about the work on them."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, key)


def part_title() -> Column:
    name, key = F.col("p_name"), F.col("p_partkey").cast("string")
    quoted = F.concat(F.lit('"'), name, F.lit('" '), key)
    return F.when(F.col("p_type") == "LARGE", quoted).otherwise(F.concat(name, F.lit(" "), key))


PART_TITLE = """CASE WHEN p_type = 'LARGE' THEN '"' || p_name || '" ' || p_partkey
                     ELSE p_name || ' ' || p_partkey END"""


def crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawled roster, redirect pages included."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pageid"),
        part_title().alias("title"),
        F.when(F.col("p_size") != 50, F.concat(F.lit("Q"), F.col("p_partkey").cast("string"))).alias("qid"),
    )


CRAWLED = f"""crawled AS (
  SELECT p_partkey AS pageid, {PART_TITLE} AS title,
         CASE WHEN p_size <> 50 THEN 'Q' || p_partkey END AS qid
  FROM part)"""


def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    slug = underscored(part_title())
    targets = (
        part.where(F.col("p_type") != "PROMO")
        .groupBy("p_brand", "p_size")
        .agg(F.min_by(slug, "p_partkey").alias("target_title"))
    )
    return (
        part.where(F.col("p_type") == "PROMO")
        .select("p_brand", "p_size", slug.alias("source_title"))
        .join(targets, ["p_brand", "p_size"])
        .select("source_title", "target_title")
    )


REDIRECTS = f"""redirects AS (
  SELECT replace(s.title, ' ', '_') AS source_title, replace(t.title, ' ', '_') AS target_title
  FROM (SELECT p_brand, p_size, {PART_TITLE} AS title FROM part WHERE p_type = 'PROMO') s
  JOIN (SELECT p_brand, p_size, arg_min({PART_TITLE}, p_partkey) AS title
        FROM part WHERE p_type <> 'PROMO' GROUP BY p_brand, p_size) t
    USING (p_brand, p_size))"""

ROSTER = """roster AS (
  SELECT * FROM crawled
  WHERE replace(title, ' ', '_') NOT IN (SELECT source_title FROM redirects))"""


def ship_month() -> Column:
    return F.lpad(F.month("l_shipdate").cast("string"), 2, "0")


def title_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, title, views) of all lines; summed per part before the title is looked up."""
    part = table(spark, sf_dir, "part").select("p_partkey", underscored(part_title()).alias("title"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"), ship_month().alias("month"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("views"))
        .join(part, "p_partkey")
        .select("month", "title", "views")
    )


TITLE_VIEWS = f"""title_views AS (
  SELECT strftime(l_shipdate, '%m') AS month, replace({PART_TITLE}, ' ', '_') AS title,
         sum(l_quantity::BIGINT)::BIGINT AS views
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)"""


def with_edition(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    """Add the wiki of each line's supplier, one small table at a time."""
    wikis = F.create_map(*[F.lit(x) for pair in WIKI_OF_REGION.items() for x in pair])
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        items.join(supplier, "l_suppkey")
        .join(nation, "s_nationkey")
        .join(region, "n_regionkey")
        .withColumn("wiki", F.try_element_at(wikis, F.col("r_name")))
    )


_WIKI_CASE = " ".join(f"WHEN '{r}' THEN '{w}'" for r, w in WIKI_OF_REGION.items())
EDITIONS = f"""editions AS (
  SELECT s_suppkey AS l_suppkey, CASE r_name {_WIKI_CASE} END AS wiki
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived view dumps, written as text files per month and scanned as such."""
    path = scratch_path(spark, "dumps")
    derived_lines(spark, sf_dir).write.partitionBy("month").text(path)
    return spark.read.schema("value string, month string").text(path)


def derived_lines(spark: SparkSession, sf_dir: str, finished: bool | None = None) -> DataFrame:
    """One raw dump line per lineitem row, with bad lines and both spellings of quoted titles.

    ``finished`` picks the lines of status F or all others, to let them arrive in two parts.
    """
    slug = underscored(part_title())
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), slug.alias("slug"), quote_dump_title(slug).alias("quoted")
    )
    tax, discount = F.col("l_tax"), F.col("l_discount")
    domain = (
        F.when((tax == 0.0) & (discount == 0.0), ".m.wikipedia")
        .when((tax == 0.01) & (discount == 0.0), ".wikibooks")
        .otherwise(".wikipedia")
    )
    title = F.when(F.col("l_linestatus") == "F", F.col("quoted")).otherwise(F.col("slug"))
    access = (
        F.when(F.col("l_returnflag") == "A", "desktop")
        .when(F.col("l_returnflag") == "N", "mobile-web")
        .otherwise("mobile-app")
    )
    # concat_ws() skips nulls, which makes the lines that are too short
    count = (
        F.when((tax == 0.08) & (discount == 0.1), "x")
        .when((tax == 0.07) & (discount == 0.1), None)
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    )
    tail = F.when(count.isNotNull(), "A1")
    line = F.concat_ws(
        " ", F.concat("wiki", domain), title, F.col("l_partkey").cast("string"), access, count, tail
    )
    items = table(spark, sf_dir, "lineitem")
    if finished is not None:
        items = items.where(F.col("l_linestatus").eqNullSafe(F.lit("F")) == F.lit(finished))
    return (
        with_edition(spark, sf_dir, items.join(part, "l_partkey"))
        .select(ship_month().alias("month"), line.alias("value"))
    )


# the lines that a correct parser keeps
GOOD_LINES = f"""good_lines AS (
  SELECT strftime(l_shipdate, '%m') AS month, wiki AS lang, replace({PART_TITLE}, ' ', '_') AS title,
         l_quantity::BIGINT AS views
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN editions USING (l_suppkey)
  WHERE NOT (l_tax = 0.0 AND l_discount = 0.0) AND NOT (l_tax = 0.01 AND l_discount = 0.0)
    AND NOT (l_tax = 0.08 AND l_discount = 0.1) AND NOT (l_tax = 0.07 AND l_discount = 0.1))"""


def sitelinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, item, site, title): every part on every site, redirect pages not on the home site.

    The parts are one small file, so they are dealt over tasks before each of them becomes a row per site.
    """
    part = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), "p_partkey")
    rows = part.select(
        "p_partkey",
        "p_type",
        underscored(part_title()).alias("title"),
        F.posexplode(F.array(*[F.lit(s) for s in SITES])).alias("pos", "site"),
    )
    return rows.where((F.col("site") != "enwiki") | (F.col("p_type") != "PROMO")).select(
        (F.col("p_partkey") * len(SITES) + F.col("pos")).alias("row_id"),
        F.col("p_partkey").alias("item"),
        "site",
        "title",
    )


_SITE_LIST = ", ".join(f"'{s}'" for s in SITES)
SITELINKS = f"""sitelinks AS (
  SELECT p_partkey AS item, site, replace({PART_TITLE}, ' ', '_') AS title
  FROM part, (SELECT unnest([{_SITE_LIST}]) AS site)
  WHERE site <> 'enwiki' OR p_type <> 'PROMO')"""
# only items of the crawled roster, before the lookup is built
ROSTER_SITELINKS = SITELINKS.replace(
    "WHERE site <> 'enwiki' OR p_type <> 'PROMO'", "WHERE p_size <> 50 AND (site <> 'enwiki' OR p_type <> 'PROMO')"
)


def insert_lines(rows: DataFrame, name: str, tuple_text: Column, block: Column) -> DataFrame:
    """INSERT lines of at most one block of tuples each, as an SQL dump writes them."""
    tuples = rows.select(block.alias("_block"), tuple_text.alias("_tuple"))
    joined = F.array_join(F.collect_list("_tuple"), ",")
    head = F.lit(f"INSERT INTO `{name}` VALUES ")
    return tuples.groupBy("_block").agg(F.concat(head, joined, F.lit(";")).alias("value")).select("value")


def page_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``page`` dump of the parts; MEDIUM parts lie outside the article namespace."""
    part = table(spark, sf_dir, "part")
    text = F.concat(
        F.lit("("), F.col("p_partkey").cast("string"),
        F.when(F.col("p_type") == "MEDIUM", ",1,'").otherwise(",0,'"),
        escape_sql(F.concat(F.lit("O'"), underscored(part_title()), F.lit("\\"))),
        F.when(F.col("p_type") == "PROMO", "',1,0.5)").otherwise("',0,0.5)"),
    )
    return insert_lines(part, "page", text, F.floor(F.col("p_partkey") / 50))


def redirect_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``redirect`` dump: PROMO parts point at a title built from their brand.

    Parts of size 1 point outside the article namespace, size 2 at themselves, size 3 nowhere.
    """
    part = table(spark, sf_dir, "part").where(F.col("p_type") == "PROMO")
    own = F.concat(F.lit("O'"), underscored(part_title()), F.lit("\\"))
    target = (
        F.when(F.col("p_size") == 2, own)
        .when(F.col("p_size") == 3, F.lit(""))
        .otherwise(F.concat(F.lit("L'"), F.col("p_brand")))
    )
    text = F.concat(
        F.lit("("), F.col("p_partkey").cast("string"),
        F.when(F.col("p_size") == 1, ",4,'").otherwise(",0,'"),
        escape_sql(target), F.lit("','','')"),
    )
    return insert_lines(part, "redirect", text, F.floor(F.col("p_partkey") / 50))


def sitelink_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``wb_items_per_site`` dump of the sitelinks, titles with spaces."""
    links = sitelinks(spark, sf_dir)
    text = F.concat(
        F.lit("("), F.col("row_id").cast("string"), F.lit(","), F.col("item").cast("string"),
        F.lit(",'"), escape_sql(F.col("site")), F.lit("','"),
        escape_sql(F.replace(F.col("title"), F.lit("_"), F.lit(" "))), F.lit("')"),
    )
    return insert_lines(links, "wb_items_per_site", text, F.floor(F.col("row_id") / 50))


def patron_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, month, views) of customers; many of their months are empty."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("entity"), F.date_format("o_orderdate", "MM").alias("month"))
        .agg(F.sum(F.floor("o_totalprice")).alias("views"))
    )


_ZERO = "(VALUES " + ", ".join(f"('{m}')" for m in MONTHS) + ") AS m(month)"
# rank, median and total of every customer
PATRONS = f"""patron_grid AS (
  SELECT c_custkey AS entity, c_name AS title, m.month, coalesce(v.views, 0) AS views
  FROM customer CROSS JOIN {_ZERO}
  LEFT JOIN (SELECT o_custkey, strftime(o_orderdate, '%m') AS month, sum(floor(o_totalprice))::BIGINT AS views
             FROM orders GROUP BY 1, 2) v ON v.o_custkey = c_custkey AND v.month = m.month),
patron_metrics AS (
  SELECT entity, any_value(title) AS title, median(views) AS median_views, sum(views)::BIGINT AS total_views,
         max(views) AS max_views, count(*) FILTER (views > 0) AS n_months
  FROM patron_grid GROUP BY entity),
patrons AS (
  SELECT *, row_number() OVER (ORDER BY median_views DESC, total_views DESC, entity) AS rank
  FROM patron_metrics)"""

# zero-filled grid, metrics and rank of the roster in the home edition
HOME_GRID = f"""resolved AS (
  SELECT v.month, replace(coalesce(r.target_title, v.title), '_', ' ') AS title, v.views
  FROM title_views v LEFT JOIN redirects r ON r.source_title = v.title),
credited AS (SELECT title, month, sum(views)::BIGINT AS views FROM resolved GROUP BY 1, 2),
grid AS (
  SELECT pageid, roster.title, qid, m.month, coalesce(c.views, 0) AS views
  FROM roster CROSS JOIN {_ZERO}
  LEFT JOIN credited c ON c.title = roster.title AND c.month = m.month)"""
HOME_RANKED = """home_metrics AS (
  SELECT pageid, any_value(title) AS title, any_value(qid) AS qid, median(views) AS median_views,
         sum(views)::BIGINT AS total_views, max(views) AS max_views,
         count(*) FILTER (views > 0) AS n_months,
         coalesce(median(views) FILTER (views <> 0), 0.0) AS median_present
  FROM grid GROUP BY pageid),
home_ranked AS (
  SELECT *, row_number() OVER (ORDER BY median_views DESC, total_views DESC, pageid) AS rank
  FROM home_metrics)"""
HOME = [CRAWLED, REDIRECTS, ROSTER, TITLE_VIEWS, HOME_GRID, HOME_RANKED]

SITE_LOOKUP = """language_links AS (
  SELECT site, title, max(item) AS item FROM sitelinks
  WHERE regexp_matches(site, '^[a-z][a-z0-9_]*wiki$') AND site <> 'commonswiki' GROUP BY 1, 2),
site_lookup AS (
  SELECT * FROM language_links
  UNION ALL
  SELECT 'enwiki', r.source_title, l.item FROM redirects r
  JOIN language_links l ON l.site = 'enwiki' AND l.title = r.target_title
  WHERE NOT EXISTS (SELECT 1 FROM language_links o WHERE o.site = 'enwiki' AND o.title = r.source_title)),
item_views AS (
  SELECT item, lang, month, sum(views)::BIGINT AS views
  FROM good_lines JOIN site_lookup l USING (title)
  WHERE l.site = CASE lang WHEN 'be-tarask' THEN 'be_x_oldwiki' WHEN 'gsw' THEN 'alswiki'
                           ELSE replace(lang, '-', '_') || 'wiki' END
    AND item IN (SELECT substr(qid, 2)::BIGINT FROM crawled WHERE qid IS NOT NULL)
  GROUP BY 1, 2, 3)"""
GLOBAL_RANKED = f"""item_grid AS (
  SELECT item, m.month, coalesce(sum(views), 0)::BIGINT AS views
  FROM (SELECT DISTINCT item FROM item_views) CROSS JOIN {_ZERO}
  LEFT JOIN item_views USING (item, month) GROUP BY 1, 2),
item_langs AS (SELECT item, lang, sum(views)::BIGINT AS views FROM item_views GROUP BY 1, 2),
top_langs AS (
  SELECT item, lang AS top_lang FROM item_langs
  QUALIFY row_number() OVER (PARTITION BY item ORDER BY views DESC, lang) = 1),
item_metrics AS (
  SELECT item, median(views) AS median_views, sum(views)::BIGINT AS total_views, max(views) AS max_views,
         count(*) FILTER (views > 0) AS n_months FROM item_grid GROUP BY item),
global_ranked AS (
  SELECT m.*, t.top_lang,
         (coalesce(e.views, 0) / greatest(m.total_views, 1))::FLOAT AS english_share,
         h.qid, h.pageid, h.title, h.rank AS enwiki_rank, h.median_views AS enwiki_median,
         row_number() OVER (ORDER BY m.median_views DESC, m.total_views DESC, m.item) AS rank
  FROM item_metrics m JOIN top_langs t USING (item)
  LEFT JOIN item_langs e ON e.item = m.item AND e.lang = 'en'
  JOIN home_ranked h ON h.qid = 'Q' || m.item)"""
GLOBAL = HOME + [EDITIONS, GOOD_LINES, SITELINKS, SITE_LOOKUP, GLOBAL_RANKED]


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select
