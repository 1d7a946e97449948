"""Registered queries on cut-offs, roster comparison and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.operators import cutoffs, expect, ranking, rosters, stats
from renown.session import stage
from renown.sources import crawl, tables
from workload import attention, roles
from workload.roles import MONTHS, with_

# the top of the roster comparison, smaller than the smallest table
TOP_N = 100
CANDIDATES = [10, 25, 50, 100]
STARTS = [1, 10, 50, 100, 120]
QUANTILES = [0.1, 0.25, 0.5, 0.75, 0.9]


def patrons(spark: SparkSession, sf: str, running: dict[str, str] | None = None) -> DataFrame:
    customers = roles.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_name").alias("title")
    )
    matrix = ranking.monthly_matrix(roles.patron_views(spark, sf), MONTHS)
    columns = [ranking.month_column(m) for m in MONTHS]
    filled = customers.join(matrix, "entity", "left").na.fill(0, columns)
    return ranking.rank_by_fame(ranking.fame_metrics(filled, MONTHS), "entity", running=running)


def rank_patrons(spark: SparkSession, sf: str) -> DataFrame:
    return patrons(spark, sf).select(
        "rank", "entity", "title", "median_views", "total_views", "max_views", "n_months"
    )


def cumulative_share(spark: SparkSession, sf: str) -> DataFrame:
    return cutoffs.cumulative_share(patrons(spark, sf, {"_running": "total_views"})).select(
        "rank", "entity", F.round("share", 6).alias("share")
    )


def candidate_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    return cutoffs.candidate_cutoffs(patrons(spark, sf, {"_running": "total_views"}), CANDIDATES).withColumn("share", F.round("share", 6))


def rank_samples(spark: SparkSession, sf: str) -> DataFrame:
    return cutoffs.rank_samples(patrons(spark, sf), STARTS).select(
        "start", "rank", "title", "median_views", "n_months"
    )


def rank_curve(spark: SparkSession, sf: str) -> DataFrame:
    return cutoffs.rank_curve(patrons(spark, sf)).select("rank", F.greatest("median_views", F.lit(1.0)).alias("views"))


def fame_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return cutoffs.fame_histogram(patrons(spark, sf)).select(
        "bin", "entities", F.round("x_min", 6).alias("x_min"), F.round("x_max", 6).alias("x_max")
    )


def zero_median(spark: SparkSession, sf: str) -> DataFrame:
    return cutoffs.zero_median(patrons(spark, sf))


def both_rankings(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    home = attention.home_ranked(spark, sf)
    world = attention.attention.rank_global(attention.item_views(spark, sf, summed=False), home, MONTHS, summed=False)
    return home, world


def roster_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return rosters.overlap(*both_rankings(spark, sf), TOP_N).withColumn("share", F.round("share", 6))


def roster_newcomers(spark: SparkSession, sf: str) -> DataFrame:
    return rosters.newcomers(*both_rankings(spark, sf), TOP_N).select("rank", "qid", "title", "enwiki_rank", "top_lang")


def roster_leavers(spark: SparkSession, sf: str) -> DataFrame:
    return rosters.leavers(*both_rankings(spark, sf), TOP_N).select("home_rank", "rank", "qid", "title", "top_lang")


def language_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.value_counts(attention.global_ranked(spark, sf), "top_lang", 20)


def describe_share(spark: SparkSession, sf: str) -> DataFrame:
    described = stats.describe(stage(attention.global_ranked(spark, sf), "world"), "english_share", QUANTILES)
    return described.withColumn("value", F.round("value", 6))


def top_world(spark: SparkSession, sf: str) -> DataFrame:
    home = attention.home_ranked(spark, sf)
    return attention.attention.rank_global(attention.item_views(spark, sf, summed=False), home, MONTHS, TOP_N, summed=False)


def top_language_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Leading languages of the first hundred."""
    return stats.value_counts(top_world(spark, sf), "top_lang", 20)


def top_describe_share(spark: SparkSession, sf: str) -> DataFrame:
    """Home shares of the first hundred."""
    described = stats.describe(stage(top_world(spark, sf), "top-world"), "english_share", QUANTILES)
    return described.withColumn("value", F.round("value", 6))


def document_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.value_counts(roles.table(spark, sf, "documents"), "source", 15)


def length_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return stats.decade_bounds(roles.table(spark, sf, "documents"), "n_chars")


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return stats.class_balance(roles.table(spark, sf, "events"), "event_type").select(
        F.round("chance", 6).alias("chance")
    )


def text_coverage(spark: SparkSession, sf: str) -> DataFrame:
    lead = F.col("text")
    return stats.coverage(
        roles.table(spark, sf, "documents"),
        {
            "lead_missing": lead.isNull(),
            "lead_short": F.char_length(F.coalesce(lead, F.lit(""))) < 40,
            "language_known": F.col("lang").isNotNull(),
        },
    ).withColumn("share", F.round("share", 6))


def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distinct_counts(roles.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag"])


def roster_expectations(spark: SparkSession, sf: str) -> DataFrame:
    crawled, redirects = roles.crawled(spark, sf), roles.redirects(spark, sf)
    roster = attention.stale_roster(spark, sf)
    part = roles.table(spark, sf, "part")
    return expect.report(
        expect.unique(roster, "title", "roster titles are unique"),
        expect.unique(part, "p_name", "part names are unique"),
        expect.unique(redirects, "source_title", "redirect sources are unique"),
        expect.same_keys(crawled, roster, "pageid", "no page is stale"),
        expect.same_count(crawled, part, "one page per part"),
    )


def key_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return tables.fingerprint(roles.table(spark, sf, "documents"), "doc_id", model="hashing", variant="lead")


def crawl_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl batches of 50 web pages; each batch repeats the first page of the next one."""
    page = roles.table(spark, sf, "pages").select("page_id", F.col("url").alias("title"))
    batch = F.explode(F.array_distinct(F.array(F.floor(F.col("page_id") / 50), F.floor((F.col("page_id") - 1) / 50))))
    entry = F.struct(
        F.when(F.floor(F.col("page_id") / 50) == F.col("batch"), F.col("title"))
        .otherwise(F.concat("title", F.lit(" (again)"))).alias("title"),
        F.col("page_id").alias("pageid"),
        F.concat(F.lit("Q"), F.col("page_id").cast("string")).alias("qid"),
    )
    grouped = (
        page.withColumn("batch", batch).where(F.col("batch") >= 0)
        .groupBy("batch")
        # a batch holds at most 51 pages
        .agg(F.array_sort(F.collect_list(F.struct("page_id", entry.alias("entry")))).alias("items"))
    )
    record = F.struct(F.transform("items", lambda i: i["entry"]).alias("pages"))
    return grouped.select(F.to_json(record).alias("value"), F.col("batch").alias("line_no"))


def roster_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.roster_from_crawl(crawl_lines(spark, sf)).drop("line_no", "pos")


def text_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """A checkpoint with one record per conversation turn; the key is the conversation."""
    turns = roles.table(spark, sf, "conversations")
    record = F.struct(
        F.col("conv_id").alias("pageid"), F.col("text").alias("extract"), F.col("role").alias("description")
    )
    return turns.select(F.to_json(record).alias("value"), F.col("turn").alias("line_no"))


def latest_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.latest_records(text_checkpoint(spark, sf), crawl.TEXT_RECORD, "pageid")


def todo_keys(spark: SparkSession, sf: str) -> DataFrame:
    wanted = roles.table(spark, sf, "documents").select(F.col("doc_id").alias("pageid"))
    done = crawl.latest_records(text_checkpoint(spark, sf), crawl.TEXT_RECORD, "pageid")
    return crawl.pending_keys(wanted, done, "pageid")


QUERIES = {
    "rank_patrons": rank_patrons,
    "cumulative_share": cumulative_share,
    "candidate_cutoffs": candidate_cutoffs,
    "rank_samples": rank_samples,
    "rank_curve": rank_curve,
    "fame_histogram": fame_histogram,
    "zero_median": zero_median,
    "roster_overlap": roster_overlap,
    "roster_newcomers": roster_newcomers,
    "roster_leavers": roster_leavers,
    "language_counts": language_counts,
    "describe_share": describe_share,
    "top_language_counts": top_language_counts,
    "top_describe_share": top_describe_share,
    "document_counts": document_counts,
    "length_bounds": length_bounds,
    "class_balance": class_balance,
    "text_coverage": text_coverage,
    "distinct_values": distinct_values,
    "roster_expectations": roster_expectations,
    "key_fingerprint": key_fingerprint,
    "roster_dedup": roster_dedup,
    "latest_checkpoint": latest_checkpoint,
    "todo_keys": todo_keys,
}


def _patrons(select: str) -> str:
    return with_(roles.PATRONS, select=select)


def _world(select: str) -> str:
    return with_(*roles.GLOBAL, select=select)


_Q = " UNION ALL ".join(
    f"SELECT '{int(p * 100)}%' AS statistic, quantile_cont(s, {p}) AS value FROM shares" for p in QUANTILES
)
_SHARED = f"""shared AS (
  SELECT qid FROM home_ranked WHERE rank <= {TOP_N} INTERSECT
  SELECT qid FROM global_ranked WHERE rank <= {TOP_N})"""

ORACLES = {
    "rank_patrons": _patrons("SELECT rank, entity, title, median_views, total_views, max_views, n_months FROM patrons"),
    "cumulative_share": _patrons("""SELECT rank, entity,
        round(sum(total_views) OVER (ORDER BY rank) / (SELECT sum(total_views) FROM patrons), 6) AS share FROM patrons"""),
    "candidate_cutoffs": _patrons(f"""SELECT rank AS n, median_views AS floor_views, share FROM (
        SELECT rank, median_views,
          round(sum(total_views) OVER (ORDER BY rank) / (SELECT sum(total_views) FROM patrons), 6) AS share
        FROM patrons) WHERE rank IN ({", ".join(map(str, CANDIDATES))})"""),
    "rank_samples": _patrons(f"""SELECT start, rank, title, median_views, n_months
        FROM patrons JOIN (SELECT unnest({STARTS})::BIGINT AS start) ON rank >= start AND rank < start + 8"""),
    "rank_curve": _patrons("""SELECT rank, greatest(median_views, 1.0) AS views FROM patrons WHERE rank IN (
        SELECT CASE WHEN i = 1999 THEN n ELSE floor(pow(n, i / 1999.0))::BIGINT END
        FROM range(2000) t(i), (SELECT count(*) AS n FROM patrons))"""),
    "fame_histogram": _patrons("""SELECT CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * 80), 79) ELSE 0 END::INT AS bin,
        count(*) AS entities, round(min(x), 6) AS x_min, round(max(x), 6) AS x_max
        FROM (SELECT log10(greatest(median_views, 0.5)) AS x FROM patrons),
             (SELECT min(log10(greatest(median_views, 0.5))) AS lo, max(log10(greatest(median_views, 0.5))) AS hi FROM patrons)
        GROUP BY 1"""),
    "zero_median": _patrons("""SELECT count(*) AS entities, count(*) FILTER (median_views = 0) AS median_zero,
        count(*) FILTER (total_views = 0) AS never_seen FROM patrons"""),
    "roster_overlap": with_(*roles.GLOBAL, _SHARED, select=f"""SELECT count(*) AS shared,
        round(count(*) / {float(TOP_N)}, 6) AS share, {TOP_N} - count(*) AS newcomers FROM shared"""),
    "roster_newcomers": _world(f"""SELECT rank, qid, title, enwiki_rank, top_lang FROM global_ranked g
        WHERE rank <= {TOP_N}
          AND NOT EXISTS (SELECT 1 FROM home_ranked h WHERE h.rank <= {TOP_N} AND h.qid = g.qid)
        ORDER BY rank LIMIT 25"""),
    "roster_leavers": _world(f"""SELECT h.rank AS home_rank, g.rank, g.qid, g.title, g.top_lang
        FROM global_ranked g JOIN home_ranked h ON h.qid = g.qid
        WHERE h.rank <= {TOP_N} AND g.rank > {TOP_N} ORDER BY h.rank, g.rank LIMIT 25"""),
    "language_counts": _world("""SELECT top_lang AS value, count(*) AS n FROM global_ranked
        GROUP BY 1 ORDER BY n DESC, value LIMIT 20"""),
    "describe_share": with_(*roles.GLOBAL,
        "shares AS (SELECT english_share::DOUBLE AS s FROM global_ranked)",
        select=f"""SELECT statistic, round(value, 6) AS value FROM (
        SELECT 'count' AS statistic, count(s)::DOUBLE AS value FROM shares
        UNION ALL SELECT 'mean', avg(s) FROM shares UNION ALL SELECT 'std', stddev_samp(s) FROM shares
        UNION ALL SELECT 'min', min(s) FROM shares UNION ALL SELECT 'max', max(s) FROM shares
        UNION ALL {_Q})"""),
    "top_describe_share": with_(*roles.GLOBAL,
        f"shares AS (SELECT english_share::DOUBLE AS s FROM global_ranked WHERE rank <= {TOP_N})",
        select=f"""SELECT statistic, round(value, 6) AS value FROM (
        SELECT 'count' AS statistic, count(s)::DOUBLE AS value FROM shares
        UNION ALL SELECT 'mean', avg(s) FROM shares UNION ALL SELECT 'std', stddev_samp(s) FROM shares
        UNION ALL SELECT 'min', min(s) FROM shares UNION ALL SELECT 'max', max(s) FROM shares
        UNION ALL {_Q})"""),
    "top_language_counts": _world(f"""SELECT top_lang AS value, count(*) AS n FROM global_ranked WHERE rank <= {TOP_N}
        GROUP BY 1 ORDER BY n DESC, value LIMIT 20"""),
    "document_counts": """SELECT source AS value, count(*) AS n FROM documents
        GROUP BY 1 ORDER BY n DESC, value LIMIT 15""",
    "length_bounds": """SELECT (floor(quantile_cont(n_chars::DOUBLE, 0.01) / 10) * 10)::BIGINT AS low,
        (ceil(quantile_cont(n_chars::DOUBLE, 0.99) / 10) * 10)::BIGINT AS high FROM documents""",
    "class_balance": """SELECT round(sum(n * n) / (sum(n) * sum(n))::DOUBLE, 6) AS chance
        FROM (SELECT count(*)::DOUBLE AS n FROM events GROUP BY event_type)""",
    "text_coverage": """SELECT part, count(*) AS rows, count(*) FILTER (hit) AS hits,
        round(count(*) FILTER (hit) / count(*), 6) AS share
        FROM (SELECT unnest(['lead_missing', 'lead_short', 'language_known']) AS part,
                     unnest([text IS NULL, length(coalesce(text, '')) < 40, lang IS NOT NULL]) AS hit
              FROM documents) GROUP BY part""",
    "distinct_values": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"values\" FROM lineitem"
        for c in ("l_partkey", "l_suppkey", "l_returnflag")
    ),
    "roster_expectations": with_(roles.CRAWLED, roles.REDIRECTS, roles.ROSTER, select="""
        SELECT 'roster titles are unique' AS expectation, count(*) AS violations
          FROM (SELECT title FROM roster GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'part names are unique', count(*)
          FROM (SELECT p_name FROM part GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'redirect sources are unique', count(*)
          FROM (SELECT source_title FROM redirects GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'no page is stale', (SELECT count(*) FROM crawled) - (SELECT count(*) FROM roster)
        UNION ALL SELECT 'one page per part', (SELECT count(*) FROM crawled) - (SELECT count(*) FROM part)"""),
    "key_fingerprint": """SELECT count(doc_id) AS keys, min(doc_id) AS first_key, max(doc_id) AS last_key,
        bit_xor(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT) AS key_hash,
        'hashing' AS model, 'lead' AS variant FROM documents""",
    "roster_dedup": """SELECT page_id AS pageid,
        CASE WHEN page_id > 0 AND page_id // 50 <> (page_id - 1) // 50 THEN url || ' (again)' ELSE url END AS title,
        'Q' || page_id AS qid FROM pages""",
    "latest_checkpoint": """SELECT conv_id AS pageid, text AS extract, role AS description, NULL::VARCHAR AS thumb_url
        FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "todo_keys": "SELECT doc_id AS pageid FROM documents WHERE doc_id NOT IN (SELECT conv_id FROM conversations)",
}
