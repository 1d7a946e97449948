"""Redirect maps and title resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.functions.titles import item_number, spaced, underscored
from renown.operators.hot_join import join_spread


def redirect_map(pages: DataFrame, redirects: DataFrame) -> DataFrame:
    """source_title to target_title inside the article namespace, unique on the source.

    Where a source has several targets the smallest one stays.
    """
    sources = pages.where((F.col("namespace") == 0) & F.col("is_redirect"))
    targets = redirects.where(F.col("namespace") == 0).select("page_id", "target")
    return (
        sources.select("page_id", F.col("title").alias("source_title"))
        .join(targets, "page_id")
        .where((F.col("source_title") != "") & (F.col("target") != ""))
        .where(F.col("source_title") != F.col("target"))
        .groupBy("source_title")
        .agg(F.min("target").alias("target_title"))
    )


def drop_redirect_pages(roster: DataFrame, redirects: DataFrame) -> DataFrame:
    """Roster rows that are articles; a title that redirects elsewhere isn't one."""
    sources = redirects.select(F.col("source_title").alias("_slug"))
    slugged = roster.withColumn("_slug", underscored(F.col("title")))
    return slugged.join(sources, "_slug", "left_anti").drop("_slug")


def resolve_titles(views: DataFrame, redirects: DataFrame) -> DataFrame:
    """Follow redirects one hop: views move to the target, all other titles keep theirs.

    Exact match, case kept. The result is in the spaced form.
    """
    hop = redirects.select(F.col("source_title").alias("title"), "target_title")
    return views.join(hop, "title", "left").withColumn(
        "title", spaced(F.coalesce("target_title", "title"))
    ).drop("target_title")


def home_lookup(roster: DataFrame, redirects: DataFrame) -> DataFrame:
    """Dump title to pageid: the roster's own titles and all sources that point at them.

    Probing the views once with this small table equals resolving every title and
    then keeping roster titles, as long as no roster title is itself a source
    (:func:`drop_redirect_pages`).
    """
    own = roster.select(underscored(F.col("title")).alias("title"), "pageid")
    target = own.select(F.col("title").alias("target_title"), "pageid")
    aliases = redirects.join(target, "target_title").select(
        F.col("source_title").alias("title"), "pageid"
    )
    return own.unionByName(aliases)


def site_lookup(sitelinks: DataFrame, redirects: DataFrame, home_site: str = "enwiki") -> DataFrame:
    """(site, title) to item: sitelinks, and home redirects to a known home title.

    A sitelink beats a redirect; targets of very many redirects are spread over tasks. Of repeated sitelinks the last one wins, by
    ``row_id`` where the table has one, else by item.
    """
    order = "row_id" if "row_id" in sitelinks.columns else "item"
    if "item" not in sitelinks.columns:
        sitelinks = sitelinks.withColumn("item", item_number(F.col("qid")))
    links = sitelinks.groupBy("site", "title").agg(F.max_by("item", order).alias("item"))
    home = links.where(F.col("site") == home_site).select(
        F.col("title").alias("target_title"), "item"
    )
    aliases = join_spread(redirects, home, ["target_title"]).select(
        F.lit(home_site).alias("site"), F.col("source_title").alias("title"), "item"
    )
    ranked = links.withColumn("_order", F.lit(0)).unionByName(
        aliases.withColumn("_order", F.lit(1))
    )
    return ranked.groupBy("site", "title").agg(F.min_by("item", F.struct("_order", "item")).alias("item"))
