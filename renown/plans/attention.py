"""Dumps to rankings, for one edition and for all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from renown.operators import bloom, expect, ranking, redirects
from renown.session import stage
from renown.sources import dumps, tables


def checked_roster(crawled: DataFrame, redirect_map: DataFrame) -> DataFrame:
    """The roster without redirect pages; a repeated page or title would credit views twice, so it raises."""
    roster = redirects.drop_redirect_pages(crawled, redirect_map)
    expect.enforce(
        expect.report(
            expect.unique(roster, "pageid", "roster pages are unique"), expect.unique(roster, "title", "roster titles are unique")
        )
    )
    return roster


def rank_home(
    views: DataFrame, crawled: DataFrame, redirect_map: DataFrame, months: list[str], tie_break: tuple[str, ...] = ("pageid",)
) -> DataFrame:
    """Rank a crawled roster by one edition's views per (month, title).

    ``tie_break`` is the order that equal fame keeps; pass ("line_no", "pos") for a roster
    from ``crawl.roster_from_crawl``.
    """
    roster = checked_roster(crawled, redirect_map)
    lookup = redirects.home_lookup(roster, redirect_map)
    return ranking.home_ranking(views, lookup, roster, months, tie_break)


def top_home(
    views: DataFrame, crawled: DataFrame, redirect_map: DataFrame, months: list[str], k: int, tie_break: tuple[str, ...] = ("pageid",)
) -> DataFrame:
    """The first k of ``rank_home`` without ranking the rest."""
    roster = checked_roster(crawled, redirect_map)
    lookup = redirects.home_lookup(roster, redirect_map)
    return ranking.top_by_fame(ranking.home_metrics(views, lookup, roster, months), k, *tie_break)


def rank_stored(
    spark: SparkSession, root: str, crawled: DataFrame, redirect_map: DataFrame, months: list[str],
    tie_break: tuple[str, ...] = ("pageid",),
) -> DataFrame:
    """Rank on the months of the window that are stored; missing months don't count as months without views."""
    missing = set(tables.missing_months(spark, root, months))
    stored = [m for m in months if m not in missing]
    if not stored:
        raise ValueError(f"{root} holds no month of the window")
    return rank_home(tables.read_months(spark, root, stored), crawled, redirect_map, stored, tie_break)


def item_views(
    lines: DataFrame, crawled: DataFrame, sitelinks: DataFrame, redirect_map: DataFrame, summed: bool = True
) -> DataFrame:
    """(item, lang, month, views) of the roster from raw lines of all editions, a row per line unless ``summed``.

    A Bloom filter of the lookup drops most other titles in the scan. What is left meets the lookup in the one shuffle
    of titles and is summed by item behind it; adaptive execution cuts a title of very many lines into pieces there.
    """
    links = dumps.roster_sitelinks(sitelinks, crawled)
    lookup = stage(redirects.site_lookup(links, redirect_map), "site-lookup")
    wanted = bloom.key_filter(lookup, "site", "title")
    return ranking.item_language_views(dumps.all_site_views(lines, wanted=wanted, summed=False), lookup, summed)


def rank_global(
    item_language_views: DataFrame, home_ranked: DataFrame, months: list[str], k: int | None = None, summed: bool = True
) -> DataFrame:
    """Rank by the views of all editions together; with ``k`` the first k only. ``summed`` is that of ``item_views``."""
    metrics = ranking.global_metrics(item_language_views, months, summed=summed)
    return ranking.global_ranking(metrics, home_ranked, k)
