"""Monthly matrix, robust fame metrics and the rankings built on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown.operators.ordering import number_rows


def month_column(month: str) -> str:
    """``2025-07`` to ``views_202507``."""
    return "views_" + month.replace("-", "")


def monthly_matrix(views: DataFrame, months: list[str], keys: tuple[str, ...] = ("entity",)) -> DataFrame:
    """One row per key with one column per month; months without a row are 0.

    Conditional sums instead of a pivot: one shuffle, and a hot entity is
    pre-summed in every map task.
    """
    sums = [
        F.sum(F.when(F.col("month") == m, F.col("views")).otherwise(0)).alias(month_column(m))
        for m in months
    ]
    return views.where(F.col("month").isin(months)).groupBy(*keys).agg(*sums)


def middle(values: Column) -> Column:
    """Median of a short array without nulls: the middle value, or the mean of the middle two.

    Only array functions that take part in code generation are used here.
    """
    ordered = F.sort_array(values)
    n = F.size(ordered)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / F.lit(2.0)


def fame_metrics(matrix: DataFrame, months: list[str], present: bool = True) -> DataFrame:
    """Add median_views (zero months count), total, max, n_months and median_present."""
    columns = [F.col(month_column(m)) for m in months]
    row = F.array(*columns)
    metrics = {
        "median_views": middle(row),
        "total_views": reduce(Column.__add__, columns),
        "max_views": F.array_max(row),
        "n_months": reduce(Column.__add__, [(c > 0).cast("bigint") for c in columns]),
    }
    if present:
        metrics["median_present"] = F.coalesce(middle(F.array_remove(row, 0)), F.lit(0.0))
    return matrix.withColumns(metrics)


def rank_by_fame(metrics: DataFrame, *tie_break: str, name: str = "rank", running: dict[str, str] | None = None) -> DataFrame:
    """Rank 1..n by median, then total, then the input order given by ``tie_break``.

    ``running`` adds running totals down the ranking, see ``number_rows``.
    """
    order = [F.col("median_views").desc(), F.col("total_views").desc()]
    return number_rows(metrics, order + [F.col(c).asc() for c in tie_break], name, running=running)


def home_ranking(
    views: DataFrame, lookup: DataFrame, roster: DataFrame, months: list[str], tie_break: tuple[str, ...] = ("pageid",)
) -> DataFrame:
    """Rank the roster by one wiki's monthly views (month, title, views).

    Equal fame keeps the order of ``tie_break``, for a crawled roster its crawl order.

    Views are summed per title before the lookup join, so a hot title is one
    row per month there.
    """
    return rank_by_fame(home_metrics(views, lookup, roster, months), *tie_break)


def home_metrics(views: DataFrame, lookup: DataFrame, roster: DataFrame, months: list[str]) -> DataFrame:
    """The roster with its monthly views and metrics, unranked."""
    credited = views.join(lookup, "title").select("pageid", "month", "views")
    matrix = monthly_matrix(credited, months, ("pageid",))
    columns = [month_column(m) for m in months]
    filled = roster.join(matrix, "pageid", "left").na.fill(0, columns)
    return fame_metrics(filled, months)


def item_language_views(site_views: DataFrame, lookup: DataFrame, summed: bool = True) -> DataFrame:
    """(item, lang, month, views) from views by (site, title, month), summed or not.

    The lookup is unique and far smaller than the views, so each task hashes its share instead of sorting both.
    Unless ``summed``, there is a row per row of ``site_views``, for ``global_metrics`` to add up.
    """
    credited = site_views.join(lookup.hint("shuffle_hash"), ["site", "title"]).select("item", "lang", "month", "views")
    return credited.groupBy("item", "lang", "month").agg(F.sum("views").alias("views")) if summed else credited


def global_metrics(item_views: DataFrame, months: list[str], home: str = "en", summed: bool = True) -> DataFrame:
    """Metrics over all languages plus the leading language and the home share.

    ``item_views`` has one row per (item, lang, month), so an item is a few thousand rows at most and
    one shuffle on the item serves the sums per (item, lang) and those per item. Unless ``summed``, it has any
    number of them: they become one row of months per (item, lang) in every task before they are shuffled.
    Equal language totals go to the smaller code.
    """
    per_lang = monthly_matrix(item_views.repartition("item") if summed else item_views, months, ("item", "lang"))
    columns = [month_column(m) for m in months]
    total = reduce(Column.__add__, [F.col(c) for c in columns])
    per_item = (
        per_lang.withColumn("_total", total)
        .groupBy("item")
        .agg(
            *[F.sum(c).alias(c) for c in columns],
            F.min(F.struct((-F.col("_total")).alias("less"), F.col("lang").alias("lang")))["lang"].alias("top_lang"),
            F.sum(F.when(F.col("lang") == home, F.col("_total")).otherwise(0)).alias("_home"),
        )
    )
    metrics = fame_metrics(per_item, months, present=False)
    share = F.col("_home") / F.greatest(F.col("total_views"), F.lit(1))
    return metrics.withColumn("english_share", share.cast("float")).drop("_home")


def global_ranking(metrics: DataFrame, home_ranked: DataFrame, k: int | None = None) -> DataFrame:
    """Rank all items with views and carry the one-wiki rank along; with ``k`` the first k only."""
    home = home_ranked.where(F.col("qid").isNotNull()).select(
        "qid",
        "pageid",
        "title",
        F.col("rank").alias("enwiki_rank"),
        F.col("median_views").alias("enwiki_median"),
    )
    named = metrics.withColumn("qid", F.concat(F.lit("Q"), F.col("item").cast("string")))
    rows, ties = named.join(home, "qid"), ("item", "enwiki_rank")
    return rank_by_fame(rows, *ties) if k is None else top_by_fame(rows, k, *ties)


def top(ranked: DataFrame, k: int) -> DataFrame:
    """The first k ranks of a ranking that is at hand."""
    return ranked.where(F.col("rank") <= k)


def top_by_fame(metrics: DataFrame, k: int, *tie_break: str) -> DataFrame:
    """The first k ranks straight from the metrics: every task keeps k rows, nothing else is sorted."""
    order = [F.col("median_views").desc(), F.col("total_views").desc(), *[F.col(c).asc() for c in tie_break]]
    first = metrics.orderBy(*order).limit(k)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))  # k rows
