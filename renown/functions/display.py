"""Display fields of the map."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from renown.functions.titles import swap, underscored

# HTML entities (the ampersand comes first), article address, excerpt length.
HTML_ENTITIES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]
ARTICLE_PREFIX = "https://en.wikipedia.org/wiki/"
EXCERPT_CHARS = 480


def escape_html(text: Column) -> Column:
    return reduce(lambda c, pair: swap(c, *pair), HTML_ENTITIES, text)


def article_url(title: Column) -> Column:
    """Percent-encoded article address; the slash and ``-_.~`` stay as they are."""
    encoded = F.url_encode(underscored(title))
    # url_encode follows the form rules; turn them into those of a path
    for form, path in [("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")]:
        encoded = swap(encoded, form, path)
    return F.concat(F.lit(ARTICLE_PREFIX), encoded)


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others."""
    runs = F.split(text, r"(?<!\p{L})(?=\p{L})")
    cased = F.transform(
        runs,
        lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30))),
    )
    return F.array_join(cased, "")


def excerpt(lead: Column) -> Column:
    """Start of the lead, escaped after the cut."""
    return escape_html(F.substring(F.coalesce(lead, F.lit("")), 1, EXCERPT_CHARS))


def views_label(views: Column) -> Column:
    """``12k`` from ten thousand on, else a grouped integer; halves round to even."""
    thousands = F.concat(F.bround(views / 1000).cast("bigint").cast("string"), F.lit("k"))
    return F.when(views >= 10_000, thousands).otherwise(F.format_number(F.bround(views), 0))


def born_label(year: Column) -> Column:
    return F.when(year.isNull(), F.lit("b. ?")).otherwise(
        F.concat(F.lit("b. "), year.cast("bigint").cast("string"))
    )
