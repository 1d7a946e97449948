"""Title and site expressions of the view dumps and SQL dumps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dump codes whose site id doesn't follow the general rule.
LEGACY_SITES = {
    "be-tarask": "be_x_oldwiki",
    "gsw": "alswiki",
    "lzh": "zh_classicalwiki",
    "nan": "zh_min_nanwiki",
}
# Sites that end in "wiki" without being a language edition.
NON_LANGUAGE_SITES = [
    "commonswiki",
    "specieswiki",
    "wikidatawiki",
    "metawiki",
    "mediawikiwiki",
    "sourceswiki",
    "foundationwiki",
    "outreachwiki",
    "incubatorwiki",
    "wikifunctionswiki",
    "wikimaniawiki",
    "loginwiki",
    "votewiki",
    "testwiki",
    "test2wiki",
    "testwikidatawiki",
]
# Fixed value: form of a language edition's site id.
LANGUAGE_SITE = "^[a-z][a-z0-9_]*wiki$"

# Unicode white space plus the four ASCII separators that str.split() also takes.
BLANK = r"(?U)[\s\x1c-\x1f]+"
BLANK_CHARACTERS = "".join(
    chr(c)
    for start, end in [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                       (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
    for c in range(start, end + 1)
)


def swap(column: Column, old: str, new: str) -> Column:
    """Literal (not regex) replacement."""
    return F.replace(column, F.lit(old), F.lit(new))


def underscored(title: Column) -> Column:
    return swap(title, " ", "_")


def spaced(title: Column) -> Column:
    return swap(title, "_", " ")


def strip_blanks(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def unquote_dump_title(raw: Column) -> Column:
    """Undo the quoting of titles with double quotes; other titles pass unchanged."""
    quoted = (F.char_length(raw) >= 2) & raw.startswith('"') & raw.endswith('"')
    inner = F.substring(raw, F.lit(2), F.char_length(raw) - 2)
    # the order matters: quotes first, then backslashes
    plain = swap(swap(inner, '\\"', '"'), "\\\\", "\\")
    return F.when(quoted, plain).otherwise(raw)


def quote_dump_title(title: Column) -> Column:
    """Inverse of :func:`unquote_dump_title`, used to derive dump lines."""
    inner = swap(swap(title, "\\", "\\\\"), '"', '\\"')
    return F.when(title.contains('"'), F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(title)


def fuzzy_title_key(title: Column) -> Column:
    """Case-folded key for diagnostics. Never a join key: titles may differ by case alone."""
    return F.lower(F.regexp_replace(strip_blanks(spaced(title)), BLANK, " "))


def unescape_sql(text: Column) -> Column:
    """``\\x`` becomes ``x`` for any x but a newline."""
    return F.regexp_replace(text, r"(?d)\\(.)", "$1")


def escape_sql(text: Column) -> Column:
    """Inverse of :func:`unescape_sql`, used to derive dump lines."""
    return swap(swap(text, "\\", "\\\\"), "'", "\\'")


def repair_utf8(text: Column) -> Column:
    """Replace invalid byte sequences by U+FFFD."""
    return F.make_valid_utf8(text)


def site_of_wiki(code: Column) -> Column:
    """Dump wiki code to site id."""
    legacy = F.create_map(*[F.lit(x) for pair in LEGACY_SITES.items() for x in pair])
    regular = F.concat(swap(code, "-", "_"), F.lit("wiki"))
    return F.coalesce(F.try_element_at(legacy, code), regular)


def is_language_site(site: Column) -> Column:
    return site.rlike(LANGUAGE_SITE) & ~site.isin(NON_LANGUAGE_SITES)


def item_number(qid: Column) -> Column:
    """``Q123`` to 123."""
    return F.substr(qid, F.lit(2)).try_cast("bigint")
