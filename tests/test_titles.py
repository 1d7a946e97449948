import pytest
from pyspark.sql import functions as F

from renown.functions import titles as T


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "raw, title",
    [
        ("River_delta", "River_delta"),
        (r'"The_\"Blue\"_Hour"', 'The_"Blue"_Hour'),
        (r'"left\\right"', r"left\right"),
        ('"', '"'),
        ('""', ""),
        ('"never_closed', '"never_closed'),
        (r'"slash\\\"quote"', r'slash\"quote'),
    ],
)
def test_unquote(spark, raw, title):
    assert apply(spark, T.unquote_dump_title, [raw]) == [title]


def test_unquote_replaces_quotes_before_backslashes(spark):
    # \\" : the quote rule sees \" first, the backslash rule then finds nothing to halve
    raw = '"' + '\\\\"' + '"'
    inner = raw[1:-1].replace('\\"', '"').replace("\\\\", "\\")
    assert apply(spark, T.unquote_dump_title, [raw]) == [inner]


def test_quote_round_trip(spark):
    values = ["plain", 'The_"Blue"_Hour', 'in"side', '"']
    assert apply(spark, lambda c: T.unquote_dump_title(T.quote_dump_title(c)), values) == values


def test_fuzzy_key(spark):
    values = ["River_Delta", "River Delta", "RIVER  delta ", " river _DELTA" + chr(28)]
    assert apply(spark, T.fuzzy_title_key, values) == ["river delta"] * 4
    spaced, joined = apply(spark, T.fuzzy_title_key, ['The "Blue" Hour', 'The_"Blue"_Hour'])
    assert spaced == joined


def test_unescape_sql(spark):
    escaped = [r"Land\'s_End", r"x\"y\\z", r"\n", "\\\r", "\\ "]
    assert apply(spark, T.unescape_sql, escaped) == ["Land's_End", r'x"y\z', "n", "\r", " "]
    values = ["Land's_End", r"for\ward", r"bo\'th"]
    assert apply(spark, lambda c: T.unescape_sql(T.escape_sql(c)), values) == values


def test_sites(spark):
    codes = ["be-tarask", "gsw", "lzh", "nan", "zh-yue", "en", "de"]
    assert apply(spark, T.site_of_wiki, codes) == [
        "be_x_oldwiki", "alswiki", "zh_classicalwiki", "zh_min_nanwiki", "zh_yuewiki", "enwiki", "dewiki",
    ]
    sites = ["commonswiki", "enwiki", "enwikiquote", "test2wiki", "zh_min_nanwiki", "9wiki", "Xwiki"]
    assert apply(spark, T.is_language_site, sites) == [False, True, False, False, True, False, False]


def test_item_number(spark):
    assert apply(spark, T.item_number, ["Q811", None, "x"]) == [811, None, None]


def test_repair_utf8(spark):
    raw = [b"ok", b"bad\xff!", b"cut\xe2\x82", "é".encode()]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raw)], "i int, b binary")
    got = [r[0] for r in df.orderBy("i").select(T.repair_utf8(F.col("b").cast("string"))).collect()]
    assert got == [b.decode("utf-8", errors="replace") for b in raw]
