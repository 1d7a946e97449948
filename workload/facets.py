"""Registered queries on claims, texts and the map table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.functions import claims as C
from renown.functions import display as D
from renown.functions import texts as X
from renown.functions.titles import fuzzy_title_key
from renown.operators import expect, facets, regions
from renown.operators.hot_join import join_spread
from renown.session import stage
from workload import attention, roles
from workload.roles import with_

NEWEST = 2026


def _claim(rank: Column, **value: Column) -> Column:
    inner = F.struct(*[v.alias(k) for k, v in value.items()])
    snak = F.struct(F.struct(inner.alias("value")).alias("datavalue"))
    return F.struct(rank.alias("rank"), snak.alias("mainsnak"))


def claim_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document of claims per order; its key is the order's item id.

    Ranks come from the status and the priority, so that every mix of preferred,
    normal, deprecated and missing ranks occurs.
    """
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    null = F.lit(None).cast("string")
    by_status = F.when(status == "F", "normal").when(status == "O", "preferred").otherwise("deprecated")
    by_priority = (
        F.when(priority == "1-URGENT", "preferred")
        .when(priority == "5-LOW", "deprecated")
        .when(priority == "3-MEDIUM", null)
        .otherwise("normal")
    )
    year = F.lpad((F.floor(F.col("o_totalprice") / 1000) + 1700).cast("string"), 4, "0")
    sign = F.when(priority == "2-HIGH", "-").otherwise("+")
    time = F.concat(sign, year, F.lit("-01-01T00:00:00Z"))
    precision = F.when(status == "P", F.lit(7)).otherwise(F.lit(9))
    customer = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    nation = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    nowhere = F.when(priority == "4-NOT SPECIFIED", null).otherwise(F.concat(F.lit("X"), status))
    claims = F.struct(
        F.array(_claim(by_status, id=customer), _claim(by_priority, id=nowhere)).alias(C.OCCUPATION),
        F.array(_claim(by_priority, id=nation), _claim(by_status, id=nowhere)).alias(C.CITIZENSHIP),
        F.array(_claim(by_priority, id=F.concat(F.lit("G"), status))).alias(C.GENDER),
        F.array(
            _claim(by_status, time=time, precision=precision),
            _claim(by_priority, time=F.concat(F.lit("+1950"), F.lit("-00-00T00:00:00Z")), precision=F.lit(11)),
        ).alias(C.BIRTH),
    )
    customers = roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = roles.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return (
        roles.dealt(orders.join(customers, "o_custkey"), "o_orderkey")
        .select(F.concat(F.lit("Q"), F.col("o_orderkey").cast("string")).alias("qid"), F.to_json(claims).alias("claims"))
    )


def value_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of customers (their segment), nations and two of three genders; the rest has none."""
    customers = roles.table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lower("c_mktsegment"), F.lit("-seller "), F.col("c_nationkey").cast("string")).alias("label"),
    )
    nations = roles.table(spark, sf, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("label")
    )
    genders = roles.table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O")).select(
        F.concat(F.lit("G"), "o_orderstatus").alias("id"),
        F.when(F.col("o_orderstatus") == "F", "female").otherwise("male").alias("label"),
    ).distinct()
    return customers.unionByName(nations).unionByName(genders)


# the same claims in long form: one row per claim with its position
CLAIMS = """doc AS (
  SELECT o_orderkey, o_orderstatus AS st, o_orderpriority AS pr, o_custkey, c_nationkey,
         CASE o_orderstatus WHEN 'F' THEN 'normal' WHEN 'O' THEN 'preferred' ELSE 'deprecated' END AS rs,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'preferred' WHEN '5-LOW' THEN 'deprecated'
                              WHEN '3-MEDIUM' THEN NULL ELSE 'normal' END AS rp,
         CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'X' || o_orderstatus END AS nowhere,
         CASE WHEN o_orderpriority <> '2-HIGH' AND o_orderstatus <> 'P'
              THEN floor(o_totalprice / 1000)::INT + 1700 END AS stated
  FROM orders JOIN customer ON c_custkey = o_custkey),
claim AS (
  SELECT o_orderkey, 'P106' AS prop, 0 AS pos, rs AS rank, 'C' || o_custkey AS id, NULL AS year FROM doc
  UNION ALL SELECT o_orderkey, 'P106', 1, rp, nowhere, NULL FROM doc
  UNION ALL SELECT o_orderkey, 'P27', 0, rp, 'N' || c_nationkey, NULL FROM doc
  UNION ALL SELECT o_orderkey, 'P27', 1, rs, nowhere, NULL FROM doc
  UNION ALL SELECT o_orderkey, 'P21', 0, rp, 'G' || st, NULL FROM doc
  UNION ALL SELECT o_orderkey, 'P569', 0, rs, NULL, stated FROM doc
  UNION ALL SELECT o_orderkey, 'P569', 1, rp, NULL, 1950 FROM doc),
kept AS (
  SELECT *, count(*) FILTER (rank = 'preferred') OVER (PARTITION BY o_orderkey, prop) AS preferred
  FROM claim WHERE rank IS DISTINCT FROM 'deprecated'),
best AS (SELECT * FROM kept WHERE preferred = 0 OR rank = 'preferred'),
labels_ AS (
  SELECT 'C' || c_custkey AS id, lower(c_mktsegment) || '-seller ' || c_nationkey AS label FROM customer
  UNION ALL SELECT 'N' || n_nationkey, n_name FROM nation
  UNION ALL SELECT * FROM (VALUES ('GF', 'female'), ('GO', 'male')) t(id, label)),
record AS (
  SELECT o_orderkey,
         (SELECT arg_min(year, pos) FROM best b WHERE b.o_orderkey = d.o_orderkey AND prop = 'P569' AND year IS NOT NULL) AS birth_year
  FROM doc d),
record_ids AS (
  SELECT o_orderkey,
         coalesce(string_agg(id, '|' ORDER BY pos) FILTER (prop = 'P106'), '') AS occupations,
         coalesce(string_agg(id, '|' ORDER BY pos) FILTER (prop = 'P27'), '') AS citizenships,
         coalesce(string_agg(id, '|' ORDER BY pos) FILTER (prop = 'P21'), '') AS genders,
         coalesce(string_agg(coalesce(l.label, id), '|' ORDER BY pos) FILTER (prop = 'P106'), '') AS occupation_labels,
         coalesce(string_agg(coalesce(l.label, id), '|' ORDER BY pos) FILTER (prop = 'P27'), '') AS citizenship_labels,
         min(coalesce(l.label, id)) FILTER (prop = 'P21') AS gender
  FROM best LEFT JOIN labels_ l USING (id) GROUP BY 1)"""


def records(spark: SparkSession, sf: str) -> DataFrame:
    return facets.claim_records(claim_documents(spark, sf))


def claims_best(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).select(
        "qid",
        F.array_join("occupation_qids", "|").alias("occupations"),
        F.array_join("citizenship_qids", "|").alias("citizenships"),
        F.array_join("gender_qids", "|").alias("genders"),
    )


def birth_years(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).select(
        "qid", "birth_year", C.plausible_birth_year(F.col("birth_year"), NEWEST).alias("plausible")
    )


def value_ids(spark: SparkSession, sf: str) -> DataFrame:
    return facets.value_ids(records(spark, sf))


def parts_as_entities(spark: SparkSession, sf: str) -> DataFrame:
    return roles.crawled(spark, sf).select("pageid", "qid")


def facet_table(spark: SparkSession, sf: str) -> DataFrame:
    return facets.facet_rows(
        parts_as_entities(spark, sf), records(spark, sf), value_labels(spark, sf), NEWEST
    )


def facet_labels(spark: SparkSession, sf: str) -> DataFrame:
    return facet_table(spark, sf).select(
        "pageid", "qid", "birth_year", "gender",
        F.array_join("citizenships", "|").alias("citizenships"),
        F.array_join("occupations", "|").alias("occupations"),
    )


FACETS = f"""facet AS (
  SELECT pageid, qid, CASE WHEN birth_year BETWEEN 1900 AND {NEWEST} THEN birth_year END AS birth_year, gender,
         coalesce(citizenship_labels, '') AS citizenships, coalesce(occupation_labels, '') AS occupations
  FROM crawled LEFT JOIN record r ON 'Q' || r.o_orderkey = qid
  LEFT JOIN record_ids i ON 'Q' || i.o_orderkey = qid)"""


def text_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as entity texts; src0 has no description and src1 an empty one."""
    source = F.col("source")
    return roles.table(spark, sf, "documents").select(
        F.col("doc_id").alias("pageid"),
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
        F.when(source == "src0", F.lit(None)).when(source == "src1", F.lit(""))
        .otherwise(F.concat(F.lit("<b>"), "lang", F.lit("</b> & 'prose' from "), source)).alias("description"),
        F.col("text").alias("lead"),
        F.when(F.col("lang") != "de", F.concat(F.lit("https://img.example/"), F.col("doc_id").cast("string"))).alias("thumb_url"),
    )


TEXTS = """texts AS (
  SELECT doc_id AS pageid, 'Doc ' || doc_id AS title,
         CASE source WHEN 'src0' THEN NULL WHEN 'src1' THEN '' ELSE '<b>' || lang || '</b> & ''prose'' from ' || source END AS description,
         text AS lead, CASE WHEN lang <> 'de' THEN 'https://img.example/' || doc_id END AS thumb_url
  FROM documents)"""


def embed_text(spark: SparkSession, sf: str) -> DataFrame:
    text = X.embed_text(F.col("title"), F.col("description"), F.col("lead"))
    return text_columns(spark, sf).select("pageid", text.alias("text"))


def label_documents(spark: SparkSession, sf: str) -> DataFrame:
    text = X.label_document(F.col("title"), F.col("description"), F.col("lead"))
    return text_columns(spark, sf).select("pageid", text.alias("document"))


def fuzzy_titles(spark: SparkSession, sf: str) -> DataFrame:
    return roles.crawled(spark, sf).select("pageid", fuzzy_title_key(F.col("title")).alias("title_key"))


def display_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Escapes, labels and addresses of customers and their balances."""
    customer = roles.table(spark, sf, "customer")
    name = F.concat_ws(" ", F.lit('<a href="x">'), "c_name", F.lit("& it's ~ + * /"), "c_mktsegment")
    return customer.select(
        "c_custkey",
        D.escape_html(name).alias("escaped"),
        D.article_url(name).alias("url"),
        D.title_case(F.concat_ws("-", F.lower("c_mktsegment"), F.lit("song WRITER's 2nd"))).alias("cased"),
        D.views_label(F.abs("c_acctbal") * 25).alias("views"),
        D.views_label(F.floor(F.abs("c_acctbal")) / 2).alias("halves"),
        D.born_label(F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal"))).alias("born"),
    )


def text_table(spark: SparkSession, sf: str) -> DataFrame:
    """The home roster with texts: none of the columns that only the ranking of all editions has."""
    return facets.text_table(attention.home_ranked(spark, sf), text_columns(spark, sf))


def map_points(spark: SparkSession, sf: str, texts: DataFrame) -> DataFrame:
    """A place for each entity: size across, price upwards."""
    part = roles.table(spark, sf, "part")
    places = part.select(F.col("p_partkey").alias("pageid"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").cast("double").alias("y"))
    return places.join(texts.select("pageid"), "pageid", "left_semi")


def region_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Three label layers over the parts, coarsest first: brand, brand and type, name."""
    part = roles.table(spark, sf, "part")
    brand, kind = F.col("p_brand"), F.concat_ws(" ", "p_brand", "p_type")
    name = F.when(F.col("p_type") != "SMALL", F.concat_ws(" ", "p_brand", "p_type", "p_name"))
    layers = F.array(*[
        F.struct(F.lit(i).alias("layer"), c.alias("label")) for i, c in enumerate((brand, kind, name))
    ])
    return part.select(F.col("p_partkey").alias("pageid"), F.explode(layers).alias("l")).select(
        "pageid", "l.layer", "l.label"
    )


MAP_COLUMNS = [
    "pageid", "name", "description", "thumb_url", "rank", "views_str", "born_str", "lead_excerpt", "wiki_url",
    "occupation", "citizenship", "gender", "birth_year", "top_lang",
    "label_layer_0", "label_layer_1", "label_layer_2", "birth_low", "birth_high",
]
MAP_NUMBERS = ["fame", "volatility", "marker_size", "english_share", "x", "y"]


def map_features(spark: SparkSession, sf: str) -> DataFrame:
    labels = facets.wide_labels(region_labels(spark, sf), 3)
    texts = stage(facets.text_table(attention.global_ranked(spark, sf), text_columns(spark, sf)), "map-texts")
    features = facets.map_features(texts, facet_table(spark, sf), labels, map_points(spark, sf, texts))
    return features.select(*MAP_COLUMNS, *[F.round(c, 6).alias(c) for c in MAP_NUMBERS])


def hot_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of all order lines, where one supplier holds half the lines and more."""
    key = F.when(F.col("l_linenumber") % 2 == 1, 1).otherwise(F.col("l_suppkey"))
    lines = roles.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key.cast("bigint").alias("suppkey"))
    names = roles.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("bigint").alias("suppkey"), "s_name")
    return join_spread(lines, names, ["suppkey"], "left")


def top_n_other(spark: SparkSession, sf: str) -> DataFrame:
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_name")
    return facets.top_or_other(parts, "p_name", facets.TOP_CATEGORIES)


def legend_order(spark: SparkSession, sf: str) -> DataFrame:
    ordered = facets.legend(top_n_other(spark, sf), "p_name")
    return ordered.select("value", (F.col("value") == "Other").alias("is_other"))


def label_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Names and unlabelled share per layer."""
    labels = region_labels(spark, sf).withColumn("label", F.coalesce("label", F.lit(regions.UNLABELLED)))
    return regions.layer_summary(labels).withColumn("unlabelled", F.round("unlabelled", 6))


def layer_expectation(spark: SparkSession, sf: str) -> DataFrame:
    return expect.layers_refine(region_labels(spark, sf), "finer layers have more names")


QUERIES = {
    "claims_best": claims_best,
    "birth_years": birth_years,
    "value_ids": value_ids,
    "facet_labels": facet_labels,
    "embed_text": embed_text,
    "label_documents": label_documents,
    "fuzzy_titles": fuzzy_titles,
    "display_fields": display_fields,
    "text_table": text_table,
    "map_features": map_features,
    "hot_key_join": hot_key_join,
    "top_n_other": top_n_other,
    "legend_order": legend_order,
    "label_layers": label_layers,
    "layer_expectation": layer_expectation,
}


def _escape(c: str) -> str:
    for old, new in D.HTML_ENTITIES:
        c = f"replace({c}, '{old.replace(chr(39), chr(39) * 2)}', '{new}')"
    return c


def _cased(c: str) -> str:
    return f"""array_to_string(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'),
        lambda w: upper(w[1]) || lower(w[2:])), '')"""


def _views(c: str) -> str:
    return f"""CASE WHEN {c} >= 10000 THEN round_even({c} / 1000, 0)::BIGINT || 'k'
        ELSE format('{{:,}}', round_even({c}, 0)::BIGINT) END"""


def _top(field: str, n: int) -> str:
    return f"""{field}_top AS (
  SELECT {field} FROM base WHERE {field} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {field} LIMIT {n})"""


_NAME = """'<a href="x">' || ' ' || c_name || ' ' || '& it''s ~ + * /' || ' ' || c_mktsegment"""
_URL = f"""replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace({_NAME},
    ' ', '_'), '%', '%25'), '=', '%3D'), '<', '%3C'), '>', '%3E'), '"', '%22'), '&', '%26'), '''', '%27'), '#', '%23'), '+', '%2B'), '*', '%2A')"""
_STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"
_LEAD = _STRIP.format("coalesce(lead, '')")
_DESCRIPTION = _STRIP.format("coalesce(description, '')")
_BASE = f"""base AS (
  SELECT g.pageid, g.title, g.rank, g.median_views, g.max_views, coalesce(g.top_lang, 'Unknown') AS top_lang,
         coalesce(g.english_share::DOUBLE, 1.0) AS english_share, t.description, t.lead, t.thumb_url, f.birth_year,
         CASE WHEN f.occupations = '' THEN 'Unknown' ELSE {_cased("split_part(f.occupations, '|', 1)")} END AS occupation,
         CASE WHEN f.citizenships = '' THEN 'Unknown' ELSE split_part(f.citizenships, '|', 1) END AS citizenship,
         {_cased("coalesce(f.gender, 'Unknown')")} AS gender,
         log10(greatest(g.median_views, 1.0)) AS fame,
         log10(greatest(g.max_views / greatest(g.median_views, 1.0), 1.0)) AS volatility,
         p_size::DOUBLE AS x, p_retailprice::DOUBLE AS y, p_brand AS label_layer_0, p_brand || ' ' || p_type AS label_layer_1,
         CASE WHEN p_type <> 'SMALL' THEN p_brand || ' ' || p_type || ' ' || p_name ELSE 'Unlabelled' END AS label_layer_2
  FROM global_ranked g LEFT JOIN texts t ON t.pageid = g.pageid
  LEFT JOIN facet f ON f.pageid = g.pageid LEFT JOIN part ON p_partkey = g.pageid)"""

_PREFIX = D.ARTICLE_PREFIX
ORACLES = {
    "claims_best": with_(CLAIMS, select="""SELECT 'Q' || d.o_orderkey AS qid, coalesce(occupations, '') AS occupations,
        coalesce(citizenships, '') AS citizenships, coalesce(genders, '') AS genders
        FROM doc d LEFT JOIN record_ids USING (o_orderkey)"""),
    "birth_years": with_(CLAIMS, select=f"""SELECT 'Q' || o_orderkey AS qid, birth_year,
        CASE WHEN birth_year BETWEEN 1900 AND {NEWEST} THEN birth_year END AS plausible FROM record"""),
    "value_ids": with_(CLAIMS, select="SELECT DISTINCT id FROM best WHERE id IS NOT NULL"),
    "facet_labels": with_(roles.CRAWLED, CLAIMS, FACETS, select="SELECT * FROM facet"),
    "embed_text": with_(TEXTS, select=f"""SELECT pageid, CASE WHEN length({_LEAD}) >= 40 THEN {_LEAD}
        WHEN {_DESCRIPTION} <> '' THEN title || '. ' || {_DESCRIPTION} ELSE title END AS text FROM texts"""),
    "label_documents": with_(TEXTS, select="""SELECT pageid, substr(
        CASE WHEN coalesce(description, '') <> '' THEN title || ' -- ' || description ELSE title END
        || CASE WHEN coalesce(lead, '') <> '' THEN chr(10) || lead ELSE '' END, 1, 2000) AS document FROM texts"""),
    "fuzzy_titles": with_(roles.CRAWLED, select=r"""SELECT pageid,
        lower(trim(regexp_replace(replace(title, '_', ' '), '\s+', ' ', 'g'))) AS title_key FROM crawled"""),
    "display_fields": f"""SELECT c_custkey, {_escape(_NAME)} AS escaped, '{_PREFIX}' || {_URL} AS url,
        {_cased("lower(c_mktsegment) || '-' || 'song WRITER''s 2nd'")} AS cased,
        {_views("(abs(c_acctbal) * 25)")} AS views, {_views("(floor(abs(c_acctbal)) / 2)")} AS halves,
        CASE WHEN c_acctbal > 0 THEN 'b. ' || floor(c_acctbal)::BIGINT ELSE 'b. ?' END AS born FROM customer""",
    "map_features": with_(
        *roles.GLOBAL, CLAIMS, FACETS, TEXTS, _BASE,
        _top("occupation", 15), _top("citizenship", 15), _top("gender", 4), _top("top_lang", 12),
        select=f"""SELECT pageid, {_escape("title")} AS name, {_escape("coalesce(description, '')")} AS description,
        coalesce(thumb_url, '') AS thumb_url, rank::VARCHAR AS rank, {_views("median_views")} AS views_str,
        CASE WHEN birth_year IS NULL THEN 'b. ?' ELSE 'b. ' || birth_year END AS born_str,
        {_escape("substr(coalesce(lead, ''), 1, 480)")} AS lead_excerpt,
        '{_PREFIX}' || replace(replace(title, ' ', '_'), '"', '%22') AS wiki_url,
        CASE WHEN occupation IN (FROM occupation_top) THEN occupation ELSE 'Other' END AS occupation,
        CASE WHEN citizenship IN (FROM citizenship_top) THEN citizenship ELSE 'Other' END AS citizenship,
        CASE WHEN gender IN (FROM gender_top) THEN gender ELSE 'Other' END AS gender, birth_year,
        CASE WHEN top_lang IN (FROM top_lang_top) THEN top_lang ELSE 'Other' END AS top_lang,
        label_layer_0, label_layer_1, label_layer_2, round(fame, 6) AS fame, round(volatility, 6) AS volatility,
        round(2.5 + CASE WHEN hi > lo THEN (fame - lo) / (hi - lo) * 10 ELSE 0.0 END, 6) AS marker_size,
        round(english_share, 6) AS english_share, born_lo AS birth_low, born_hi AS birth_high, round(x, 6) AS x, round(y, 6) AS y
        FROM base, (SELECT min(fame) AS lo, max(fame) AS hi, (floor(quantile_cont(birth_year::DOUBLE, 0.01) / 10) * 10)::BIGINT AS born_lo,
                    (ceil(quantile_cont(birth_year::DOUBLE, 0.99) / 10) * 10)::BIGINT AS born_hi FROM base)"""),
    "text_table": with_(*roles.HOME, TEXTS, select="""SELECT pageid, h.title, qid, rank, median_views, total_views, max_views,
        description, lead, thumb_url FROM home_ranked h LEFT JOIN texts t USING (pageid)"""),
    "hot_key_join": """SELECT l_orderkey, l_linenumber, suppkey, s_name FROM (SELECT l_orderkey, l_linenumber,
        (CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE l_suppkey END)::BIGINT AS suppkey FROM lineitem)
        LEFT JOIN supplier ON s_suppkey = suppkey""",
    "top_n_other": """SELECT p_partkey, CASE WHEN p_name IN (
        SELECT p_name FROM part GROUP BY 1 ORDER BY count(*) DESC, p_name LIMIT 15) THEN p_name ELSE 'Other' END AS p_name
        FROM part""",
    "legend_order": """SELECT DISTINCT CASE WHEN t.p_name IS NULL THEN 'Other' ELSE part.p_name END AS value, t.p_name IS NULL AS is_other
        FROM part LEFT JOIN (SELECT p_name FROM part GROUP BY 1 ORDER BY count(*) DESC, p_name LIMIT 15) t USING (p_name)""",
    "label_layers": """SELECT layer, count(DISTINCT label) AS names, round(avg((label = 'Unlabelled')::INT), 6) AS unlabelled
        FROM (SELECT 0 AS layer, p_brand AS label FROM part UNION ALL SELECT 1, p_brand || ' ' || p_type FROM part
              UNION ALL SELECT 2, CASE WHEN p_type <> 'SMALL' THEN p_brand || ' ' || p_type || ' ' || p_name
                                       ELSE 'Unlabelled' END FROM part) GROUP BY 1""",
    "layer_expectation": """SELECT 'finer layers have more names' AS expectation,
        (count(DISTINCT CASE WHEN p_type <> 'SMALL' THEN p_brand || ' ' || p_type || ' ' || p_name END)
         < count(DISTINCT p_brand))::BIGINT AS violations FROM part""",
}
