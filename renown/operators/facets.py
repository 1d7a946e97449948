"""Facets from claims, and the feature table of the map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.functions import claims as C
from renown.functions import display as D
from renown.operators import expect
from renown.operators.hot_join import join_spread
from renown.operators.stats import decade_bounds, value_counts
from renown.session import stage

# Categories kept per field.
TOP_CATEGORIES, TOP_GENDERS, TOP_LANGUAGES = 15, 4, 12
ROSTER_COLUMNS = ["pageid", "title", "qid", "rank", "median_views", "total_views", "max_views"]
OPTIONAL_COLUMNS = ["enwiki_rank", "top_lang", "english_share"]
ID_FIELDS = ["occupation_qids", "citizenship_qids", "gender_qids"]


def claim_records(documents: DataFrame, key: str = "qid", claims: str = "claims") -> DataFrame:
    """Checkpoint form of raw claims: the stated birth year and ids per property.

    The generator makes each document be parsed once for all properties.
    """
    parsed = documents.select(key, F.explode(F.array(C.parse_claims(F.col(claims)))).alias("c"))
    return parsed.select(
        key,
        C.birth_year(F.col(f"c.{C.BIRTH}")).alias("birth_year"),
        C.item_ids(F.col(f"c.{C.OCCUPATION}")).alias("occupation_qids"),
        C.item_ids(F.col(f"c.{C.CITIZENSHIP}")).alias("citizenship_qids"),
        C.item_ids(F.col(f"c.{C.GENDER}")).alias("gender_qids"),
    )


def value_ids(records: DataFrame) -> DataFrame:
    """Distinct ids of all fields: the labels to look up."""
    return records.select(F.explode(F.concat(*ID_FIELDS)).alias("id")).distinct()


def resolve_ids(records: DataFrame, labels: DataFrame, key: str, fields: list[str] = ID_FIELDS) -> DataFrame:
    """Replace ids by labels, order kept; an id without a label stays.

    All fields go through one join; ids that most records share, such as genders, are spread over tasks.
    An entity's arrays come from its own record, so gathering them again is bounded by that record.
    """
    records = stage(records, "records")  # read twice, and records come from parsing
    tagged = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("ids")) for f in fields])
    ids = records.select(key, F.explode(tagged).alias("t")).select(key, "t.field", F.posexplode("t.ids").alias("pos", "id"))
    ids = join_spread(stage(ids, "ids"), labels.select("id", "label"), ["id"], "left").withColumn(
        "item", F.struct("pos", F.coalesce("label", "id").alias("label"))
    )
    gathered = [
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("field") == f, F.col("item")))), lambda i: i["label"]
        ).alias(f)
        for f in fields
    ]
    resolved = ids.groupBy(key).agg(*gathered)
    rest = [c for c in records.columns if c not in fields]
    empty = F.array().cast("array<string>")
    return records.select(rest).join(resolved, key, "left").select(
        *rest, *[F.coalesce(f, empty).alias(f) for f in fields]
    )


def facet_rows(entities: DataFrame, records: DataFrame, labels: DataFrame, newest: int | None = None) -> DataFrame:
    """One row per entity: plausible birth year, gender, citizenships, occupations.

    An entity without a record gets null scalars and empty arrays.
    """
    named = resolve_ids(records, labels, "qid")
    empty = F.array().cast("array<string>")
    joined = entities.select("pageid", "qid").join(named, "qid", "left")
    return joined.select(
        "pageid",
        "qid",
        C.plausible_birth_year(F.col("birth_year"), newest).alias("birth_year"),
        F.get("gender_qids", F.lit(0)).alias("gender"),
        F.coalesce("citizenship_qids", empty).alias("citizenships"),
        F.coalesce("occupation_qids", empty).alias("occupations"),
    )


def top_or_other(df: DataFrame, column: str, n: int, counted: DataFrame | None = None) -> DataFrame:
    """Keep the n most frequent values of a column and call the rest ``Other``.

    ``counted`` is the table that the frequencies come from, by default ``df``.
    """
    counts = value_counts(df if counted is None else counted, column, n)
    top = counts.select(F.col("value").alias(column), F.lit(True).alias("_top"))
    return (
        df.join(F.broadcast(top), column, "left")  # at most n rows
        .withColumn(column, F.when(F.col("_top"), F.col(column)).otherwise(F.lit("Other")))
        .drop("_top")
    )


def legend(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their place in a legend: sorted, ``Other`` last."""
    values = df.select(F.col(column).alias("value")).distinct()
    return values.orderBy(F.col("value") == "Other", "value")


def wide_labels(labels: DataFrame, layers: int, key: str = "pageid") -> DataFrame:
    """(key, layer, label) to one column per layer, layer 0 the coarsest; gaps become Unlabelled."""
    columns = [
        F.coalesce(F.max(F.when(F.col("layer") == i, F.col("label"))), F.lit("Unlabelled")).alias(f"label_layer_{i}")
        for i in range(layers)
    ]
    return labels.groupBy(key).agg(*columns)


def text_table(ranked: DataFrame, texts: DataFrame, n: int | None = None) -> DataFrame:
    """The ranked entities with their texts, or the first ``n``; what only some rosters carry comes along where it exists."""
    kept = ranked if n is None else ranked.where(F.col("rank") <= n)
    columns = ROSTER_COLUMNS + [c for c in OPTIONAL_COLUMNS if c in ranked.columns]
    return kept.select(columns).join(texts.select("pageid", "description", "lead", "thumb_url"), "pageid", "left")


def _check_map(base: DataFrame, points: DataFrame | None, layers: list[str]) -> None:
    """No join may repeat or lose an entity, each has one point, and the finest layer has no fewer names than the coarsest."""
    checks = [expect.unique(base, "pageid", "every entity is on the map once")]
    if points is not None:
        checks.append(expect.same_keys(base, points.where("x is not null and y is not null"), "pageid", "every entity has a point"))
    if layers:
        tagged = [base.select(F.lit(i).alias("layer"), F.col(c).alias("label")) for i, c in enumerate((layers[0], layers[-1]))]
        checks.append(expect.layers_refine(tagged[0].unionByName(tagged[1]), "finer layers have more names"))
    expect.enforce(expect.report(*checks))


def map_features(
    texts: DataFrame, facets: DataFrame, labels: DataFrame | None = None, points: DataFrame | None = None
) -> DataFrame:
    """The map's feature table: place, display fields, sizes and colour fields per entity.

    ``texts`` is a ``text_table``; ``points`` carries pageid, x and y. ``birth_low`` and ``birth_high`` bound
    the colours of birth years (null if none is known); years beyond them stay as they are. The joined rows are
    written once, because category counts, ranges and checks need passes of their own. A repeated entity, one
    without a point, a point without an entity, and layers in the wrong order raise.
    """
    texts = texts.withColumn("lead_excerpt", D.excerpt(F.col("lead"))).drop("lead")  # before it is written
    joined = texts.join(facets.drop("qid"), "pageid", "left")
    if points is not None:
        joined = joined.join(points.select("pageid", "x", "y"), "pageid", "left")
    layers: list[str] = []
    if labels is not None:
        joined = joined.join(labels, "pageid", "left")
        layers = [c for c in labels.columns if c != "pageid"]
        joined = joined.na.fill("Unlabelled", layers)
    unknown = F.lit("Unknown")
    joined = joined.withColumns(
        {
            "occupation": F.coalesce(D.title_case(F.get("occupations", F.lit(0))), unknown),
            "citizenship": C.first_or(F.col("citizenships"), unknown),
            "gender": D.title_case(F.coalesce("gender", unknown)),
            "fame": F.log10(F.greatest(F.col("median_views"), F.lit(1.0))),
            "volatility": F.log10(
                F.greatest(F.col("max_views") / F.greatest(F.col("median_views"), F.lit(1.0)), F.lit(1.0))
            ),
        }
    )
    if "top_lang" in joined.columns:
        joined = joined.withColumn("top_lang", F.coalesce("top_lang", unknown))
    if "english_share" in joined.columns:
        joined = joined.withColumn("english_share", F.coalesce(F.col("english_share").cast("double"), F.lit(1.0)))
    base = stage(joined, "map")
    _check_map(base, points, sorted(layers, key=lambda c: int(c.rsplit("_", 1)[1])))
    born = decade_bounds(base, "birth_year").select(F.struct("low", "high").alias("ends")).scalar()
    span = base.agg(F.struct(F.min("fame").alias("lo"), F.max("fame").alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    scaled = F.when(hi > lo, (F.col("fame") - lo) / (hi - lo) * 10).otherwise(0.0)
    out = base.withColumns(
        {
            "name": D.escape_html(F.col("title")),
            "description": D.escape_html(F.coalesce("description", F.lit(""))),
            "thumb_url": F.coalesce("thumb_url", F.lit("")),
            "rank": F.col("rank").cast("string"),
            "views_str": D.views_label(F.col("median_views")),
            "born_str": D.born_label(F.col("birth_year")),
            "birth_low": born["low"],
            "birth_high": born["high"],
            "wiki_url": D.article_url(F.col("title")),
            "marker_size": scaled + 2.5,
        }
    )
    # counts come from the staged rows, not from the running result
    categories = {"occupation": TOP_CATEGORIES, "citizenship": TOP_CATEGORIES, "gender": TOP_GENDERS}
    if "top_lang" in base.columns:
        categories["top_lang"] = TOP_LANGUAGES
    for column, n in categories.items():
        out = top_or_other(out, column, n, base)
    return out
