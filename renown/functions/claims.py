"""Statements of a knowledge-graph entity, as arrays inside one JSON document.

A document holds one entity, so every expression here works inside a row and
never gathers rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Earliest accepted birth year, least precision that states a year,
# properties of occupation, citizenship, gender and birth.
BIRTH_YEAR_MIN = 1900
YEAR_PRECISION = 9
OCCUPATION, CITIZENSHIP, GENDER, BIRTH = "P106", "P27", "P21", "P569"

CLAIM = T.StructType(
    [
        T.StructField("rank", T.StringType()),
        T.StructField(
            "mainsnak",
            T.StructType(
                [
                    T.StructField(
                        "datavalue",
                        T.StructType(
                            [
                                T.StructField(
                                    "value",
                                    T.StructType(
                                        [
                                            T.StructField("id", T.StringType()),
                                            T.StructField("time", T.StringType()),
                                            T.StructField("precision", T.IntegerType()),
                                        ]
                                    ),
                                )
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)
CLAIMS = T.ArrayType(CLAIM)
PROPERTIES = T.StructType(
    [T.StructField(p, CLAIMS) for p in (OCCUPATION, CITIZENSHIP, GENDER, BIRTH)]
)


def parse_claims(document: Column) -> Column:
    """A JSON object of property to claims."""
    return F.from_json(document, PROPERTIES)


def best_claims(claims: Column) -> Column:
    """Drop deprecated claims; if preferred ones remain keep only those. Order is kept."""
    claims = F.coalesce(claims, F.array().cast(CLAIMS))

    def preferred(claim: Column) -> Column:
        return claim["rank"].eqNullSafe(F.lit("preferred"))

    kept = F.filter(claims, lambda c: ~c["rank"].eqNullSafe(F.lit("deprecated")))
    return F.when(F.exists(claims, preferred), F.filter(claims, preferred)).otherwise(kept)


def item_ids(claims: Column) -> Column:
    """Item ids of the best claims in order, values without an id skipped."""
    ids = F.transform(best_claims(claims), lambda c: c["mainsnak"]["datavalue"]["value"]["id"])
    return F.filter(ids, lambda i: i.isNotNull())


def birth_year(claims: Column) -> Column:
    """Year of the first best claim that states one, as written upstream."""
    values = F.transform(best_claims(claims), lambda c: c["mainsnak"]["datavalue"]["value"])
    dated = F.filter(
        values,
        lambda v: F.coalesce(v["time"].startswith("+"), F.lit(False))
        & (F.coalesce(v["precision"], F.lit(0)) >= YEAR_PRECISION),
    )
    return F.substring(F.get(dated, F.lit(0))["time"], 2, 4).try_cast("int")


def plausible_birth_year(year: Column, newest: Column | int | None = None) -> Column:
    """NULL outside [1900, newest]; never clamped. ``newest`` defaults to the current year."""
    if newest is None:
        newest = F.year(F.current_date())
    return F.when((year >= BIRTH_YEAR_MIN) & (year <= newest), year)


def first_or(values: Column, default: Column) -> Column:
    """First array element, or the default for a null or empty array."""
    return F.coalesce(F.get(values, F.lit(0)), default)
