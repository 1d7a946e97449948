import json

import pytest
from pyspark.sql import functions as F

from renown.functions import claims as C
from renown.operators import facets


def claim(rank=None, **value):
    out = {"mainsnak": {"datavalue": {"value": value}} if value else {}}
    if rank:
        out["rank"] = rank
    return out


def record(spark, **properties):
    df = spark.createDataFrame([("Q1", json.dumps(properties))], "qid string, claims string")
    return facets.claim_records(df).first()


@pytest.mark.parametrize(
    "ranks, kept",
    [
        (["normal", "deprecated", None], ["0", "2"]),
        (["normal", "preferred", "preferred"], ["1", "2"]),
        (["deprecated", "deprecated"], []),
        ([None, "preferred", "deprecated"], ["1"]),
        ([], []),
    ],
)
def test_best_claims(spark, ranks, kept):
    claims = [claim(r, id=str(i)) for i, r in enumerate(ranks)]
    assert record(spark, P106=claims)["occupation_qids"] == kept


def test_values_without_an_id_are_skipped(spark):
    assert record(spark, P27=[claim("normal"), claim("normal", id="Q5"), claim("normal", time="+1990")])[
        "citizenship_qids"
    ] == ["Q5"]


@pytest.mark.parametrize(
    "claims, year",
    [
        ([claim("normal", time="+1985-02-03T00:00:00Z", precision=11)], 1985),
        ([claim("normal", time="-0044-01-01T00:00:00Z", precision=9), claim("normal", time="+1990-00-00", precision=9)], 1990),
        ([claim("normal", time="+1900-00-00", precision=7), claim("normal", time="+1991-00-00", precision=9)], 1991),
        ([claim("normal", time="+1985-00-00")], None),
        ([claim("deprecated", time="+1985-00-00", precision=9)], None),
        ([claim("normal", time="+0001-00-00", precision=9)], 1),
        ([], None),
    ],
)
def test_birth_year(spark, claims, year):
    assert record(spark, P569=claims)["birth_year"] == year


def test_missing_properties_give_empty_arrays(spark):
    row = record(spark)
    assert row["birth_year"] is None
    assert row["occupation_qids"] == row["citizenship_qids"] == row["gender_qids"] == []


def test_implausible_years_become_null(spark):
    years = [1, 1001, 1743, 1899, 1900, 2026, 2027, None]
    df = spark.createDataFrame([(i, y) for i, y in enumerate(years)], "i int, y int")
    got = [r[0] for r in df.orderBy("i").select(C.plausible_birth_year(F.col("y"), 2026)).collect()]
    assert got == [None, None, None, None, 1900, 2026, None, None]


def test_facet_rows(spark):
    entities = spark.createDataFrame([(1, "Q1"), (2, "Q2"), (3, None)], "pageid long, qid string")
    records = spark.createDataFrame(
        [("Q1", 1743, ["o1", "o9", "o1"], ["c1"], ["g1", "g2"])],
        "qid string, birth_year int, occupation_qids array<string>, citizenship_qids array<string>, gender_qids array<string>",
    )
    labels = spark.createDataFrame([("o1", "actor"), ("c1", "Peru"), ("g1", "female")], "id string, label string")
    got = {r["pageid"]: r for r in facets.facet_rows(entities, records, labels, 2026).collect()}
    assert got[1]["birth_year"] is None and got[1]["gender"] == "female"
    assert got[1]["occupations"] == ["actor", "o9", "actor"] and got[1]["citizenships"] == ["Peru"]
    for i in (2, 3):
        assert got[i]["gender"] is None and got[i]["occupations"] == [] and got[i]["citizenships"] == []


def test_value_ids(spark):
    records = spark.createDataFrame(
        [("Q1", ["a", "b"], ["b"], []), ("Q2", [], ["c"], ["a"])],
        "qid string, occupation_qids array<string>, citizenship_qids array<string>, gender_qids array<string>",
    )
    assert sorted(r["id"] for r in facets.value_ids(records).collect()) == ["a", "b", "c"]
