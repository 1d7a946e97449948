import pytest

import __spark_entry__ as contract
from renown import session
from workload.check import compare

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    with session.scratch_scope(spark):
        df = QUERIES[name](spark, tables)
        if name in ORACLES:
            assert compare(df, tables, ORACLES[name]) == ""
        else:
            assert df.count() > 0


def test_erasure_report(spark, tables):
    rows = {r["variant"]: r for r in QUERIES["erasure_summary"](spark, tables).collect()}
    assert rows["raw"]["auc"] > 0.9
    for variant in ("centroid", "leace"):
        assert 0.25 <= rows[variant]["auc"] <= 0.75
    assert all(0 < r["purity"] <= 1 and 0.4 < r["chance"] < 0.7 for r in rows.values())


def test_entry(spark, tables):
    df = contract.entry(spark)
    assert df.columns[0] == "rank" and df.count() > 0
