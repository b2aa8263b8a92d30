import pytest

from rillstone.plans.catalogue import ORACLES, QUERIES

from compare import database, rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = database(SF).sql(ORACLES[name]).to_arrow_table().to_pandas()
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
