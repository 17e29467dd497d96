import pytest

from sf_dirs import SF_SMALL
from voltframe.plans.catalog import ORACLE, QUERIES
from voltframe.plans.verify import compare


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    rep = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert "error" not in rep, rep
    assert rep["match"], rep


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and "MonthRank" in df.columns
