import __spark_entry__ as contract
import pytest

from siltstone import queries

CORE = sorted(queries.queries())


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert all(n in contract.queries() for n in CORE)


@pytest.mark.parametrize("name", CORE)
def test_core_query_runs(spark, small, name):
    df = contract.queries()[name](spark, small)
    assert df.columns and len(df.columns) == len(set(df.columns))
    df.write.format("noop").mode("overwrite").save()


def test_entry(spark, small):
    assert contract.entry(spark).count() == 7
