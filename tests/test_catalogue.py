"""Every registered query, against its SQL where it has any."""

import pytest
from compare import connect, differences, plan_faults

from millrace.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert plan_faults(name, df) == []
    assert differences(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert {r.lang for r in rows} and all(0 <= r.rate <= 1 for r in rows)
    assert set(contract.oracle_sql()) <= set(contract.queries())
