"""Every query that SQL can express gives the same rows as the SQL."""

import pytest

from catalogue.registry import ORACLES, QUERIES
from tools.check import SMALL_SF as SF, compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    status, note = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert status == "ok", note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:2] == ["cluster", "gene"]
    assert df.count() > 0
