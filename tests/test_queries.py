"""Every registered query on the smallest tables, against its SQL where it has one."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, differences

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert differences(queries()[name](spark, SF), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_runs(spark, name):
    first = queries()[name](spark, SF)
    # The smallest tables hold too little for the workflow to find a region.
    assert first.columns and first.count() >= (name != "workflow")


def test_entry_has_rows(spark):
    assert entry(spark).count() == 1500
