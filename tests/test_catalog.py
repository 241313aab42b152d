"""Every registered query gives the rows of its SQL."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.oracle import differences

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query_matches_its_sql(spark, name):
    query, sql = entry_point.queries()[name], entry_point.oracle_sql().get(name)
    if sql is None:
        assert query(spark, FOLDER).columns
        return
    ours, theirs, missing, unexpected = differences(spark, query, sql, FOLDER)
    assert ours == theirs
    assert not missing and not unexpected, (missing.most_common(3), unexpected.most_common(3))


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
