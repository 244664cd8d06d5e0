"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry
import oracle

from filmgrain.plans import registry

QUERIES, SQL = registry.RUN, registry.SQL


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, folder, con, name):
    problem, _, _, _ = oracle.compare(spark, name, QUERIES[name], SQL.get(name), folder, con)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
