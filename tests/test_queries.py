"""Every registered query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from altigrid.plans.catalog import all_queries
from altigrid.plans.oracles import all_oracles
from check_oracles import compare, open_tables
from tests.conftest import SMALL

ROWS_ONLY = {"sample_bernoulli"}


@pytest.fixture(scope="module")
def tables():
    return open_tables(SMALL)


def test_all_but_the_random_sample_have_sql():
    assert set(all_queries()) - set(all_oracles()) == ROWS_ONLY
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query(spark, tables, name):
    assert compare(spark, tables, SMALL, name) is None


def test_entry(spark):
    found = entry_points.entry(spark)
    assert [r.zoom for r in found.collect()] == list(range(11))
