"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as spec
from tidemark import catalogue
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalogue.ORACLES) == set(catalogue.QUERIES)
    assert set(catalogue.QUERIES) <= set(spec.queries())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    _, _, problem = differences(
        spec.queries()[name](spark, SF_DIR), con, spec.oracle_sql()[name]
    )
    assert problem is None, problem


def test_entry_has_rows(spark):
    assert not spec.entry(spark).isEmpty()
