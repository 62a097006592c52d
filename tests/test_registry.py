"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

from feedloom.plans.registry import oracle_sql, queries
from tools.compare import connect, differences

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


@pytest.fixture(scope="module")
def base():
    return connect(DATA)


def test_every_query_has_expected_results():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, base, name):
    text, _ = differences(spark, base, DATA, queries()[name], oracle_sql()[name])
    assert text == ""
