import pytest
from compare import difference, duck

import __spark_entry__ as entry_point
from usagelens.registry.oracles import ORACLES
from usagelens.registry.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, connection, name):
    assert difference(QUERIES[name](spark, sf), connection, ORACLES[name]) is None


def test_registry_is_served():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10
