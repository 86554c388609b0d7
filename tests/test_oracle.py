import pytest

import __spark_entry__ as contract
from compare import connect, differences
from siltgauge.plans.oracle import ORACLE
from siltgauge.plans.queries import QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, database, name):
    rows, complaints = differences(spark, database, sf_dir, QUERIES[name], ORACLE[name])
    assert complaints == []
    assert rows > 0 or name == "stream_duplicate_keys"


def test_entry(spark):
    assert contract.entry(spark).columns == ["rule", "n"]
