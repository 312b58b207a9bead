import pytest

import __spark_entry__ as entry
from strata.plans import catalog
from compare import differences, oracle_connection

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(data):
    with oracle_connection(data) as opened:
        yield opened


def test_every_query_has_its_sql():
    assert catalog.queries().keys() <= ORACLE.keys()
    assert catalog.queries().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_its_sql(spark, data, connection, name):
    assert differences(spark, data, entry.queries()[name], ORACLE[name], connection) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5
