import pytest

import __spark_entry__ as contract
from tests.oracle_check import differences, sql_connection


@pytest.fixture(scope="module")
def connection(folder):
    return sql_connection(folder)


def test_contract_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


# At the smallest scale every cluster of a fit need not be filled, so the fit's
# invariants are compared at the larger one by ``oracle_check``.
@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, connection, folder, name):
    assert differences(spark, connection, name, folder) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_has_rows(spark, folder, name):
    assert contract.queries()[name](spark, folder).count() > 0
