"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
import check
import workloads.all as workloads

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def db():
    return check.tables(SF)


def test_every_query_has_sql():
    assert set(workloads.ORACLES) == set(workloads.QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["user_id", "event_type", "value"]


@pytest.mark.parametrize("name", sorted(workloads.QUERIES))
def test_query_equals_sql(spark, db, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert check.compare(got, db.execute(contract.oracle_sql()[name]).df()) == ""
