import os

import pytest

import __spark_entry__ as entry_module
from tests.check_queries import compare, database

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name)[0].startswith("ok")


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["id", "label", "idx", "feature", "value"] and df.count() > 0
