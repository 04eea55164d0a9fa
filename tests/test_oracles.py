"""Every registered query with SQL must equal it on the smallest tables."""

import pytest
from check_oracles import database, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, con, name):
    diff, _ = difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name])
    assert diff is None


@pytest.mark.parametrize("name", ["m1_cluster_features", "m2_supervised_features", "m7_linear_regression", "m9_split", "p4_sample_rows", "p10_describe"])
def test_gives_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["Data", "Orario", "Volume_Tweet"]


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())
