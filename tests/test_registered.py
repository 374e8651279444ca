"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from catalog.queries import QUERIES
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
TRAINING = {"kmeans_elbow", "kmeans_assign", "cluster_profile"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_with_sql_is_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINING))
def test_query_equals_sql(spark, con, name):
    verdict = compare(spark, con, SF_DIR, name)
    assert verdict.startswith(("ok", "rows-only")), verdict
