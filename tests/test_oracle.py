"""Every registered query with an SQL counterpart, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, SQL[name]) is None


@pytest.mark.parametrize("partitions", ["1", "37"])
@pytest.mark.parametrize("name", ["c12_contained_passages", "g01_first_wins_status", "h02_augment", "h03_ood_generation"])
def test_partitioning_does_not_matter(spark, sf, con, name, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert compare(entry.queries()[name](spark, sf), con, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_entry(spark):
    assert entry.entry(spark).count() == 6
