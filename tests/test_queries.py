"""Every query against its SQL on DuckDB, and independence of the partition count."""

import pytest

from __spark_entry__ import entry
from check import connect, compare
from ledgertalk.plans.oracle import all_sql
from ledgertalk.plans.queries import all_queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    ours, theirs, _ = compare(spark, db, SF, QUERIES[name], SQL[name])
    assert ours == theirs


@pytest.mark.parametrize("name", ["sft_examples", "order_base_s", "top_recs", "seq_pack", "product_stats"])
def test_result_does_not_depend_on_partitions(spark, partitions, name):
    def run():
        return sorted(map(repr, QUERIES[name](spark, SF).collect()))

    first, *others = partitions(run)
    assert first and all(other == first for other in others)


def test_entry(spark):
    assert entry(spark).columns == ["example_type", "json"]
