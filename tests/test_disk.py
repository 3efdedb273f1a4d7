"""Disk that queries hold: shuffle files and intermediate tables go as soon as they may."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from check import compare, connect
from ledgertalk.config import Recipe
from ledgertalk.operators import catalog, orders
from ledgertalk.plans import queries
from ledgertalk.plans.oracle import all_sql
from ledgertalk.sources import scratch

SF = "/root/testdata/sf0.001"


@pytest.fixture
def in_rounds(monkeypatch):
    monkeypatch.setattr(scratch, "ROUND_BYTES", 0)


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path))
    return tmp_path


def left(folder):
    """Names of the intermediate tables that still hold rows."""
    return {Path(p).parent.name for p in folder.rglob("part-*") if p.suffix != ".crc"}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_packed_tables_leave_no_shuffle_files(spark, folder):
    before = shuffle_files(spark)
    table = scratch.packed(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    until = time.time() + 10
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and table.count() == 7


def test_rounds_deal_out_every_row_once(spark, folder, in_rounds):
    shelf = scratch.Shelf()
    table = spark.range(500).withColumn("k", F.when(F.col("id") % 9 > 0, F.col("id") % 9))
    parts = [table.filter(chosen("k")) for chosen in scratch.rounds(table)]
    assert len(parts) == scratch.ROUNDS
    kept = shelf.keep_in_rounds(parts, "t")
    assert rows_of(kept) == rows_of(table)
    shelf.drop("t")
    assert left(folder) == set()


@pytest.mark.parametrize("name", ["ex_order", "ex_order_s"])
def test_orders_keep_one_table_and_do_not_depend_on_rounds(spark, folder, monkeypatch, name):
    plain = rows_of(queries.all_queries()[name](spark, SF))
    monkeypatch.setattr(scratch, "ROUND_BYTES", 0)
    found = queries.all_queries()[name](spark, SF)
    assert rows_of(found) == plain
    assert not {"wanted", "bought", "names"} & left(folder)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_only_large_orders_are_dealt_into_parts(spark, monkeypatch, lines_of):
    rows = [(str(i % 3), f"P{i % 17:02d}", f"ITEM {i % 17}", str(1 + i % 3), "1.5") for i in range(90)]
    lines = lines_of(rows)
    most = orders.order_base(lines, Recipe())
    monkeypatch.setattr(orders, "LARGE", 0)
    monkeypatch.setattr(orders, "ORDER_GROUPS", 1 << 10)
    dealt = orders.order_base(lines, Recipe())
    assert rows_of(dealt) == rows_of(most) and len(rows_of(most)) == 3


@pytest.mark.parametrize("name", ["top_recs", "top_recs_s"])
def test_recommendations_keep_one_table_and_do_not_depend_on_rounds(spark, folder, monkeypatch, name):
    plain = rows_of(queries.all_queries()[name](spark, SF))
    monkeypatch.setattr(scratch, "ROUND_BYTES", 0)
    found = queries.all_queries()[name](spark, SF)
    assert rows_of(found) == plain
    assert not {"wanted", "bought", "baskets"} & left(folder)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_name_numbers_are_in_the_order_of_names(spark, folder):
    rows = [(f"P{i}", f"NAME {i * 37 % 101} £") for i in range(300)]
    names = spark.createDataFrame(rows, "StockCode string, ProductName string").repartition(7)
    found = sorted((r.name_id, r.ProductName) for r in catalog.name_ids(names).collect())
    texts = [text for _, text in found]
    assert texts == sorted(texts) and len({n for n, _ in found}) == len(set(texts)) == 101


def test_pairs_are_not_shuffled_for_their_names(spark, folder, in_rounds):
    plan = queries.all_queries()["directed_pairs"](spark, SF)._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString()
    assert not {"wanted", "bought", "baskets"} & left(folder)


@pytest.mark.parametrize("name", ["built_split_counts", "built_token_summary_s", "built_jsonl_s"])
def test_builds_equal_sql_in_rounds_and_drop_their_sources(spark, folder, in_rounds, name):
    ours, theirs, _ = compare(spark, connect(SF), SF, queries.all_queries()[name], all_sql()[name])
    assert ours == theirs and ours[1]
    assert not {"raw_csv", "txn", "purchases", "product_stats", "baskets"} & left(folder)
