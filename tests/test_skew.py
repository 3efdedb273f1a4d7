"""A hot product code in a merge join is split over tasks, with unchanged results."""

import pytest
from pyspark.sql import functions as F

from ledgertalk.operators import catalog
from ledgertalk.session import AGAINST_SKEW
from ledgertalk.sources.scratch import stored

# Small thresholds, so that a small table shows what large ones do.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def settings(spark):
    chosen = {**AGAINST_SKEW, **SMALL}
    before = {name: spark.conf.get(name, None) for name in chosen}
    for name, value in chosen.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_code_is_split(spark, settings):
    n = F.col("id")
    bought = spark.range(300000).select(
        F.when(n % 3 == 0, "HOT").otherwise(F.concat(F.lit("P"), n % 997)).alias("StockCode"),
        (n / 9).cast("int").cast("string").alias("InvoiceNo"),
        F.concat(F.lit("NAME "), n % 5).alias("Description"),
        F.lit(2).alias("Quantity"),
        F.lit(0.5).alias("UnitPrice"),
        F.md5(n.cast("string")).alias("CustomerID"),
        F.lit("2011").alias("InvoiceDate"),
        F.lit("UK").alias("Country"),
    )
    bought = stored(bought, "purchases")
    names = stored(catalog.product_names(bought), "names")
    lines = catalog.line_items(bought, names)
    counted = lines.groupBy("StockCode").agg(
        F.count(F.lit(1)).alias("n"), F.max("CustomerID").alias("c"), F.sum("LineTotal").alias("t")
    )
    found = {r.StockCode: r.n for r in counted.collect()}
    assert found["HOT"] == 100000 and sum(found.values()) == 300000
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan.split("== Initial Plan")[0]
