import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

RAW = (
    "InvoiceNo string, StockCode string, Description string, Quantity string, "
    "InvoiceDate string, UnitPrice string, CustomerID string, Country string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("ledgertalk-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw feed from rows given as (invoice, code, description, quantity, price[, country])."""

    def build(rows):
        full = []
        for row in rows:
            invoice, code, description, quantity, price, *rest = row
            country = rest[0] if rest else "UK"
            when = rest[1] if len(rest) > 1 else "2011-01-02 03:04:05"
            full.append((invoice, code, description, quantity, when, price, "17850", country))
        return spark.createDataFrame(full, RAW)

    return build


@pytest.fixture
def lines_of(raw):
    """Line items of a raw feed in profile n."""
    from ledgertalk.operators import catalog, clean

    def build(rows, profile="n"):
        return catalog.line_items(clean.purchases(clean.normalize(raw(rows), profile), profile))

    return build


@pytest.fixture
def partitions(spark):
    """Run a check under several shuffle partition counts."""

    def each(run, counts=(1, 3, 8)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        results = []
        try:
            for n in counts:
                spark.conf.set("spark.sql.shuffle.partitions", str(n))
                results.append(run())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        return results

    return each
