import json

import pytest
from pyspark.sql import functions as F

from ledgertalk.operators import examples as ex


def answer(df):
    row = df.select("example_type", F.to_json(F.struct("messages")).alias("json")).first()
    system, user, assistant = json.loads(row.json)["messages"]
    assert [system["role"], user["role"], assistant["role"]] == ["system", "user", "assistant"]
    return row.example_type, user["content"], assistant["content"]


@pytest.fixture
def product(spark):
    return spark.createDataFrame(
        [("A", 'TIN "RED"', 3, 1200, 1234.5, 2)],
        "StockCode string, ProductName string, order_count bigint, units_sold bigint, "
        "avg_price double, country_count bigint",
    )


def test_product_texts(product):
    assert answer(ex.product_examples(product)) == (
        "product_summary",
        'Tell me about product TIN "RED".',
        'Product: TIN "RED". Historical average unit price: £1,234.50. It appeared in 3 order(s), '
        "sold 1200 unit(s), and appeared across 2 country/countries in the historical dataset.",
    )
    assert answer(ex.product_examples(product, "s")) == (
        "product_info",
        'Tell me about the product: TIN "RED".',
        'Product: TIN "RED". In the historical data, it appeared in 3 orders and sold 1200 units. '
        "The average historical unit price was £1,234.50. Use this as historical context, not live "
        "inventory.",
    )


def test_order_texts(spark):
    order = spark.createDataFrame(
        [("5", ["A x1 at £1.00", "B x2 at £2.00"], 5.0, 2)],
        "InvoiceNo string, items array<string>, order_total double, unique_items bigint",
    )
    assert answer(ex.order_examples(order)) == (
        "order_inquiry",
        "What is in order invoice 5?",
        "Invoice 5 contains 2 unique product(s): A x1 at £1.00; B x2 at £2.00. Estimated historical "
        "total: £5.00.",
    )
    assert answer(ex.order_examples(order, "s"))[2] == (
        "Invoice 5 contains 2 unique product(s): A x1 at £1.00; B x2 at £2.00. The estimated "
        "historical total is £5.00. This is based only on historical transaction data."
    )


def test_recommendation_texts(spark):
    recs = spark.createDataFrame(
        [("A", "TIN", ["BOX", "CUP"])], "src_code string, src_name string, recs array<string>"
    )
    assert answer(ex.rec_examples(recs)) == (
        "recommendation",
        "I like TIN. Recommend similar or complementary products.",
        "Based on historical co-purchases, customers who bought TIN also bought: BOX, CUP.",
    )
    assert answer(ex.rec_examples(recs, "s"))[2] == (
        "Based on historical co-purchases, customers who bought TIN also often bought: BOX, CUP. "
        "These are historical recommendations, not live stock guarantees."
    )


def test_cancellation_texts(spark):
    cancelled = spark.createDataFrame([("C5", ["A", "B"])], "InvoiceNo string, items array<string>")
    assert answer(ex.cancel_examples(cancelled)) == (
        "cancellation_or_return",
        "What does invoice C5 mean?",
        "Invoice C5 appears to be a cancellation, return, or adjustment record in the historical "
        "data. Related item descriptions include: A; B.",
    )
    assert answer(ex.cancel_examples(cancelled, "s"))[2] == (
        "Invoice C5 appears to be a cancellation or return record in the historical data. The "
        "related item descriptions include: A; B. For a real customer case, check the live order "
        "system before taking action."
    )


def test_combine_drops_repeated_json(product):
    one = ex.product_examples(product)
    rows = ex.combine(one, one, ex.product_examples(product, "s")).collect()
    assert sorted(r.example_type for r in rows) == ["product_info", "product_summary"]
    assert all(r.json.startswith('{"messages":[{"role":"system","content":"') for r in rows)


def test_no_examples_is_an_error(product):
    with pytest.raises(RuntimeError, match="made no example"):
        ex.require_some(ex.combine(ex.product_examples(product.limit(0))))
