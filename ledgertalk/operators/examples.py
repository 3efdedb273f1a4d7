"""Question-and-answer chat examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertalk.functions.text import chat, count_text, fill, messages_json, money

# System prompts and example wording, the product's output format.
SYSTEM_PROMPT = {
    "n": (
        "You are a helpful ecommerce shopping assistant trained on historical retail transactions. "
        "Help with product questions, order-style inquiries, cancellations, returns, and product "
        "recommendations. Use only the provided historical context. Do not invent live inventory, "
        "shipping status, or real-time prices."
    ),
    "s": (
        "You are a helpful ecommerce shopping assistant. Use the provided historical retail context "
        "to answer shopping, order, product, and recommendation questions. Be concise and do not "
        "invent live inventory, shipping status, or real-time prices."
    ),
}
PRODUCT_TYPE = {"n": "product_summary", "s": "product_info"}
ORDER_TYPE = "order_inquiry"
REC_TYPE = "recommendation"
CANCEL_TYPE = "cancellation_or_return"

PRODUCT_QUESTION = {
    "n": "Tell me about product {name}.",
    "s": "Tell me about the product: {name}.",
}
PRODUCT_ANSWER = {
    "n": (
        "Product: {name}. Historical average unit price: £{price}. It appeared in {orders} order(s), "
        "sold {units} unit(s), and appeared across {countries} country/countries in the historical "
        "dataset."
    ),
    "s": (
        "Product: {name}. In the historical data, it appeared in {orders} orders and sold {units} "
        "units. The average historical unit price was £{price}. Use this as historical context, not "
        "live inventory."
    ),
}
ORDER_QUESTION = "What is in order invoice {invoice}?"
ORDER_ANSWER = {
    "n": (
        "Invoice {invoice} contains {n} unique product(s): {items}. Estimated historical total: "
        "£{total}."
    ),
    "s": (
        "Invoice {invoice} contains {n} unique product(s): {items}. The estimated historical total is "
        "£{total}. This is based only on historical transaction data."
    ),
}
REC_QUESTION = "I like {name}. Recommend similar or complementary products."
REC_ANSWER = {
    "n": "Based on historical co-purchases, customers who bought {name} also bought: {recs}.",
    "s": (
        "Based on historical co-purchases, customers who bought {name} also often bought: {recs}. "
        "These are historical recommendations, not live stock guarantees."
    ),
}
CANCEL_QUESTION = "What does invoice {invoice} mean?"
CANCEL_ANSWER = {
    "n": (
        "Invoice {invoice} appears to be a cancellation, return, or adjustment record in the "
        "historical data. Related item descriptions include: {items}."
    ),
    "s": (
        "Invoice {invoice} appears to be a cancellation or return record in the historical data. The "
        "related item descriptions include: {items}. For a real customer case, check the live order "
        "system before taking action."
    ),
}


def _example(df: DataFrame, kind: str, profile: str, question: Column, answer: Column) -> DataFrame:
    messages = chat(system=F.lit(SYSTEM_PROMPT[profile]), user=question, assistant=answer)
    return df.select(F.lit(kind).alias("example_type"), messages.alias("messages"))


def product_examples(stats: DataFrame, profile: str = "n") -> DataFrame:
    name = F.col("ProductName")
    answer = fill(
        PRODUCT_ANSWER[profile],
        name=name,
        price=money(F.col("avg_price")),
        orders=count_text("order_count"),
        units=count_text("units_sold"),
        countries=count_text("country_count"),
    )
    question = fill(PRODUCT_QUESTION[profile], name=name)
    return _example(stats, PRODUCT_TYPE[profile], profile, question, answer)


def order_examples(orders: DataFrame, profile: str = "n") -> DataFrame:
    invoice = F.col("InvoiceNo")
    answer = fill(
        ORDER_ANSWER[profile],
        invoice=invoice,
        n=count_text("unique_items"),
        items=F.concat_ws("; ", "items"),
        total=money(F.col("order_total")),
    )
    return _example(orders, ORDER_TYPE, profile, fill(ORDER_QUESTION, invoice=invoice), answer)


def rec_examples(recs: DataFrame, profile: str = "n") -> DataFrame:
    name = F.col("src_name")
    answer = fill(REC_ANSWER[profile], name=name, recs=F.concat_ws(", ", "recs"))
    return _example(recs, REC_TYPE, profile, fill(REC_QUESTION, name=name), answer)


def cancel_examples(cancelled: DataFrame, profile: str = "n") -> DataFrame:
    invoice = F.col("InvoiceNo")
    answer = fill(CANCEL_ANSWER[profile], invoice=invoice, items=F.concat_ws("; ", "items"))
    return _example(cancelled, CANCEL_TYPE, profile, fill(CANCEL_QUESTION, invoice=invoice), answer)


def combine(*kinds: DataFrame) -> DataFrame:
    """``example_type, json`` without repeated JSON."""
    rows = reduce(DataFrame.unionByName, kinds).withColumn("json", messages_json())
    return rows.groupBy("json").agg(F.min("example_type").alias("example_type")).select(
        "example_type", "json"
    )


def require_some(examples: DataFrame) -> DataFrame:
    """Stop a run that produced nothing."""
    if examples.isEmpty():
        raise RuntimeError("the run made no example: every input row was filtered out")
    return examples
